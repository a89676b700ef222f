import re

import numpy as np
import pyarrow as pa
from brute import words as plain_words
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import packed
from tallyhouse.llm.words import NOT_ALNUM, Words, inside_text, slices, window_hashes

texts = st.lists(st.none() | st.text(st.sampled_from("ab \n\té漢😀A-"), max_size=30), max_size=8)


def cut(words, row):
    return [words.data[a:b].tobytes().decode() for a, b in zip(words.start[words.first[row] : words.first[row + 1]],
                                                               words.stop[words.first[row] : words.first[row + 1]], strict=True)]


@settings(deadline=None, max_examples=60)
@given(texts)
def test_words_are_those_of_the_pattern(given_texts):
    words = Words(pa.array(given_texts, pa.string()))
    assert [cut(words, i) for i in range(len(given_texts))] == [plain_words(t) for t in given_texts]
    lower = Words(pa.array(given_texts, pa.string()), NOT_ALNUM, lower=True)
    assert [cut(lower, i) for i in range(len(given_texts))] == [
        re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").replace("A", "a")) for t in given_texts]


@settings(deadline=None, max_examples=60)
@given(texts)
def test_hashes_tell_words_and_windows_apart(given_texts):
    words = Words(pa.array(given_texts, pa.string()))
    hashes, all_words = words.hashes(), [w for t in given_texts for w in plain_words(t)]
    assert len(set(hashes.tolist())) == len(set(all_words))
    assert len(set(zip(hashes.tolist(), all_words, strict=True))) == len(set(all_words))
    pairs = {(w[i], w[i + 1]) for w in map(plain_words, given_texts) for i in range(len(w) - 1)}
    assert len(set(window_hashes(hashes, 2)[inside_text(words.first, 2)].tolist())) == len(pairs)


def test_long_texts_are_hashed_in_steps():
    word = "ab" * 700_000
    words = Words(pa.array([f"{word} x {word} " + "y z " * 400_000]))
    hashes = words.hashes()
    assert hashes[0] == hashes[2] != hashes[1] and len(set(hashes.tolist())) == 4


def test_slices_keep_rows_whole_and_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 9, 3, 3, 100, 1)] + [None], "i": list(range(8))})
    parts = list(slices(iter([batch, batch.slice(0, 0)]), limit=8))
    assert [i for part in parts for i in part.column("i").to_pylist()] == list(range(8))
    assert all(part.num_rows == 1 or sum(len(t or "") for t in part.column("text").to_pylist()) <= 8 for part in parts)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packed_numbers_come_back(numbers):
    values = np.array(sorted(numbers), np.uint64)
    assert (packed.unpack_sorted(packed.pack_sorted(values)) == values).all()
    assert (packed.unpack_numbers(packed.pack_numbers(values)) == values).all()
