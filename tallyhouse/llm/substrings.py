"""Duplicate passages by a join of word windows with their first occurrences in all documents.

This is no relative Lempel-Ziv parsing: no reference block is indexed. Of every window of ``window`` words the smallest
doc_id in which it starts is found by a join on the window's hash. A factor of a document is a run of consecutive windows
that earlier documents have, which may be different ones. All windows are looked up at every word, so the factors cover exactly
the words of windows that an earlier document has.

Only windows that can be in another document are looked up. Of each window the four-word gram with the
smallest hash is its anchor, so two equal windows have the same anchor; windows whose anchor occurs in one document
alone are skipped. Copies of a whole text are told by its hash and need no lookup. Texts are shuffled once.

Defined results: a null or empty text has no words; a document with fewer words than the window loses none; the
windows of a document repeated within it do not count; repeated rows give one row each; a null doc_id counts as the last id.
Only doc_id and text are read. Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import LAST_ID, read, row_key
from tallyhouse.llm.words import Words, as_long, inside_text, slices, window_hashes

WINDOW = 13
GRAM = 4
_DROPPED = np.uint64(24)  # anchors travel with 40 bits: equal ones stay equal, and windows are compared in full anyway


def _anchors(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, the word at which each window's anchor starts, hashes of all grams)."""
    starts = inside_text(words.first, window)
    grams = window_hashes(hashes, GRAM)
    best, place = grams[starts].copy(), starts.copy()
    for shift in range(1, window - GRAM + 1):
        other = grams[starts + shift]
        less = other < best
        best[less] = other[less]
        place[less] = starts[less] + shift
    return starts, place, grams


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for part in slices(batches):
        yield part, Words(part.column("text"))


def _emit_anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each document."""
    for part, words in _cut(batches):
        starts, place, grams = _anchors(words, words.hashes(), window)
        place = np.unique(place)
        row = np.searchsorted(words.first, place, "right") - 1
        order = np.lexsort((grams[place], row))
        row, gram = row[order], grams[place][order]
        new = np.ones(len(row), bool)
        new[1:] = (np.diff(row) != 0) | (gram[1:] != gram[:-1])
        row, gram = row[new], gram[new]
        row = pa.array(row)
        yield pa.RecordBatch.from_arrays([as_long(gram >> _DROPPED), part.column("dk").take(row), part.column("th").take(row)],
                                         ["anchor", "dk", "th"])


def _emit_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Windows whose anchor is in ``anchors``: hash, document, first word."""
    for part, words in _cut(batches):
        hashes = words.hashes()
        starts, place, grams = _anchors(words, hashes, window)
        lists = part.column("anchors")
        shared = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        length = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(length)), length)
        # Found by document and anchor together: both sides as one sorted list of pairs.
        row = np.searchsorted(words.first, starts, "right") - 1
        known = _pairs_in(row, grams[place] >> _DROPPED, owner, shared)
        starts, row = starts[known], row[known]
        yield pa.RecordBatch.from_arrays([
            as_long(window_hashes(hashes, window)[starts]), part.column("dk").take(pa.array(row)),
            part.column("th").take(pa.array(row)), pa.array(starts - words.first[row], pa.int32()),
        ], ["window", "dk", "th", "word"])


def _pairs_in(row: np.ndarray, value: np.ndarray, owner: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Whether each (row, value) is among the pairs (owner, shared)."""
    out = np.zeros(len(row), bool)
    low = np.searchsorted(row, np.arange(int(owner.max()) + 2 if len(owner) else 1))
    cut = np.searchsorted(owner, np.arange(int(owner.max()) + 2 if len(owner) else 1))
    for k in np.unique(owner):
        part = slice(low[k], low[k + 1])
        out[part] = np.isin(value[part], shared[cut[k] : cut[k + 1]])
    return out


def _clean(batches: Iterator[pa.RecordBatch], window: int, texts: bool) -> Iterator[pa.RecordBatch]:
    """Per document its factors (first word, number of words) and what is left of its text."""
    for part, words in _cut(batches):
        copy = part.column("copy").to_numpy(zero_copy_only=False)
        found = part.column("words").to_pylist()
        left, removed, factors, counts = [], [], [], words.counts
        for row in range(part.num_rows):
            n = int(counts[row])
            begin = np.arange(n - window + 1) if copy[row] and n >= window else np.sort(np.array(found[row] or [], np.int64))
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, begin, 1)
            np.add.at(cover, np.minimum(begin + window, n), -1)
            keep = np.cumsum(cover)[:n] == 0
            removed.append(n - int(keep.sum()))
            head = np.flatnonzero(np.diff(begin, prepend=-2) != 1)
            tail = np.append(head[1:], len(begin)) - 1
            factors.append([{"word": int(begin[a]), "n_words": int(begin[b] - begin[a]) + window}
                            for a, b in zip(head, tail, strict=True)] if len(begin) else [])
            left.append(words.text(row, keep))
        out = [part.column("dk"), part.column("th"), pa.array(counts, pa.int64()),
               pa.array(removed, pa.int64()),
               pa.array(factors, pa.list_(pa.struct([("word", pa.int64()), ("n_words", pa.int64())])))]
        last = [x.decode() for x in left] if texts else [hashlib.sha256(x).hexdigest() for x in left]
        yield pa.RecordBatch.from_arrays([*out, pa.array(last, pa.string())],
                                         ["dk", "th", "n_words", "n_removed", "factors", "kept"])


def factor_documents(documents: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """Per document: doc_id, dk, th, n_words, n_removed, factors (word, n_words) and kept.

    ``kept`` is the text left, its words joined by one space, or the SHA-256 of it where ``texts`` is false.
    """
    # The same three columns everywhere, so that one exchange of the texts serves all joins.
    rows = row_key(documents).select("dk", "th", "text")
    # A later copy of a text holds nothing new: all its windows start in the first one.
    sized = rows.select("dk", "th", F.octet_length("text").alias("size"))
    firsts = sized.groupBy("th", "size").agg(F.min("dk").alias("first"), F.max("dk").alias("last")).filter("first < last")
    copies = sized.join(firsts, ["th", "size"]).filter("dk > first").select("dk", "th").distinct().withColumn("known", F.lit(True))
    # Every join below is on (dk, th), so the texts are dealt out once and no array holds facts of more than one document.
    texts_of = rows.join(copies, ["dk", "th"], "left").withColumn("copy", F.coalesce("known", F.lit(False)))
    once = texts_of.filter("not copy").select("dk", "th", "text")
    anchors = once.mapInArrow(partial(_emit_anchors, window=window), "anchor long, dk long, th long")
    common = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    shared = anchors.join(common, "anchor", "left_semi").groupBy("dk", "th").agg(F.collect_set("anchor").alias("anchors"))
    windows = once.join(shared, ["dk", "th"]).mapInArrow(
        partial(_emit_windows, window=window), "window long, dk long, th long, word int")
    earliest = windows.groupBy("window").agg(F.min("dk").alias("first"), F.count("*").alias("n")).filter("n > 1")
    found = windows.join(earliest, "window").filter("dk > first").groupBy("dk", "th").agg(
        F.collect_set("word").alias("words"))
    schema = ("dk long, th long, n_words long, n_removed long, "
              "factors array<struct<word: long, n_words: long>>, kept string")
    cleaned = texts_of.join(found, ["dk", "th"], "left").select("dk", "th", "text", "copy", "words").mapInArrow(
        partial(_clean, window=window, texts=texts), schema)
    return cleaned.select(F.nullif("dk", F.lit(LAST_ID)).alias("doc_id"), "*")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = factor_documents(read(spark, sf_dir, "documents"), texts=False)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


OP7_SQL = r"""
with cut as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
spots as (
  select doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as key
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from cut where len(w) >= 13)
), first as (select key, min(doc_id) as first from spots group by key having min(doc_id) < max(doc_id)),
gone as (
  select distinct doc_id, p from (select doc_id, unnest(range(i, i + 13)) as p
    from spots join first using (key) where doc_id > first)
), lists as (select doc_id, list(p) as ps from gone group by doc_id),
kept as (select cut.doc_id, len(w) as n, coalesce(len(ps), 0) as removed,
    case when ps is null then w when len(w) = len(ps) then []
      else list_filter(w, lambda x, i: not list_contains(ps, i)) end as k
  from cut left join lists using (doc_id))
select doc_id, n::bigint as n_words, removed::bigint as n_removed, sha256(coalesce(array_to_string(k, ' '), '')) as kept_sha256 from kept
"""
