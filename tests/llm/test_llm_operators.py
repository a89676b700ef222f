"""Each operator on rows with nulls, empty and long texts, copies, repeats and clashing columns, against brute force."""

import zlib

import brute
import numpy as np
import pytest
from helpers_llm import bag, some_rows

from tallyhouse.llm import decontaminate, jaccard_join, lm_scoring, mixing, quality_rules, sharding, substrings


def pairs(rows):
    return [(doc_id, text) for doc_id, text, _ in rows]


def test_quality_rules(documents, rows):
    found = quality_rules.judge(documents(rows))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert bag(found, "doc_id", *names) == sorted(((d, *(brute.base(t)[n] for n in names)) for d, t, _ in rows), key=repr)
    by_id = {r.doc_id: r for r in found.collect()}
    # The line that all twelve documents of a host have is cut; they keep 50 of 60 words.
    assert all(by_id[100 + i].n_removed == 10 and by_id[100 + i].kept for i in range(12))
    assert by_id[1].kept and by_id[1].n_removed == 0 and not by_id[3].kept and not by_id[12].kept
    kept = quality_rules.without_rejected(documents(rows))
    assert kept.columns == documents(rows).columns
    texts = {r.doc_id: r for r in kept.collect()}
    assert set(texts) == {r.doc_id for r in found.collect() if r.kept} and "all have" not in texts[100].text
    assert texts[100].n_chars == len(texts[100].text) and texts[1].text == rows[0][1]
    assert kept.filter("doc_id = 1").count() == 2


def test_a_depleted_document_is_rejected(documents):
    shared = "\n".join(f"shared line number {i} of the host with words" for i in range(20))
    rows = [(i, f"{shared}\nown words of document {i} which are few", "h") for i in range(12)]
    assert not any(r.kept for r in quality_rules.judge(documents(rows)).collect())
    assert quality_rules.without_rejected(documents(rows)).count() == 0


def test_a_line_is_common_on_a_small_host_and_on_a_large_one(documents):
    """Seven documents are more than a tenth of a small host; on a large one more than ten are too many at any share."""
    def host(name, first, size, having):
        first_line = [f"line that some of {name} have" if i < having else f"line of {name}{i}" for i in range(size)]
        return [(first + i, f"{line}\n" + " ".join(f"{name}{i}w{k}" for k in range(30)), name) for i, line in enumerate(first_line)]

    rows = host("small", 0, 20, 7) + host("wide", 100, 100, 7) + host("large", 300, 200, 11) + host("few", 600, 20, 5)
    found = {r.doc_id: r.n_removed for r in quality_rules.judge(documents(rows)).collect()}
    assert {d for d, n in found.items() if n} == {*range(7), *range(300, 311)}


def test_sharding(documents, rows):
    found = sharding.assign_shards(documents(rows)).collect()
    assert len(found) == len(rows)
    assert sorted((r.size, r.text_crc32) for r in found) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    for shard in range(16):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.law == "key" and r.grown_shard in (r.shard, 16) for r in found)
    assert len({(r.doc_id, r.shard) for r in found}) == len({d for d, _, _ in rows})
    keys = np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [brute.jump(int(k), n) for k in keys]
    more = sharding.with_shard(documents(rows))
    assert more.columns[:-1] == [c for c in documents(rows).columns if c != "shard"] and more.columns[-1] == "shard"
    assert sorted((r.doc_id, r.shard) for r in more.filter("doc_id is not null").collect()) == sorted(
        (r.doc_id, r.shard) for r in found if r.doc_id is not None)


def test_jaccard_join(documents, rows):
    found = jaccard_join.near_duplicates(documents(rows))
    assert bag(found, "doc_id", "n_shingles", "component_id") == sorted(brute.components(pairs(rows)), key=repr)
    kept = jaccard_join.one_of_each(documents(rows))
    assert kept.columns == documents(rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 7 not in ids and {3, 4, 5, 8, 9} <= set(ids)


def test_one_of_each_keeps_different_texts_under_one_id(documents):
    texts = [" ".join(f"t{i}w{k}" for k in range(30)) for i in range(4)]
    rows = [(None, texts[0], "a"), (None, texts[1], "a"), (5, texts[2], "a"), (5, texts[3], "a"), (None, texts[2], "b"), (6, texts[2], "b")]
    kept = jaccard_join.one_of_each(documents(rows))
    assert bag(kept, "doc_id", "text") == sorted(((d, t) for d, t, _ in rows[:4]), key=repr)


def test_jaccard_join_of_many_near_copies(documents):
    """Chains and large groups: pairs that only meet after others are joined are still found."""
    rng = np.random.default_rng(3)
    text = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        if i % 6 == 0:
            text = list(text)
            text[int(rng.integers(120))] = f"n{i}"
        near = list(text)
        for place in rng.integers(0, 120, int(rng.integers(0, 5))):
            near[place] = f"e{rng.integers(40)}"
        rows.append((i, " ".join(near), "a"))
    found = jaccard_join.near_duplicates(documents(rows), table_bits=12)
    assert bag(found, "doc_id", "n_shingles", "component_id") == sorted(brute.components(pairs(rows)), key=repr)


def test_all_links_are_counted(documents, rows):
    """Links inside one component as well, with copies, null ids and one id for several texts."""
    rng = np.random.default_rng(4)
    text = [f"w{i}" for i in range(120)]
    for i in range(30):
        near = list(text)
        for place in rng.integers(0, 120, int(rng.integers(0, 4))):
            near[place] = f"e{rng.integers(40)}"
        rows.append((None if i % 5 == 0 else 200 + i // 2, " ".join(near), "a"))
    sets = [brute.shingles(t) for _, t, _ in rows]
    want = [(d, sum(bool(a and b) and i != j and 100 * len(a & b) >= 85 * len(a | b) for j, b in enumerate(sets)))
            for i, ((d, _, _), a) in enumerate(zip(rows, sets, strict=True))]
    found = jaccard_join.linked(documents(rows), table_bits=12).cache()
    assert bag(found, "doc_id", "n_links") == sorted(want, key=repr) and max(n for _, n in want) > 10
    # The pairs give the same components as the short way.
    assert bag(found, "dk", "th", "root") == bag(jaccard_join.near_duplicates(documents(rows), table_bits=12), "dk", "th", "root")


def test_substrings(documents, rows):
    found = substrings.factor_documents(documents(rows), texts=False)
    assert bag(found, "doc_id", "n_words", "n_removed", "kept") == sorted(brute.substrings(pairs(rows)), key=repr)
    by_id = {r.doc_id: r for r in substrings.factor_documents(documents(rows)).collect()}
    assert [tuple(f) for f in by_id[11].factors] == [(0, 30)] and by_id[16].kept == ""
    assert by_id[2].n_removed == 200 and by_id[10].n_removed == 0


def test_substrings_of_many_texts_under_one_id(documents, monkeypatch):
    """No row of the window step holds the anchors of other documents, and results are those of brute force."""
    shared = [" ".join(f"p{i}w{k}" for k in range(20)) for i in range(40)]
    rows = [(None if i % 2 else 7, f"{p} " + " ".join(f"o{i}w{k}" for k in range(15)), "a") for i, p in enumerate(shared)]
    rows += [(100 + i, p, "a") for i, p in enumerate(shared)]
    longest, emit = max(len(t.split()) for _, t, _ in rows), substrings._emit_windows

    def bounded(batches, window):
        def seen():
            for batch in batches:
                assert max(len(a) for a in batch.column("anchors").to_pylist()) <= longest
                yield batch
        yield from emit(seen(), window)

    monkeypatch.setattr(substrings, "_emit_windows", bounded)
    got = bag(substrings.factor_documents(documents(rows), texts=False), "doc_id", "n_words", "n_removed", "kept")
    assert got == sorted(brute.substrings(pairs(rows)), key=repr)


def test_contamination(documents, rows, small):
    text = rows[9][1].split()
    items = [(1, " ".join(text[100:140])), (2, " ".join(text[100:140])), (3, rows[8][1]), (None, " ".join(rows[10][1].split()[5:17])),
             (5, None), (6, ""), (7, "-- !!"), (1, " ".join(text[500:513])), (8, "not there at all")]
    benchmark = small.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hits string")
    want = sorted(brute.contamination(pairs(rows), items), key=repr)
    for block_bytes in (1 << 20, 100):
        found = decontaminate.contamination(documents(rows), benchmark, block_bytes=block_bytes)
        got = found.selectExpr("doc_id", "n_words", "n_hit", "cast(size(items) as long) n", "sha2(array_join(items, ','), 256) s", "contaminated")
        assert bag(got) == want
    matches = {(r.doc_id, r.item_id, r.doc_word, r.n_words) for r in decontaminate.longest_matches(documents(rows), benchmark).collect()}
    assert {(9, "1", 100, 40), (9, "2", 100, 40), (9, "1", 500, 13)} <= matches
    clean = decontaminate.without_contaminated(documents(rows), benchmark)
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(w[0] or -1 for w in want if not w[-1])
    none = decontaminate.contamination(documents(rows), benchmark.limit(0))
    assert none.filter("n_hit > 0 or contaminated").count() == 0 and none.count() == len(rows)


def test_mixing(documents, rows):
    found = mixing.mix(documents(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, stopped = {}, set()
    while True:  # stop what is above its limit and share the rest again
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in stopped)
        want = {s: 2 * sizes[s] if s in stopped else rest * weights[s] / sum(weights[o] for o in order if o not in stopped) for s in order}
        above = {s for s in order if want[s] > 2 * sizes[s] + 1e-9}
        if not above:
            break
        stopped |= above
    assert len(found) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in found)
    got = {}
    for r in found:
        got[round(r.target, 6), r.source_size] = got.get((round(r.target, 6), r.source_size), 0) + r.taken
    assert sorted(got) == sorted({(round(want[s], 6), sizes[s]) for s in order})
    assert all(abs(taken - target) <= mixing.BLOCK_WORDS for (target, _), taken in got.items())
    again = mixing.mix(documents(list(reversed(rows)), parts=1))
    assert bag(again) == sorted(map(tuple, found), key=repr)


def test_mixed_documents(documents, rows):
    mixed = mixing.mixed_documents(documents(rows))
    assert mixed.columns == documents(rows).columns
    taken = {}
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.words(r.text))
    want = {}
    for r in mixing.mix(documents(rows)).collect():
        if r.taken:
            want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert taken == want


@pytest.mark.parametrize("blocks", [1, 2, 3, 7, 64, 1000])
def test_slots_are_permuted(small, blocks):
    from pyspark.sql import functions as F

    keys = {name: F.array(*[F.lit(int(k)) for k in np.random.default_rng(seed).integers(0, 2**28, mixing.ROUNDS)])
            for seed, name in enumerate(("turn", "factor", "shift"))}
    frame = small.range(blocks).withColumns(keys).withColumn("blocks", F.lit(blocks).cast("long"))
    places = [r.p for r in frame.select(mixing.permuted(*map(F.col, ("id", "blocks", "turn", "factor", "shift"))).alias("p")).collect()]
    assert sorted(places) == list(range(blocks)) and (blocks < 64 or places != sorted(places))


def test_lm_scoring(documents, rows):
    want = sorted(brute.backoff_scores(pairs(rows)), key=repr)
    for slice_bytes in (1 << 20, 400):
        found = lm_scoring.score(documents(rows), slice_bytes=slice_bytes).selectExpr("doc_id", "n_words", "round(log_score, 6) s")
        for got, expected in zip(bag(found), want, strict=True):
            assert got[:2] == expected[:2] and got[2] == pytest.approx(expected[2], abs=1e-5)


def test_empty_tables(documents, small):
    none = documents([])
    benchmark = small.createDataFrame([(1, "a b c")], "item_id long, text string")
    for frame in (quality_rules.judge(none), quality_rules.without_rejected(none), sharding.assign_shards(none), sharding.with_shard(none),
                  jaccard_join.near_duplicates(none), jaccard_join.one_of_each(none), substrings.factor_documents(none),
                  decontaminate.contamination(none, benchmark), decontaminate.longest_matches(none, benchmark), mixing.mix(none),
                  mixing.mixed_documents(none), lm_scoring.score(none)):
        assert frame.count() == 0


def test_groups_that_hold_a_third_of_all_rows(documents):
    """One source, text, line and passage in every third row."""
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(i, common, "hot") if i % 3 == 0 else (i, " ".join(f"d{i}w{k}" for k in range(40)) + "\nthe line of many rows\n" + common, "s")
            for i in range(150)]
    got = bag(jaccard_join.near_duplicates(documents(rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(pairs(rows)), key=repr)
    got = bag(substrings.factor_documents(documents(rows), texts=False), "doc_id", "n_words", "n_removed", "kept")
    assert got == sorted(brute.substrings(pairs(rows)), key=repr)


def test_the_line_limit_does_not_grow_with_the_host(documents):
    """A line of eleven documents goes, whether the host has eleven or five hundred; one of ten stays."""
    def rows(others):
        own = "\n".join(f"line {{i}} {k} that only this document has among all of them" for k in range(3))
        shared = [(i, own.format(i=i) + "\nthe line of eleven documents\n" + ("the line of ten documents" if i < 10 else ""), "h") for i in range(11)]
        return shared + [(100 + i, own.format(i=100 + i), "h") for i in range(others)]

    for others in (0, 500):
        found = {r.doc_id: r.n_removed for r in quality_rules.judge(documents(rows(others))).collect()}
        assert {found[i] for i in range(11)} == {5} and all(found[i] == 0 for i in found if i >= 100)
