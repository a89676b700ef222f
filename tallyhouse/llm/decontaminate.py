"""Benchmark decontamination with suffix arrays of the training text.

Each run of documents in a task is a shard. Its suffix array holds the suffixes that start
with enough benchmark words to contain a window, ordered by their first ``window`` words; the test
suffixes are found in it by binary search. Neighbouring hits on one diagonal are one longest match.

Words are runs of ASCII letters and digits and of all other characters outside ASCII, in lower case. A test window is
``window`` consecutive words of an item, or the whole item where it has fewer. A word of a document inside an occurrence
of a window is hit; a document is contaminated when at least ``share`` of its words, and one, are hit.

Defined results: a null or empty text has no words and is clean; an item without words is never found;
repeated documents give one row each; an item id given twice counts once; a null item id is
written as "null"; an empty benchmark leaves all documents clean. Only doc_id, text, item_id are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import keyed, read, row_key
from tallyhouse.llm.words import NOT_ALNUM, Words, inside_text, runs_of, slices

WINDOW = 13
BLOCK_BYTES = 32 << 20
_FILTER_BITS = 20


class TestWindows:
    """The windows of a block of items, as ranks of the block's own words, and which items have each."""

    __test__ = False

    def __init__(self, items: pd.DataFrame, window: int):
        words = Words(pa.array(items["text"], pa.large_string()), NOT_ALNUM, lower=True)
        hashes = words.hashes()
        self.window = window
        self.vocabulary = np.unique(hashes)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.vocabulary & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        ranks = np.searchsorted(self.vocabulary, hashes).astype(np.uint32) + 1
        counts = words.counts
        short = np.flatnonzero((counts > 0) & (counts < window))
        at = np.concatenate([inside_text(words.first, window), words.first[short]]).astype(np.int64)
        size = np.concatenate([np.full(len(at) - len(short), window), counts[short]]).astype(np.int64)
        padded = np.concatenate([ranks, np.zeros(window, np.uint32)])
        rows = padded[at[:, None] + np.arange(window)] if len(at) else np.zeros((0, window), np.uint32)
        rows = np.where(np.arange(window) < size[:, None], rows, 0).astype(np.uint32)
        self.at, self.of = at, np.searchsorted(words.first, at, "right") - 1
        self.item_start = self.at - words.first[self.of]
        self.rows, self.window_id = np.unique(rows, axis=0, return_inverse=True)
        self.window_id = self.window_id.reshape(-1)
        self.size = (self.rows > 0).sum(axis=1)
        self.least = int(self.size.min()) if len(self.size) else window
        # Search keys: the first suffix with these words, and behind the last one.
        self.low = _key(self.rows)
        self.high = _key(np.where(self.rows > 0, self.rows, np.uint32(0xFFFFFFFF)))
        self.ids = items["item_id"].to_numpy(object)
        order = np.argsort(self.window_id, kind="stable")
        self.owners = self.of[order]
        self.owner_first = np.searchsorted(self.window_id[order], np.arange(len(self.rows) + 1))
        self.owner_start = self.item_start[order]

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(window, word of the shard at which it occurs) of all occurrences."""
        hashes = words.hashes()
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.rows) or not len(hashes):
            return none
        known = self.maybe[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]
        near = np.flatnonzero(known)
        rank = np.zeros(len(hashes) + self.window, np.uint32)
        found = np.minimum(np.searchsorted(self.vocabulary, hashes[near]), len(self.vocabulary) - 1)
        rank[near] = np.where(self.vocabulary[found] == hashes[near], found + 1, 0)
        run = _run_length(rank[: len(hashes)] > 0, words, self.window)
        suffix = np.flatnonzero(run >= self.least)
        if not len(suffix):
            return none
        rows = rank[suffix[:, None] + np.arange(self.window)]
        rows = np.where(np.arange(self.window) < run[suffix][:, None], rows, 0)
        keys = _key(rows)
        order = np.argsort(keys, kind="stable")
        suffix, keys = suffix[order], keys[order]
        begin, end = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        count = np.maximum(end - begin, 0)
        window = np.repeat(np.arange(len(count)), count)
        place = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return window, suffix[place]


def _key(rows: np.ndarray) -> np.ndarray:
    """Rows of word ranks as byte strings that order as the rows do."""
    rows = np.ascontiguousarray(rows.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").reshape(-1) if len(rows) else np.zeros(0, f"S{4 * rows.shape[1]}")


def _run_length(known: np.ndarray, words: Words, most: int) -> np.ndarray:
    """How many known words of one text stand from each word on, counted up to ``most``."""
    at = np.arange(len(known))
    unknown = np.minimum.accumulate(np.where(known, len(known), at)[::-1])[::-1]
    border = np.repeat(words.first[1:], words.counts)
    return np.minimum(np.minimum(unknown, border) - at, most)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[pd.DataFrame]:
    """The benchmark in blocks of bounded size."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
                         F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes) or 1
    for block in range(count):
        part = items if count == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == block)
        yield part.toPandas()


def _hits(batches: Iterator[pa.RecordBatch], tests: TestWindows, all_rows: bool) -> Iterator[pa.RecordBatch]:
    """dk, th, doc_id, n_words, the hit words and the items found, per document."""
    for part in slices(batches):
        words = Words(part.column("text"), NOT_ALNUM, lower=True)
        window, at = tests.search(words)
        hit = np.zeros(len(words) + 1, np.int64)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + tests.size[window], -1)
        hit = np.flatnonzero(np.cumsum(hit)[: len(words)])
        row = np.searchsorted(words.first, hit, "right") - 1
        hits = np.bincount(row, minlength=part.num_rows)
        pairs = np.unique((np.searchsorted(words.first, at, "right") - 1) * len(tests.rows) + window)
        doc, window = pairs // max(1, len(tests.rows)), pairs % max(1, len(tests.rows))
        many = tests.owner_first[window + 1] - tests.owner_first[window]
        owner = tests.owners[np.repeat(tests.owner_first[window] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        both = np.unique(np.repeat(doc, many) * max(1, len(tests.ids)) + owner)
        doc, owner = both // max(1, len(tests.ids)), both % max(1, len(tests.ids))
        found = pa.RecordBatch.from_arrays([
            part.column("doc_id"), part.column("dk"), part.column("th"), pa.array(words.counts, pa.int64()),
            runs_of(hit - words.first[row], hits, pa.int32()),
            runs_of(tests.ids[owner].tolist(), np.bincount(doc, minlength=part.num_rows), pa.string()),
        ], ["doc_id", "dk", "th", "n_words", "hits", "items"])
        yield found if all_rows else found.filter(pa.array(hits > 0))


_HITS = "doc_id long, dk long, th long, n_words long, hits array<int>, items array<string>"


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = 0.05,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, dk, th, n_words, n_hit, items (sorted ids of items that occur), contaminated.

    The benchmark is searched in blocks of ``block_bytes`` of text, each small enough to send to every task.
    """
    rows = row_key(documents)
    found = None
    for number, items in enumerate(_blocks(benchmark, block_bytes)):
        tests = rows.sparkSession.sparkContext.broadcast(TestWindows(items, window))
        part = rows.mapInArrow(partial(_search_block, tests=tests, all_rows=number == 0), _HITS)
        found = part.withColumn("block", F.lit(number)) if found is None else found.unionByName(
            part.withColumn("block", F.lit(number)))
    if number:
        # One row per document in the first block; the other blocks add what they hit.
        first = found.filter("block = 0").select("doc_id", "dk", "th", "n_words", "hits", "items")
        rest = found.filter("block > 0").groupBy("dk", "th").agg(
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("more"), F.flatten(F.collect_list("items")).alias("also"))
        found = first.join(rest, ["dk", "th"], "left").select(
            "doc_id", "dk", "th", "n_words", F.expr("array_union(hits, coalesce(more, array())) as hits"),
            F.expr("concat(items, coalesce(also, array())) as items"))
    return found.select(
        "doc_id", "dk", "th", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") >= F.ceil(F.col("n_words") * F.lit(share) - 1e-9)))


def _search_block(batches, tests, all_rows):
    return _hits(batches, tests.value, all_rows)


def longest_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Maximal verbatim matches: doc_id, item_id, first word in the document and in the item, number of words."""
    rows, found = row_key(documents), None
    schema = "doc_id long, item_id string, doc_word long, item_word long, n_words long"
    for items in _blocks(benchmark, block_bytes):
        tests = rows.sparkSession.sparkContext.broadcast(TestWindows(items, window))
        part = rows.mapInArrow(partial(_matches, tests=tests), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _matches(batches: Iterator[pa.RecordBatch], tests) -> Iterator[pa.RecordBatch]:
    tests = tests.value
    for part in slices(batches):
        words = Words(part.column("text"), NOT_ALNUM, lower=True)
        window, at = tests.search(words)
        many = tests.owner_first[window + 1] - tests.owner_first[window]
        pick = np.repeat(tests.owner_first[window] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        size, at = np.repeat(tests.size[window], many), np.repeat(at, many)
        item, start = tests.owners[pick], tests.owner_start[pick]
        order = np.lexsort((at, at - start, item))
        item, start, at, size = item[order], start[order], at[order], size[order]
        doc = np.searchsorted(words.first, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(item) != 0) | (np.diff(at - start) != 0) | (np.diff(at) != 1) | (np.diff(doc) != 0)
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(at))) - 1 + size[head] if len(head) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id").take(pa.array(doc[head])), pa.array(tests.ids[item[head]].tolist(), pa.string()),
            pa.array(at[head] - words.first[doc[head]], pa.int64()), pa.array(start[head], pa.int64()),
            pa.array(length, pa.int64()),
        ], ["doc_id", "item_id", "doc_word", "item_word", "n_words"])


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = 0.05) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    frame, dk, th = keyed(documents)
    bad = contamination(documents, benchmark, window, share).filter("contaminated").select(
        F.col("dk").alias(dk), F.col("th").alias(th)).distinct()
    return frame.join(bad, [dk, th], "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
with cut as (
  select doc_id, 0 as kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item_id, least(13, len(w)) as size, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') as key
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from items where len(w) > 0)
), sizes as (select distinct size from windows), spots as (
  select doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') as key
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from cut, sizes where len(w) >= size)
), found as (select doc_id, s.size, i, item_id from spots s join windows v on s.key = v.key and s.size = v.size),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from found) group by 1),
ids as (select doc_id, count(*) as n, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from found) group by 1)
select cut.doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(ids.n, 0)::bigint as n_items,
  sha256(coalesce(ids.ids, '')) as items_sha256, coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) as contaminated
from cut left join hit using (doc_id) left join ids using (doc_id)
"""
