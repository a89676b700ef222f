"""Near-duplicate documents by an exact Jaccard join on word shingles.

A document's set holds its distinct shingles of ``size`` lower-case words (ASCII letters only are lowered); fewer words
form one shingle. Two documents link when ``100 * intersection >= percent * union``.

1. Shingles are counted into a table of fixed size; (count, hash) orders them rare first. The order is the
   same everywhere, which is all that prefix filtering needs; collisions in the table only cost speed.
2. Two linked sets share a shingle of their prefixes, the first ``n - ceil(t n) + 1`` in that order. Documents with
   equal sets are one class. Prefix shingles that only one class has are dropped.
3. Candidates meet on a prefix shingle and pass the length filter, the positional filter, and suffix
   filters: shingles of the prefix that no other class has cannot be shared with a set whose prefix ends later, and the
   Hamming distance of the sets' parity bitmaps is at most the number of shingles that they do not share.
4. Every class is first compared with one class per prefix shingle, the one with the fewest unshared shingles, which
   keeps large groups linear. Pairs of classes that are then still in different components but share a
   prefix shingle are all compared too, so no link that joins components is missed. Each pair is verified once, on the texts.
5. ``linked`` takes no such short way: it verifies all candidate pairs, and counts the links of every document.

Defined results: a null or empty text has no shingles and is a component of its own; a null doc_id counts as the last id
and is given back as null; repeated rows are returned as often as they come. Only doc_id and text are read.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import tables
from tallyhouse.llm.common import LAST_ID, Stages, keyed, read, row_key
from tallyhouse.llm.components import components
from tallyhouse.llm.words import SPACES, Words, as_long, inside_text, mixed, runs_of, slices, window_hashes

SIZE = 4
PERCENT = 85
TABLE_BITS = 20
_BITS = 512


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes sorted within each text, the text of each, number of words of each text)."""
    words = Words(texts, SPACES, lower=True)
    hashes, counts = words.hashes(), words.counts
    starts = inside_text(words.first, size)
    values, rows = [window_hashes(hashes, size)[starts]], [np.searchsorted(words.first, starts, "right") - 1]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            values.append(window_hashes(hashes, n)[words.first[short]])
            rows.append(short)
    value, row = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new], counts


def _count_slots(batches: Iterator[pa.RecordBatch], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << bits, np.int64)
    for part in slices(batches):
        value, _, _ = shingle_sets(part.column("text"), size)
        table += np.bincount((value >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    yield from tables.chunks_of(table)


def count_table(rows: DataFrame, size: int = SIZE, bits: int = TABLE_BITS) -> np.ndarray:
    """How often shingles fall into each of ``2 ** bits`` slots, over all documents. Always the same size (8 MB)."""
    return tables.summed(rows.select("text").mapInArrow(partial(_count_slots, size=size, bits=bits), tables.SCHEMA), 1 << bits)


def _profiles(batches: Iterator[pa.RecordBatch], table, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Per document its class, set size, prefix in order, last prefix key, and parity bitmap of the set."""
    table = table.value
    bits = int(len(table)).bit_length() - 1
    for part in slices(batches):
        value, row, _ = shingle_sets(part.column("text"), size)
        n = np.bincount(row, minlength=part.num_rows)
        first = np.concatenate([[0], np.cumsum(n)])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(value))])
        klass = mixed(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64))
        often = np.minimum(table[(value >> np.uint64(64 - bits)).astype(np.int64)], (1 << 18) - 1)
        # Rare first: the count, then bits of the hash that the slot does not fix, then the whole hash.
        key = (often.astype(np.int64) << 44) | ((value << np.uint64(20)) >> np.uint64(20)).astype(np.int64)
        order = np.lexsort((value, key, row))
        value, key = value[order], key[order]
        length = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
        place = np.arange(len(value)) - np.repeat(first[:-1], n)
        pick = place < np.repeat(length, n)
        end = first[:-1] + np.maximum(length - 1, 0)
        last = np.where(n > 0, np.append(key, 0)[np.minimum(end, len(key))], 0)
        odd = np.zeros(part.num_rows * _BITS, bool)
        spot, times = np.unique(np.repeat(np.arange(part.num_rows), n) * _BITS + (value & np.uint64(_BITS - 1)).astype(np.int64),
                                return_counts=True)
        odd[spot] = times % 2 == 1
        bits_of = np.packbits(odd.reshape(-1, _BITS), axis=1, bitorder="little").view(np.int64)
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id"), part.column("dk"), part.column("th"), pa.array(n, pa.int32()), as_long(klass),
            runs_of(value[pick].view(np.int64), length, pa.int64()), pa.array(last, pa.int64()),
            runs_of(bits_of.reshape(-1), np.full(part.num_rows, _BITS // 64), pa.int64()),
        ], ["doc_id", "dk", "th", "n", "class", "prefix", "last", "bits"])


def _needed(x: Column, y: Column, percent: int) -> Column:
    """The intersection that sets of these sizes need: ceil(p (x + y) / (100 + p))."""
    return F.ceil((F.lit(percent) * (x + y)) / F.lit(100 + percent) - 1e-9)


def _filters(percent: int, a: str = "a_", b: str = "b_") -> Column:
    """Length, positional and suffix filters on two postings of one shingle."""
    def c(side: str, name: str) -> Column:
        return F.col(side + name)

    need = _needed(c(a, "n"), c(b, "n"), percent)
    smaller, larger = F.least(c(a, "n"), c(b, "n")), F.greatest(c(a, "n"), c(b, "n"))
    before = F.least(c(a, "pos"), c(b, "pos"))
    after = F.least(c(a, "n") - c(a, "pos"), c(b, "n") - c(b, "pos"))
    # The prefix that ends first has all its shared shingles in the other prefix as well.
    sharable = F.when(c(a, "last") < c(b, "last"), c(a, "n") - c(a, "alone")) \
        .when(c(b, "last") < c(a, "last"), c(b, "n") - c(b, "alone")).otherwise(smaller)
    return (100 * smaller >= percent * larger) & (before + after >= need) & (sharable >= need)


def _near_enough(percent: int, a: str = "a_", b: str = "b_") -> Column:
    """Whether the bitmaps allow the needed intersection: each shingle that only one set has flips one bit."""
    apart = sum((F.bit_count(F.get(F.col(a + "bits"), i).bitwiseXOR(F.get(F.col(b + "bits"), i))) for i in range(1, _BITS // 64)),
                F.bit_count(F.get(F.col(a + "bits"), 0).bitwiseXOR(F.get(F.col(b + "bits"), 0))))
    x, y = F.col(a + "n"), F.col(b + "n")
    return apart + 2 * _needed(x, y, percent) <= x + y


def _verify(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for part in slices(slices(batches, "a_text"), "b_text"):
        a, row_a, _ = shingle_sets(part.column("a_text"), size)
        b, row_b, _ = shingle_sets(part.column("b_text"), size)
        order = np.lexsort((np.concatenate([a, b]), np.concatenate([row_a, row_b])))
        value, row = np.concatenate([a, b])[order], np.concatenate([row_a, row_b])[order]
        same = (value[1:] == value[:-1]) & (row[1:] == row[:-1])
        shared = np.bincount(row[1:][same], minlength=part.num_rows)
        union = np.bincount(row, minlength=part.num_rows) - shared
        keep = pa.array((shared > 0) & (100 * shared >= percent * union))
        yield part.filter(keep).select(["a", "b"])


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The links among candidate pairs (a, b) of classes."""
    for side in ("a", "b"):
        facts = classes.select(*[F.col(c).alias(side if c == "class" else f"{side}_{c}")
                                 for c in ("class", "dk", "th", "n", "bits")])
        pairs = pairs.join(facts, side)
    pairs = pairs.filter(_near_enough(percent)).select("a", "b", "a_dk", "a_th", "b_dk", "b_th")
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(*[F.col(c).alias(f"{side}_{c}") for c in ("dk", "th", "text")]),
                           [f"{side}_dk", f"{side}_th"])
    return pairs.select("a", "b", "a_text", "b_text").mapInArrow(partial(_verify, size=size, percent=percent), "a long, b long")


def _sided(frame: DataFrame, side: str) -> DataFrame:
    return frame.select("token", *[F.col(c).alias(f"{side}_{c}") for c in frame.columns if c != "token"])


class _Profiled(NamedTuple):
    stages: Stages
    profiles: DataFrame
    classes: DataFrame
    met: DataFrame  # prefix shingles that more than one class has
    texts: DataFrame


def _profiled(documents: DataFrame, size: int, percent: int, table_bits: int) -> _Profiled:
    spark = documents.sparkSession
    stages = Stages(spark)
    rows = row_key(documents)
    table = spark.sparkContext.broadcast(count_table(rows, size, table_bits))
    profiles = stages.keep(rows.mapInArrow(
        partial(_profiles, table=table, size=size, percent=percent),
        "doc_id long, dk long, th long, n int, class long, prefix array<long>, last long, bits array<long>"))

    postings = profiles.filter("n > 0").select(
        F.posexplode("prefix").alias("pos", "token"), "class", "n", "last")
    common = postings.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    met = stages.keep(postings.join(common, "token", "left_semi"))
    classes = stages.keep(profiles.filter("n > 0").groupBy("class").agg(
        F.min(F.struct("dk", "th")).alias("first"), F.min("n").alias("n"), F.min("bits").alias("bits"),
        F.count("*").alias("copies")).select("class", "first.dk", "first.th", "n", "bits", "copies"))
    # Prefix shingles that no other class has, from those met; the copies of a class have met the same ones.
    alone = met.groupBy("class").count().join(classes.select("class", "n", "copies"), "class").select(
        "class", F.expr(f"n - ceil({percent} * n / 100 - 1e-9) + 1 - count div copies").cast("int").alias("alone"))
    met = stages.keep(met.distinct().join(alone, "class"))

    texts = rows.select("dk", "th", "text").dropDuplicates(["dk", "th"])
    return _Profiled(stages, profiles, classes, met, texts)


def link_pairs(found: _Profiled, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """All links between classes (a, b), a below b: every pair that passes the filters is verified once."""
    sides = [_sided(found.met.join(found.classes.select("class", "bits"), "class"), side) for side in ("a", "b")]
    pairs = sides[0].join(sides[1], "token").filter("a_class < b_class").filter(_filters(percent) & _near_enough(percent)).select(
        F.col("a_class").alias("a"), F.col("b_class").alias("b")).distinct()
    return found.stages.keep(_verified(found.stages.keep(pairs), found.classes, found.texts, size, percent))


def linked(documents: DataFrame, size: int = SIZE, percent: int = PERCENT, table_bits: int = TABLE_BITS) -> DataFrame:
    """Per document: doc_id, dk, th, n_shingles, class, root, component_id, n_links (other rows that it links with, its copies included).

    The pairs grow with the square of a group of near copies; ``near_duplicates`` gives the components without them.
    """
    found = _profiled(documents, size, percent, table_bits)
    pairs = link_pairs(found, size, percent)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(found.classes.select(F.col("class").alias("b"), "copies"), "b").groupBy(F.col("a").alias("class")).agg(
        F.sum("copies").alias("others"))
    roots = components(pairs, found.stages).select(F.col("node").alias("class"), "root")
    per_class = found.classes.join(others, "class", "left").join(roots, "class", "left").select(
        "class", "dk", F.coalesce("root", "class").alias("root"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    smallest = per_class.groupBy("root").agg(F.min("dk").alias("component"))
    per_class = per_class.drop("dk").join(smallest, "root")
    rows = found.profiles.select("doc_id", "dk", "th", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).alias("class"))
    return rows.join(per_class, "class", "left").select(
        "doc_id", "dk", "th", "n_shingles", "class", "root",
        F.nullif(F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("dk")), F.lit(LAST_ID)).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT,
                    table_bits: int = TABLE_BITS) -> DataFrame:
    """Per document: doc_id, dk, th, n_shingles, class (equal sets), root, component_id (smallest doc_id of the component).

    ``root`` is the smallest class of the component and names it also where ids are null or repeated; it is null without shingles.
    """
    stages, profiles, classes, met, texts = _profiled(documents, size, percent, table_bits)
    sides = [_sided(met, "a"), _sided(met.groupBy("token").agg(
        F.min(F.struct("alone", "class", "n", "pos", "last")).alias("l")).select("token", "l.*"), "b")]
    pair = [F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b")]
    first = stages.keep(sides[0].join(sides[1], "token").filter(F.col("a_class") != F.col("b_class"))
                        .filter(_filters(percent)).select(*pair).distinct())
    links = stages.keep(_verified(first, classes, texts, size, percent))
    roots = components(links, stages)

    # What shares a prefix shingle and is not in one component yet.
    placed = met.join(roots.select(F.col("node").alias("class"), "root"), "class", "left") \
        .withColumn("root", F.coalesce("root", "class"))
    apart = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_ = stages.keep(placed.join(apart, "token", "left_semi").join(classes.select("class", "bits"), "class"))
    rest = _sided(open_, "a").join(_sided(open_, "b"), "token").filter("a_root < b_root").filter(
        _filters(percent) & _near_enough(percent)).select(*pair).distinct().join(first, ["a", "b"], "left_anti")
    rest = stages.keep(rest)
    if not rest.isEmpty():
        more = stages.keep(_verified(rest, classes, texts, size, percent))
        if not more.isEmpty():
            roots = components(links.unionByName(more), stages)

    least = classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left") \
        .select("class", "dk", F.coalesce("root", "class").alias("root"))
    smallest = least.groupBy("root").agg(F.min("dk").alias("component"))
    named = least.join(smallest, "root").select("class", "root", "component")
    return profiles.select("doc_id", "dk", "th", "n", "class").join(named, "class", "left").select(
        "doc_id", "dk", "th", F.col("n").cast("long").alias("n_shingles"), "class", "root",
        F.nullif(F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("dk")), F.lit(LAST_ID)).alias("component_id"))


def one_of_each(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies, with all their columns.

    Of each component the row with the smallest doc_id (then hash of the text) stays, once if it is repeated; documents
    without words all stay. Of rows alike in doc_id and text but not in other columns, any one stays.
    """
    found = near_duplicates(documents, size, percent)
    frame, dk, th = keyed(documents)
    chosen = found.filter("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct("dk", "th")).alias("row")).select(F.col("row.dk").alias(dk), F.col("row.th").alias(th))
    empty = found.filter("n_shingles = 0").select(F.col("dk").alias(dk), F.col("th").alias(th)).distinct()
    kept = frame.join(chosen, [dk, th], "left_semi").dropDuplicates([dk, th])
    return kept.unionByName(frame.join(empty, [dk, th], "left_semi")).select(*[F.col(f"`{c}`") for c in documents.columns])


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_jaccard_links(spark, sf_dir: str) -> DataFrame:
    return linked(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


OP3_SQL = r"""
with recursive cut as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), grams as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) as i from cut where len(w) > 0)
), sizes as (select doc_id, count(*) as n from grams group by 1),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)
), edges as (select a, b from links union select b, a from links),
reach as (select doc_id, doc_id as r from cut union select reach.doc_id, edges.b from reach join edges on edges.a = reach.r),
least as (select doc_id, min(r) as component_id from reach group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from least left join sizes using (doc_id)
"""

OP3_LINKS_SQL = OP3_SQL.replace("select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id\n", """
, ends as (select a as doc_id, count(*) as n_links from edges group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, coalesce(n_links, 0)::bigint as n_links
""").replace("from least left join sizes using (doc_id)", "from least left join sizes using (doc_id) left join ends using (doc_id)")
