"""How five filters interact: what each removes, in every order in which they could be applied.

Each document is judged by all filters once; after that only counts matter. Per part they form a 2x2x2x2x2 tensor, one axis per
filter, with pass and fail along it. Every figure of every step of all 120 orders is a contraction of that tensor: along each axis
pass, fail or both are selected (filters applied before must pass, the step's own fails, later ones may do either).

The fifth filter looks at the whole table: a document fails when a smaller doc_id has its text. The rows with the smallest
doc_id of a text are found by a rank that Spark limits per task before the shuffle, so a text that a third of all rows have is
one row per task; all other rows fail. Texts are compared by 96 bits of hashes. Only narrow rows are shuffled.

Defined results: a null text is empty; a null source is the part "" with the empty one; a null doc_id is larger than all
others and has no labels, equal texts that all lack an id pass; repeated rows count each and pass together; a doc_id with several
labels counts as good (toxic) if one of them says so; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Stages, read
from tallyhouse.llm.words import Words, byte_table, slices
from tallyhouse.operators.joins import left_join_sparse

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
FEWEST_WORDS = 200
SYMBOLS = byte_table([(ord(c), ord(c)) for c in "#$%&*|"])
_CAPITALS = byte_table([(65, 90)])
_CODE_POINTS = byte_table([(0x00, 0x7F), (0xC0, 0xFF)])
_CELLS = 1 << len(FILTERS)
_PARTS_AT_ONCE = 64
COUNTS = ("n", "good", "toxic")
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures_of_texts(texts: pa.Array) -> np.ndarray:
    """Per text the filters A to D that it fails, one bit each."""
    found = Words(texts)
    counts, size = found.counts, len(texts)
    rows, hashes = found.rows(), found.hashes()
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    distinct = np.bincount(rows[first], minlength=size)

    def per_text(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[found.data])])[found.offsets])

    return ((counts < FEWEST_WORDS) * 1 + (100 * distinct < 50 * counts) * 2
            + (100 * per_text(_CAPITALS) > 2 * per_text(_CODE_POINTS)) * 4 + (per_text(SYMBOLS) > 0) * 8)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        failed = pa.array(failures_of_texts(batch.column("text")), pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], failed], [*batch.schema.names[:-1], "failed"])


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the hashes of its text, part, filters A to D that it fails, good and toxic as 0 or 1."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.hash(text).alias("mh"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    flags = rows.mapInArrow(_judge, "doc_id long, th long, mh int, part string, failed int")
    said = [F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(alias) for name, alias in (("quality", "good"), ("toxic", "toxic"))]
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(*said).filter("good + toxic > 0")
    return left_join_sparse(flags, marks, "doc_id", "label_id", ["th"]).fillna(0, ["good", "toxic"])


def contingency(rows: DataFrame) -> DataFrame:
    """Per part the counts of :func:`judged` rows in each of the 32 cells: arrays n, good and toxic."""
    cell = ["part", "failed", "good", "toxic"]
    copies = rows.groupBy("th", "mh", "doc_id", *cell).agg(F.count("*").alias("n"))
    place = F.expr("rank() over (partition by th, mh order by doc_id asc nulls last)")
    first = copies.withColumn("place", place).filter("place = 1").groupBy(*cell).agg(F.sum("n").alias("n"))
    everything = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    # Rows that are not first fail the last filter: all rows less the first ones.
    late = F.col("failed") + F.lit(_CELLS // 2)
    cells = everything.withColumn("failed", late).unionByName(first).unionByName(
        first.withColumns({"failed": late, "n": -F.col("n")}))
    weights = {"n": "n", "good": "n * good", "toxic": "n * toxic"}
    return cells.groupBy("part").agg(*[
        F.array(*[F.expr(f"sum(if(failed = {i}, {weight}, 0))") for i in range(_CELLS)]).alias(name) for name, weight in weights.items()])


def steps_of(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """Figures of all orders and steps from counts by (part, kind of count, five axes): arrays by (order, step, part)."""
    select = {"pass": np.array([1, 0]), "fail": np.array([0, 1]), "all": np.array([1, 1])}

    @cache
    def contract(*picked: str) -> np.ndarray:
        return np.einsum("pkabcde,a,b,c,d,e->kp", tensor, *[select[way] for way in picked])

    def ways(own: str, own_way: str, before: str, others: str) -> list[str]:
        return [own_way if f == own else "pass" if f in before else others for f in FILTERS]

    figures = {name: np.zeros((len(ORDERS), len(FILTERS), tensor.shape[0]), np.int64) for name in FIGURES}
    total = {f: 0 for f in FILTERS}
    for i, order in enumerate(ORDERS):
        for step, own in enumerate(order):
            before = order[:step]
            removed, good, toxic = contract(*ways(own, "fail", before, "all"))
            total[own] = total[own] + removed
            figures["removed"][i, step], figures["good_lost"][i, step], figures["toxic_lost"][i, step] = removed, good, toxic
            figures["kept"][i, step] = contract(*ways(own, "pass", before, "all"))[0]
            figures["redundant"][i, step] = contract(*ways(own, "fail", "", "all"))[0] - removed
            figures["unique_fails"][i, step] = contract(*ways(own, "fail", "", "pass"))[0]
    for i, order in enumerate(ORDERS):
        for step, own in enumerate(order):
            figures["shapley"][i, step] = total[own]
    return figures


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = len(ORDERS) * len(FILTERS)
    for whole in batches:
        for low in range(0, whole.num_rows, _PARTS_AT_ONCE):
            batch = whole.slice(low, _PARTS_AT_ONCE)
            size = batch.num_rows
            counts = [batch.column(name).flatten().to_numpy().reshape(size, _CELLS) for name in COUNTS]
            # Bit i of a cell is filter i, so the axes are reversed.
            tensor = np.stack(counts, axis=1).reshape(size, len(COUNTS), *[2] * len(FILTERS)).transpose(0, 1, 6, 5, 4, 3, 2)
            figures = steps_of(tensor)
            own = [f for order in ORDERS for f in order]
            yield pa.RecordBatch.from_arrays([
                batch.column("part").take(pa.array(np.tile(np.arange(size), steps))),
                pa.array(np.repeat(ORDERS, len(FILTERS) * size)), pa.array(np.tile(np.repeat(np.arange(1, 6), size), len(ORDERS)), pa.int32()),
                *[pa.array(figures[name].reshape(-1)) for name in FIGURES], pa.array(np.repeat(own, size)),
            ], ["part", "filter_order", "step", *FIGURES, "filter"])


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: the figures, and the letter of the step's filter."""
    rows = Stages(documents.sparkSession).keep(judged(documents, labels))
    return contingency(rows).mapInArrow(
        _audit, "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in FIGURES) + ", filter string")


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


_LETTERS = "(values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"

OP13_SQL = rf"""
with texts as (
    select coalesce(source, '') as part, coalesce(doc_id, 9223372036854775807) as id, doc_id, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), marks as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels group by doc_id
), masks as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           case when len(words) < {FEWEST_WORDS} then 1 else 0 end + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
           + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 4 else 0 end
           + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
           + case when id > min(id) over (partition by t) then 16 else 0 end as failed
    from texts left join marks using (doc_id)
), cells as (
    select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by part, failed
), orders as (
    select [a.col0, b.col0, c.col0, d.col0, e.col0] as names, [a.col1, b.col1, c.col1, d.col1, e.col1] as bits
    from {_LETTERS} a, {_LETTERS} b, {_LETTERS} c, {_LETTERS} d, {_LETTERS} e
    where a.col1 + b.col1 + c.col1 + d.col1 + e.col1 = 31
      and len(list_distinct([a.col0, b.col0, c.col0, d.col0, e.col0])) = 5
), steps as (
    select array_to_string(names, '') as filter_order, step, names[step] as filter, bits[step] as own,
           coalesce(list_sum(bits[1:step - 1]), 0)::bigint as before
    from orders, (select unnest(range(1, 6)) as step)
), figures as (
    select part, filter_order, step, filter,
           sum(case when failed & (before | own) = 0 then n else 0 end) as kept,
           sum(case when failed & before = 0 and failed & own != 0 then n else 0 end) as removed,
           sum(case when failed & before != 0 and failed & own != 0 then n else 0 end) as redundant,
           sum(case when failed = own then n else 0 end) as unique_fails,
           sum(case when failed & before = 0 and failed & own != 0 then good else 0 end) as good_lost,
           sum(case when failed & before = 0 and failed & own != 0 then toxic else 0 end) as toxic_lost
    from steps, cells group by part, filter_order, step, filter
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, filter))::bigint as shapley, filter
from figures
"""
