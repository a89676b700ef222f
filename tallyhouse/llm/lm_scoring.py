"""Stupid-backoff scores of documents under n-gram counts of all other documents.

The count of an n-gram is over the whole corpus; a document's own occurrences are taken off when it is scored. With order 3,

    s(w | u v) = c(u v w) / c(u v)   if that n-gram is known, else  backoff * s(w | v),   down to   c(w) / N.

Documents are dealt into slices of about ``slice_bytes`` of text by a hash of their row. A slice sends its distinct
n-grams, sorted, to the count tables, which are partitioned by hash into buckets; a bucket adds up all slices' counts and answers
each slice in the slice's own order. So an n-gram travels once per slice that has it, not once per occurrence, and frequent
words, however many documents have them, are one entry per slice. Scores are summed per document in its slice. Texts
and n-grams travel compressed.

Defined results: a null or empty text has no words, score 0 and no mean; a word that no other document has counts as one
occurrence; repeated rows score alike (each is the other's "other document"); an empty table gives no rows. Only doc_id
and text are read. Words are compared in lower case (ASCII), n-grams by ``KEY_BITS`` bits of a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import read, row_key, word_count
from tallyhouse.llm.packed import pack_numbers, pack_sorted, pack_texts, unpack_numbers, unpack_sorted, unpack_texts
from tallyhouse.llm.words import SPACES, Words, window_hashes

ORDER = 3
BACKOFF = 0.4
SLICE_BYTES = 8 << 20
SLICES_PER_BUCKET = 4
KEY_BITS = 56


def _grams(packed: pa.ChunkedArray, order: int) -> tuple[Words, list[np.ndarray]]:
    """The words of a slice, and per n the key of the n-gram that starts at each word, over text ends too."""
    words = Words(unpack_texts(packed), SPACES, lower=True)
    hashes = words.hashes()
    return words, [window_hashes(hashes, n) >> np.uint64(64 - KEY_BITS) for n in range(1, order + 1)]


def _inside(words: Words, grams: np.ndarray, n: int) -> np.ndarray:
    """Whether each n-gram lies in one text."""
    end = np.repeat(words.first[1:], words.counts)[: len(grams)]
    return np.arange(len(grams)) + n <= end


def _distinct(words: Words, grams: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n the sorted distinct n-grams of the slice and how often each occurs."""
    return [np.unique(g[_inside(words, g, n)], return_counts=True) for n, g in enumerate(grams, 1)]


def _cuts(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted keys pass from one bucket (an equal range of keys) to the next."""
    edges = [(b << KEY_BITS) // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(values, np.array(edges, np.uint64)), [len(values)]])


def _send(key: tuple, table: pa.Table, order: int, buckets: int) -> pa.Table:
    words, grams = _grams(table.column("packed"), order)
    rows = {"slice": [], "bucket": [], "n": [], "grams": [], "counts": []}
    for n, (value, count) in enumerate(_distinct(words, grams), 1):
        cut = _cuts(value, buckets)
        for bucket in np.flatnonzero(np.diff(cut)):
            part = slice(cut[bucket], cut[bucket + 1])
            for name, item in zip(rows, (key[0].as_py(), int(bucket), n, pack_sorted(value[part]), pack_numbers(count[part])), strict=True):
                rows[name].append(item)
    return pa.table([pa.array(rows[name], kind) for name, kind in zip(rows, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                    names=list(rows))


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """Corpus counts of one bucket's n-grams of one length, for each slice that asked."""
    grams = [unpack_sorted(packed) for packed in table.column("grams").to_pylist()]
    counts = np.concatenate([unpack_numbers(packed) for packed in table.column("counts").to_pylist()])
    _, entry = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(entry, counts).astype(np.int64)[entry]
    ends = np.cumsum([len(g) for g in grams])
    totals = [pack_numbers(total[end - len(g) : end]) for g, end in zip(grams, ends, strict=True)]
    return pa.table({"slice": table.column("slice"), "bucket": table.column("bucket"), "n": table.column("n"),
                     "totals": pa.array(totals, pa.binary())})


def _score(key: tuple, docs: pa.Table, answers: pa.Table, order: int, backoff: float, corpus: int) -> pa.Table:
    words, grams = _grams(docs.column("packed"), order)
    row, counts = words.rows(), words.counts
    position = np.arange(len(words)) - np.repeat(words.first[:-1], counts)
    asked = sorted(zip(*(answers.column(c).to_pylist() for c in ("n", "bucket", "totals")), strict=True))
    # others[n - 1][i]: how often other documents have the n-gram that starts at word i (0 where it leaves the text).
    others = []
    for n, (value, _) in enumerate(_distinct(words, grams), 1):
        found_of_n = [unpack_numbers(packed) for length, _, packed in asked if length == n]
        total = np.concatenate([np.zeros(0, np.uint64), *found_of_n]).astype(np.int64)
        inside = np.flatnonzero(_inside(words, grams[n - 1], n))
        entry = np.searchsorted(value, grams[n - 1][inside])
        _, pair, own = np.unique(row[inside] * max(1, len(value)) + entry, return_inverse=True, return_counts=True)
        found = np.zeros(len(words) + order, np.int64)
        found[inside] = total[entry] - own[pair]
        others.append(found)
    rest = np.maximum(corpus - np.repeat(counts, counts), 1)
    score = np.maximum(others[0][: len(words)], 1) / rest
    for n in range(2, order + 1):
        at = np.arange(len(words)) - (n - 1)  # the n-gram that ends at each word
        known = position >= n - 1
        whole, context = others[n - 1][at], others[n - 2][at]
        seen = known & (whole > 0)
        score = np.where(seen, whole / np.maximum(context, 1), np.where(known, backoff * score, score))
    total = np.bincount(row, np.log(score), minlength=docs.num_rows)
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(counts, pa.int64()), "log_score": pa.array(total, pa.float64())})


def score(documents: DataFrame, order: int = ORDER, backoff: float = BACKOFF, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, log_score (sum of natural logarithms), mean_log_score."""
    rows = row_key(documents)
    size, words = rows.agg(F.sum(F.octet_length("text")), F.sum(word_count(F.col("text")))).first()
    parts = max(1, -(-(size or 0) // slice_bytes))
    buckets = max(1, parts // SLICES_PER_BUCKET)
    sliced = rows.select("doc_id", F.pmod(F.xxhash64("dk", "th"), F.lit(parts)).cast("int").alias("slice"), "text").mapInArrow(
        pack_texts, "doc_id long, slice int, packed binary")
    sent = sliced.groupBy("slice").applyInArrow(
        _sender(order, buckets), "slice int, bucket int, n int, grams binary, counts binary")
    answers = sent.groupBy("bucket", "n").applyInArrow(_answer, "slice int, bucket int, n int, totals binary")
    scored = sliced.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _scorer(order, backoff, int(words or 0)), "doc_id long, n_words long, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


def _sender(order: int, buckets: int):
    def apply(key: tuple, table: pa.Table) -> pa.Table:
        return _send(key, table, order, buckets)

    return apply


def _scorer(order: int, backoff: float, corpus: int):
    def apply(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        return _score(key, docs, answers, order, backoff, corpus)

    return apply


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    found = score(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


OP6_SQL = r"""
with cut as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), total as (select sum(len(w)) as n from cut),
tokens as (
  select doc_id, i, len(w) as n, w[i] as g1, case when i > 1 then w[i - 1] || ' ' || w[i] end as g2,
    case when i > 2 then w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] end as g3,
    case when i > 1 then w[i - 1] end as h1, case when i > 2 then w[i - 2] || ' ' || w[i - 1] end as h2
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from cut)
), c1 as (select g1 as g, count(*) as c from tokens group by 1), c2 as (select g2 as g, count(*) as c from tokens where g2 is not null group by 1),
c3 as (select g3 as g, count(*) as c from tokens where g3 is not null group by 1),
o1 as (select doc_id, g1 as g, count(*) as c from tokens group by 1, 2),
o2 as (select doc_id, g2 as g, count(*) as c from tokens where g2 is not null group by 1, 2),
o3 as (select doc_id, g3 as g, count(*) as c from tokens where g3 is not null group by 1, 2),
r1 as (select doc_id, o1.g, c1.c - o1.c as c from o1 join c1 on o1.g = c1.g),
r2 as (select doc_id, o2.g, c2.c - o2.c as c from o2 join c2 on o2.g = c2.g),
r3 as (select doc_id, o3.g, c3.c - o3.c as c from o3 join c3 on o3.g = c3.g),
scored as (
  select t.doc_id, case
    when coalesce(r3.c, 0) > 0 then r3.c / b2.c::double
    else (case when i > 2 then 0.4::double else 1.0::double end) * case
      when coalesce(r2.c, 0) > 0 then r2.c / b1.c::double
      else (case when i > 1 then 0.4::double else 1.0::double end) * greatest(r1.c, 1) / greatest((select n from total) - t.n, 1)::double end end as s
  from tokens t join r1 on r1.doc_id = t.doc_id and r1.g = g1
  left join r2 on r2.doc_id = t.doc_id and r2.g = g2 left join r3 on r3.doc_id = t.doc_id and r3.g = g3
  left join r1 b1 on b1.doc_id = t.doc_id and b1.g = h1 left join r2 b2 on b2.doc_id = t.doc_id and b2.g = h2
), sums as (select doc_id, sum(ln(s)) as total from scored group by 1)
select doc_id, len(w)::bigint as n_words, round(coalesce(total, 0), 6)::double as log_score,
  case when len(w) > 0 then round(coalesce(total, 0) / len(w), 6)::double end as mean_log_score
from cut left join sums using (doc_id)
"""
