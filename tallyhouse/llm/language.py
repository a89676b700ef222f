"""Language of web pages: Bayesian fusion of text, declared language, address suffix and host.

- Text: log-likelihood of the page's byte trigrams under a model per language, counted over all documents into a table of
  fixed size. Trigrams of a text depend on each other, so a text counts as at most ``most_grams`` of them.
- Declared language (``lang`` of the markup) and address suffix (last label of the host): how often each
  goes with each language, from the text's own answers over all pages, smoothed.
- Host prior: shares of languages per host, shrunk towards the last three labels of the host, these to the last two,
  those to all pages. A page's own answer is left out of its host's counts, so its text is not counted twice.

All counts are grouped sums that combine before the shuffle; the page rows meet them by joins on short keys.

Defined results: null or empty html has no text and is judged by the other evidence; a null url has an empty host and
suffix; without any evidence the most frequent language wins, ties go to the smaller code; repeated rows are given back
as often as they come (and count as such); documents without language or text teach nothing; without any labelled
document the language is null. Only page_id, url, html and lang, text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import tables
from tallyhouse.llm.common import Stages, read
from tallyhouse.llm.words import LOWER, slices

SLOTS = 1 << 14
MOST_GRAMS = 60
SMOOTHING = 2.0
HOST_WEIGHT = 5.0
# Each pattern matches at a place or gives up there at once; what is open is looked for with find, once.
_OPENS = re.compile(r"<(?:!--|(script|style)\b)?|&(?=#?\w{1,32};)", re.IGNORECASE)
_REFERENCE = re.compile(r"&#?\w{1,32};")
_CLOSES = {name: re.compile(rf"</{name}\s{{0,32}}>", re.IGNORECASE) for name in ("script", "style")}
_HTML = re.compile(r"<html(?=[\s/>])", re.IGNORECASE)
_LANG = re.compile(r"\slang\s{0,32}=\s{0,32}[\"']?\s{0,32}([a-z]{2,3})\b", re.IGNORECASE)


def plain_text(html: str) -> str:
    """A page with a blank for each tag, comment, character reference, script and style.

    One pass over the page: the end of an element, comment or tag that is never closed is looked for once, and from then on what opens
    one is text.
    """
    out, at, missing = [], 0, set()
    while (found := _OPENS.search(html, at)) is not None:
        begin, name = found.start(), (found.group(1) or "").lower()
        end = -1
        if name and name not in missing:
            closed = _CLOSES[name].search(html, found.end())
            end = closed.end() if closed else -1
            if end < 0:
                missing.add(name)
        elif found.group() == "<!--" and "<!--" not in missing:
            end = html.find("-->", found.end())
            end = end + 3 if end >= 0 else -1
            if end < 0:
                missing.add("<!--")
        elif found.group() == "&":
            end = _REFERENCE.match(html, begin).end()
        if end < 0 and html[begin] == "<" and "<" not in missing:
            end = html.find(">", begin) + 1 or -1
            if end < 0:
                missing.add("<")
        if end < 0:
            out.append(html[at : begin + 1])
            at = begin + 1
        else:
            out += [html[at:begin], " "]
            at = end
    out.append(html[at:])
    return "".join(out)


def declared_language(html: str) -> str:
    """The language that the page's ``html`` element declares, in lower case, else empty.

    Of several such elements the first that declares one counts; one that is not closed ends the search.
    """
    at = 0
    while (found := _HTML.search(html, at)) is not None:
        end = html.find(">", found.end())
        if end < 0:
            return ""
        said = _LANG.search(html, found.end(), end + 1)
        if said:
            return said.group(1).lower()
        at = end + 1
    return ""


def gram_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each byte trigram, the text of each) of texts in lower case (ASCII)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data = LOWER[data[offsets[0] : offsets[-1]]].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slot = ((data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)
    inside = row[2:] == row[:-2]
    return slot[inside], row[:-2][inside]


def _count(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(tables.padded_size(len(languages) * SLOTS), np.int64)
    known = pa.array(languages, pa.string())
    for part in slices(batches):
        slot, row = gram_slots(part.column("text"))
        language = pc.index_in(part.column("lang"), known).to_numpy(zero_copy_only=False)[row].astype(np.int64)
        table += np.bincount(language * SLOTS + slot, minlength=len(table))
    yield from tables.chunks_of(table)


def train(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability of each slot per language). The table has SLOTS entries per language code."""
    rows = documents.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(
        "lang is not null and text != ''")
    languages = sorted(row.lang for row in rows.select("lang").distinct().collect())
    counts = tables.summed(rows.mapInArrow(partial(_count, languages=languages), tables.SCHEMA), len(languages) * SLOTS)
    counts = counts.reshape(len(languages), SLOTS) + 0.5
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def text_scores(texts: pa.Array, model: np.ndarray, most_grams: float) -> np.ndarray:
    """Log-likelihood of each text per language, as of at most ``most_grams`` trigrams."""
    slot, row = gram_slots(texts)
    n = np.bincount(row, minlength=len(texts))
    scores = np.stack([np.bincount(row, logp[slot], minlength=len(texts)) for logp in model], axis=1) if len(model) \
        else np.zeros((len(texts), 0))
    return scores * (np.minimum(n, most_grams) / np.maximum(n, 1))[:, None]


def _evidence(batches: Iterator[pa.RecordBatch], model, most_grams: float) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "html"):
        pages = [html or "" for html in part.column("html").to_pylist()]
        texts = pa.array([plain_text(html) for html in pages], pa.large_string())
        scores = text_scores(texts, model.value, most_grams)
        yield pa.RecordBatch.from_arrays([
            part.column("page_id"), part.column("url"),
            pa.array([declared_language(html) for html in pages], pa.string()),
            pa.array(list(scores), pa.list_(pa.float64())),
        ], ["page_id", "url", "declared", "scores"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _shares(scores: Column) -> Column:
    """Probabilities from log scores."""
    top = F.transform(F.array(F.array_max(scores)), lambda most: F.transform(scores, lambda s: F.exp(s - most)))[0]
    return F.transform(F.array(top), lambda e: F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))[0]


def _sums(pages: DataFrame, key: str, n: int) -> DataFrame:
    """Sum of the text's answers per key, one row per key: key, sums."""
    return pages.groupBy(key).agg(*[F.sum(F.col("answer")[i]).alias(f"s{i}") for i in range(n)]).select(
        key, F.array(*[F.col(f"s{i}") for i in range(n)]).alias(f"{key}_sums"))


def identify(pages: DataFrame, documents: DataFrame, most_grams: float = MOST_GRAMS, smoothing: float = SMOOTHING,
             host_weight: float = HOST_WEIGHT) -> DataFrame:
    """Per page: page_id, url, host, declared, text_language, language, confidence."""
    languages, model = train(documents)
    n = len(languages)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    if not n:
        none = F.lit(None).cast("string")
        return pages.select("page_id", "url", host_of(F.col("url")).alias("host"), none.alias("declared"),
                            none.alias("text_language"), none.alias("language"), F.lit(None).cast("double").alias("confidence"))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    found = pages.mapInArrow(partial(_evidence, model=shared, most_grams=most_grams),
                             "page_id long, url string, declared string, scores array<double>")
    host = F.col("host")
    found = Stages(pages.sparkSession).keep(
        found.withColumn("host", host_of(F.col("url"))).withColumns({
            "suffix": F.substring_index(host, ".", -1), "answer": _shares(F.col("scores"))}))

    def each(body) -> Column:
        return F.array(*[body(i) for i in range(n)])

    # Sums over all pages: one number per language.
    total = found.agg(*[F.sum(F.col("answer")[i]).alias(f"s{i}") for i in range(n)]).first()
    total = [float(x or 0.0) for x in total]
    everything = max(sum(total), 1e-9)
    # log P(value | language), smoothed towards how frequent the value is.
    for key in ("declared", "suffix"):
        own = F.aggregate(f"{key}_sums", F.lit(0.0), lambda a, b: a + b)
        evidence = _sums(found, key, n).select(key, each(lambda i, own=own, key=key: F.log(
            (F.col(f"{key}_sums")[i] + smoothing * own / everything) / (total[i] + smoothing))).alias(f"{key}_log"))
        found = found.join(evidence, key)
    # Added up once per host; wider domains are sums of their hosts, so no page is dealt out by a domain.
    hosts = _sums(found, "host", n).withColumns({"two": F.substring_index(host, ".", -2), "three": F.substring_index(host, ".", -3)})
    for key in ("two", "three"):
        hosts = hosts.join(hosts.select(key, F.col("host_sums").alias("answer")).transform(_sums, key, n), key)
    found = found.join(hosts.drop("two", "three"), "host")
    # Without the page's own answer at every level.
    found = found.withColumn("prior", each(lambda i: (F.lit(total[i]) - F.col("answer")[i] + 1.0) / (everything - 1.0 + n)))
    for key in ("two", "three", "host"):
        count = F.aggregate(f"{key}_sums", F.lit(0.0), lambda a, b: a + b) - 1.0
        found = found.withColumn("prior", each(lambda i, key=key, count=count: F.greatest(
            (F.col(f"{key}_sums")[i] - F.col("answer")[i] + host_weight * F.col("prior")[i]) / (count + host_weight), F.lit(1e-12))))
    logs = each(lambda i: F.col("scores")[i] + F.col("declared_log")[i] + F.col("suffix_log")[i] + F.log(F.col("prior")[i]))
    codes = F.array(*[F.lit(code) for code in languages])
    found = found.withColumn("final", _shares(logs))
    best, text_best = (F.array_position(c, F.array_max(c)).cast("int") for c in (F.col("final"), F.col("answer")))
    return found.select("page_id", "url", "host", "declared", F.element_at(codes, text_best).alias("text_language"),
                        F.element_at(codes, best).alias("language"), F.round(F.array_max("final"), 9).alias("confidence"))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))
