"""Quality rules over lines that many documents of a host share; built-in functions only.

Lines are compared in lower case with white space reduced to single spaces. Per host (``host`` column, null is a host of
its own) a line is common when more than ``most_documents`` documents have it, however large the host, and on a smaller host
already when more than ``min_documents`` documents and more than ``max_share`` of the host's have it; documents
with the same text count once. Common lines are removed. A document is rejected when a base rule fails
(fewer than 20 words, or more than 30 % of them in repeated 8-word windows) or when it is depleted: less than ``least_left``
of its words are left.

Counts are combined before they are shuffled, so a line in a third of all documents is one counter; only
lines that are common are joined back.

Defined results: a null or empty text has no words, no lines and fails the base rules; repeated rows are given back as
often as they come and count as one document; null hosts form one host. Only doc_id, text and the host column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import LAST_ID, WHITE, WORD, keyed, let, read, row_key, unused, word_count

REPEAT_WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
MIN_DOCUMENTS = 5
MAX_SHARE = 0.1
MOST_DOCUMENTS = 10
LEAST_LEFT = 0.5


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, WHITE, "")) > 0)


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal(line))


def repeated_window_words(words: Column, size: int = REPEAT_WINDOW) -> Column:
    """Words inside windows of ``size`` words that are found twice or more in the array, the first included."""
    zero = F.lit(0)

    def covered(places: Column) -> Column:
        start = F.struct(zero.alias("until"), zero.alias("total"))
        return F.aggregate(places, start, lambda seen, at: F.struct(
            (at + size).alias("until"), (seen["total"] + at + size - F.greatest(at, seen["until"])).alias("total")),
            lambda seen: seen["total"])

    def places(sorted_: Column) -> Column:
        # Equal windows are neighbours after sorting.
        def own(i: Column) -> Column:
            here = F.get(sorted_, i)
            same = (here["h"] == F.get(sorted_, i - 1)["h"]) | (here["h"] == F.get(sorted_, i + 1)["h"])
            return F.when(F.coalesce(same, F.lit(False)), here["i"])

        return F.array_sort(F.filter(F.transform(F.sequence(zero, F.size(sorted_) - 1), own), lambda i: i.isNotNull()))

    def repeats(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), zero).otherwise(
            let(pairs, lambda sorted_: covered(places(sorted_))))

    def windows(codes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(codes) - size + 1), lambda i: F.xxhash64(F.slice(codes, i, size)))

    enough = let(F.transform(words, lambda word: F.xxhash64(word)), lambda codes: let(windows(codes), repeats))
    return F.when(F.size(words) >= size, enough).otherwise(zero).cast("long")


def base_statistics(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    given = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(given, F.lit(WORD), F.lit(0))
    return let(words, lambda found: F.struct(
        F.size(found).cast("long").alias("n_words"),
        F.length(F.translate(given, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(given) - F.length(F.translate(given, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines_of(given), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_window_words(found).alias("n_repeat_words"),
    ))


def common_lines(documents: DataFrame, host: str = "source", most_documents: int = MOST_DOCUMENTS,
                 min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    """Hashes of the lines that too many distinct documents of a host have: host, line, documents."""
    rows = row_key(documents, host).select(F.col(f"`{host}`").alias("host"), "th", "text").filter("text is not null")
    hosts = rows.select("host", "th").distinct().groupBy("host").agg(F.count("*").alias("of"))
    lines = rows.select("host", "th", F.explode(F.array_distinct(
        F.transform(lines_of(F.col("text")), line_hash))).alias("line"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("documents")).filter(
        F.col("documents") > min(min_documents, most_documents))
    of_host = (F.col("documents") > min_documents) & (F.col("documents") > F.lit(max_share) * F.col("of"))
    return counts.join(hosts, counts["host"].eqNullSafe(hosts["host"])).filter(
        (F.col("documents") > most_documents) | of_host).select(counts["host"], "line", "documents")


def _doc_lines(documents: DataFrame, host: str) -> DataFrame:
    """The distinct lines of each document with the words that they hold in it."""
    rows = row_key(documents, host)
    lines = rows.select(F.col(f"`{host}`").alias("host"), "dk", "th", F.explode(F.transform(
        lines_of(F.coalesce("text", F.lit(""))), lambda line: F.struct(line_hash(line).alias("line"), word_count(line).alias("n")))).alias("l"))
    return lines.select("host", "dk", "th", "l.line", "l.n")


def judge(documents: DataFrame, host: str = "source", most_documents: int = MOST_DOCUMENTS,
          least_left: float = LEAST_LEFT) -> DataFrame:
    """Per document: doc_id, dk, th, the base statistics, base_failed, n_removed, common (hashes of removed lines), kept."""
    common = common_lines(documents, host, most_documents).select(
        F.col("host").alias("on_host"), F.col("line").alias("on_line"))
    lines = _doc_lines(documents, host)
    gone = lines.join(common, lines["host"].eqNullSafe(common["on_host"]) & (lines["line"] == common["on_line"]))
    # Rows repeated in id and text have every line as often as they come.
    gone = gone.groupBy("dk", "th").agg(F.sum("n").alias("gone"), F.collect_set("line").alias("common"))
    again = documents.groupBy(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("dk"),
                              F.xxhash64("text").alias("th")).agg(F.count("*").alias("times"))
    gone = gone.join(again, ["dk", "th"]).select("dk", "th", "common", F.expr("gone div times").alias("gone"))
    stats = row_key(documents).select("doc_id", "dk", "th", base_statistics(F.col("text")).alias("s")).select(
        "doc_id", "dk", "th", "s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed")
    return (
        stats.join(gone, ["dk", "th"], "left")
        .withColumn("n_removed", F.coalesce("gone", F.lit(0)).cast("long"))
        .withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= F.lit(least_left) * F.col("n_words")))
        .drop("gone")
    )


def without_rejected(documents: DataFrame, host: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns, without their common lines; ``n_chars`` follows the text."""
    frame, dk, th = keyed(documents)
    gone = unused(documents, "__common")
    verdict = judge(documents, host).filter("kept").select(
        F.col("dk").alias(dk), F.col("th").alias(th), F.col("common").alias(gone)).dropDuplicates([dk, th])
    stay = F.filter(F.split("text", "\n", -1), lambda line: ~(
        (F.length(F.translate(line, WHITE, "")) > 0) & F.array_contains(F.col(gone), line_hash(line))))
    joined = frame.join(verdict, [dk, th])
    changed = joined.withColumn("text", F.when(F.size(gone) > 0, F.array_join(stay, "\n")).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in documents.columns])


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed")


OP1_SQL = r"""
with cut as (
  select doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from documents
), windows as (
  select doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') as key
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from cut where len(w) >= 8)
), twice as (select doc_id, i, count(*) over (partition by doc_id, key) as k from windows),
repeats as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice where k > 1) group by 1
), lines as (
  select doc_id, source, t, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) as line,
    len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as n
  from (select doc_id, source, t, unnest(ls) as l from cut)
), hosts as (select source, count(distinct text) as n from documents group by 1),
common as (
  select c.source, line from (select source, line, count(distinct t) as k from lines group by 1, 2) c
  join hosts h on c.source is not distinct from h.source where k > 10 or (k > 5 and k > 0.1 * h.n)
), gone as (
  select doc_id, sum(n) as n from lines l join common c on l.source is not distinct from c.source and l.line = c.line group by 1
), base as (
  select cut.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(repeats.n, 0)::bigint as n_repeat_words,
    coalesce(gone.n, 0)::bigint as n_removed
  from cut left join repeats using (doc_id) left join gone using (doc_id)
), failed as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base)
select *, not base_failed and n_words - n_removed >= 0.5 * n_words as kept from failed
"""
