"""Mix sources to target weights in fixed-length blocks of words; built-in functions only.

1. The documents of a source are laid end to end and cut into blocks of ``block_words`` words; the last may be shorter.
2. Sources in order of code points, null last, weigh 3, 1, 2, repeating. They share 150 % of all words; a target stops at
   twice its source's size and the excess is shared again by weight (water filling, one ordered pass).
3. A target is a number of slots: full passes over the source's blocks, and the rest of a pass. Each slot draws its output
   shard, so the counts per shard are multinomial, given that every source meets its target over all shards. The counts
   say which slot numbers of a source a shard has.
4. A slot number is a pass and a place in it; a permutation of the source's block numbers per pass (swap-or-not rounds, which
   permute any number of blocks without a table) turns the place into a block, and blocks join slots by number.

Work is spread by blocks and slots, not by source: a source with a third of all rows is laid out in about as many buckets
of documents as a bucket has documents, whose sizes are added up first, and its slots are made from many short ranges.

Defined results: a null or empty text has no words and takes none; repeated rows are documents of their own; null is a
source; an empty table gives no rows. Only doc_id, text and the source column are read. The same rows give the same
mix, in any order and partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import Stages, read, row_key, shuffle_partitions, word_count

BLOCK_WORDS = 32
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SHARD_SLOTS = 4096
SEED = 17
ROUNDS = 12
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
LEADING_SPACE = r"^[\x20\x09-\x0D]+"
_RANGE = 4096
_PRIME = 2**31 - 1


def _source_key(source: str) -> Column:
    """Sources as text that orders them by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("~"))


def layout(documents: DataFrame, source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """Each document's place among the words of its source: doc_id, dk, th, sk (source), size, start."""
    rows = row_key(documents, source, *carry).select(
        "doc_id", "dk", "th", _source_key(source).alias("sk"), word_count(F.col("text")).alias("size"), *carry)
    # An odd number near the root of the rows: buckets are small, and so is the list of them.
    buckets = 2 * (math.isqrt(documents.count()) // 2) + 1
    spread = F.when(F.col("doc_id").isNull(), F.col("th")).otherwise(F.col("dk"))
    rows = rows.withColumn("bucket", F.pmod(spread, F.lit(buckets)))
    before = Window.partitionBy("sk").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("sk", "bucket").agg(F.sum("size").alias("words")).select(
        "sk", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("sk", "bucket").orderBy("dk", "th").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["sk", "bucket"]).select(
        "doc_id", "dk", "th", "sk", "size", (F.col("offset") + F.col("inside")).alias("start"), *carry)


def targets(placed: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: sk, source_size, target, blocks, slots. One narrow row per source is ordered in one task."""
    sizes = placed.groupBy("sk").agg(F.sum("size").alias("source_size"))
    alike = Window.orderBy("sk")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(alike) - 1, len(weights)) + 1).cast("int"))
    every = Window.partitionBy()
    by_room = Window.orderBy(F.col("source_size") * float(MOST) / F.col("weight"), "sk")
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    # With all sources of less room stopped at their limit, the level that shares the rest by weight.
    level = (F.sum("source_size").over(every) * SHARE - F.coalesce(F.sum(F.col("source_size") * MOST).over(earlier), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    open_ = F.col("source_size") * float(MOST) / F.col("weight") >= F.col("level")
    shared = (
        sizes.withColumn("weight", weight).withColumn("level", level).withColumn("order", F.row_number().over(by_room))
        .withColumn("final", F.min_by(F.when(open_, F.col("level")), F.when(open_, F.col("order"))).over(every))
        .withColumn("target", F.least(F.col("source_size") * float(MOST), F.col("final") * F.col("weight")))
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor((F.col("target") - F.col("passes") * F.col("source_size")) / F.lit(block_words) + 0.5)
    return (
        shared.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block_words)))
        .withColumn("passes", passes)
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.least(rest, F.col("blocks")))
        .select("sk", "source_size", "target", "blocks", "slots")
    )


def _ranges(count: Column) -> Column:
    """0, 1, ... up to a count, exclusive, as an array that is empty for 0."""
    return F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.array().cast("array<bigint>"))


def shard_counts(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The drawn numbers of slots per source and output shard, and the first slot number of each: sk, shard, count, begin."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    # Short ranges first, dealt out evenly, then their slots: no task makes all slots of a large source.
    tasks = shuffle_partitions(sources.sparkSession)
    parts = sources.select("sk", "slots", F.explode(_ranges(F.ceil(F.col("slots") / F.lit(_RANGE)))).alias("part")).repartition(
        tasks, "sk", "part")
    draws = parts.select("sk", F.explode(_ranges(F.least(F.lit(_RANGE), F.col("slots") - F.col("part") * _RANGE))).alias("i"), "part")
    drawn = draws.select("sk", F.pmod(F.xxhash64(F.lit(seed), "sk", F.col("part") * _RANGE + F.col("i")), F.lit(shards)).alias("shard"))
    earlier = Window.partitionBy("sk").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return drawn.groupBy("sk", "shard").agg(F.count("*").alias("count")).withColumn(
        "begin", F.coalesce(F.sum("count").over(earlier), F.lit(0)))


def _keys(part: str, seed: int) -> Column:
    """One number under 2^28 per round, fixed by source and pass."""
    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda r: F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.col("sk"), F.col("pass").cast("string"), r.cast("string"), F.lit(f"{part}{seed}"))), 1, 7), 16, 10).cast("long"))


def permuted(place: Column, blocks: Column, turn: Column, factor: Column, shift: Column) -> Column:
    """Swap-or-not: in each round a place and its mirror image are swapped or not, by a bit of the larger of both."""
    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.get(turn, r) - x, blocks)
        bit = ((F.greatest(x, mirror) % _PRIME) * F.get(factor, r) + F.get(shift, r)) % _PRIME
        return F.when(F.floor(bit / 32768) % 2 == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), place, step)


def slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """Every slot of the mix: sk, shard, pass, block."""
    counts = shard_counts(sources, shard_slots, seed)
    passes = sources.select("sk", "blocks", F.explode(_ranges(F.ceil(F.col("slots") / F.col("blocks")))).alias("pass")).filter(
        "blocks > 0").withColumns({"turn": _keys("t", seed), "factor": _keys("f", seed), "shift": _keys("s", seed)})
    counts = counts.repartition(shuffle_partitions(sources.sparkSession), "sk", "shard")
    numbers = counts.select("sk", "shard", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("count") - 1)).alias("slot"))
    numbers = numbers.join(sources.select("sk", "blocks"), "sk").withColumn("pass", F.floor(F.col("slot") / F.col("blocks"))).drop("blocks")
    return numbers.join(passes, ["sk", "pass"]).select(
        "sk", "shard", "pass", permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("turn"), F.col("factor"),
                                        F.col("shift")).alias("block"))


def pieces(placed: DataFrame, block_words: int, *carry: str) -> DataFrame:
    """The part of each block that a document fills: block, and its first word and number of words in the document."""
    last = F.floor((F.col("start") + F.col("size") - 1) / F.lit(block_words))
    cut = placed.filter("size > 0").select("sk", "dk", "th", "start", "size", *carry, F.explode(
        F.sequence(F.floor(F.col("start") / F.lit(block_words)), last)).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.withColumn("word", begin - F.col("start")).withColumn("words", end - begin)


def mix(documents: DataFrame, source: str = "source", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words that the mix takes of it)."""
    placed = Stages(documents.sparkSession).keep(layout(documents, source))
    sources = targets(placed, block_words)
    times = slots(sources, seed=seed).groupBy("sk", "block").agg(F.count("*").alias("times"))
    parts = pieces(placed, block_words, "doc_id").join(times, ["sk", "block"], "left")
    taken = parts.groupBy("sk", "dk", "th", "start", "doc_id", "size").agg(
        F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    empty = placed.filter("size = 0").select("sk", "dk", "th", "start", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(empty).join(sources, "sk").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, source: str = "source", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as documents, all their columns: one row per document and pass that takes of it.

    A document taken whole keeps its text. Else the pass takes as many words as its blocks hold of the document, in one run from
    where the first of these begins (or as late as the words last), so that no text has holes; white space between
    its words stays. ``n_chars`` follows.
    """
    rest = [c for c in documents.columns if c not in ("doc_id", "text")]
    given = documents.withColumn("__rest", F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("__none")))
    placed = Stages(documents.sparkSession).keep(layout(given, source, ("__rest",)))
    sources = targets(placed, block_words)
    taken = pieces(placed, block_words, "doc_id", "__rest").join(slots(sources, seed=seed), ["sk", "block"])
    # The row itself is found again by its place, which is its own.
    per_pass = taken.groupBy("sk", "dk", "th", "start", "pass").agg(F.sum("words").alias("got"), F.min("word").alias("word"))
    whole = placed.filter("size > 0").join(per_pass, ["sk", "dk", "th", "start"]).withColumn(
        "word", F.least("word", F.col("size") - F.col("got")))
    texts = row_key(documents).select("dk", "th", "text").dropDuplicates(["dk", "th"])
    # Words with the white space before them, so that a run of them is a piece of the text.
    words = F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))
    run = F.array_join(F.slice(words, F.col("word").cast("int") + 1, F.col("got").cast("int")), "")
    part = F.regexp_replace(run, LEADING_SPACE, "")
    out = whole.join(texts, ["dk", "th"]).withColumn("text", F.when(F.col("got") == F.col("size"), F.col("text")).otherwise(part))
    columns = {"doc_id": F.col("doc_id").cast(documents.schema["doc_id"].dataType), "text": F.col("text"),
               **{c: F.col("__rest").getField(c) for c in rest}}
    if "n_chars" in rest:
        columns["n_chars"] = F.length("text").cast(documents.schema["n_chars"].dataType)
    return out.select(*[columns[c].alias(c) for c in documents.columns])


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


def _rounds_sql() -> str:
    key = "('0x' || substr(md5(sk || '|' || pass || '|{r}|{part}" + str(SEED) + "'), 1, 7))::bigint"
    sql = "select sk, blocks, slot // blocks as pass, slot % blocks as x from slots"
    for r in range(ROUNDS):
        turn, factor, shift = (key.format(r=r, part=part) for part in "tfs")
        sql = f"select *, (({turn} - x) % blocks + blocks) % blocks as y{r} from ({sql})".replace("- x)", "- x)")
        sql = (f"select sk, blocks, pass, case when (((greatest(x, y{r}) % {_PRIME}) * {factor} + {shift}) % {_PRIME}) // 32768 % 2 = 1 "
               f"then y{r} else x end as x from ({sql})")
    return sql


OP8_SQL = f"""
with docs as (
  select doc_id, coalesce('=' || source, '~') as sk, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents
), placed as (
  select *, coalesce(sum(size) over (partition by sk
      order by doc_id % (2 * (floor(sqrt((select count(*) from docs)))::bigint // 2) + 1), doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from docs
), weighed as (
  select sk, sum(size)::bigint as source_size, [3, 1, 2][((row_number() over (order by sk)) - 1) % 3 + 1] as weight from docs group by sk
), levels as (
  select *, row_number() over w as pos, (sum(source_size) over () * 1.5::double
      - coalesce(sum(source_size * 2) over (w rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0)) as level
  from weighed window w as (order by source_size * 2::double / weight, sk)
), sources as (
  select sk, source_size, least(source_size * 2::double, weight * (select level from levels
      where source_size * 2::double / weight >= level order by pos limit 1)) as target, (source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} as blocks
  from levels
), counted as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from sources
), slots as (
  select sk, blocks, unnest(range(passes * blocks + least(blocks, floor((target - passes * source_size) / {BLOCK_WORDS} + 0.5)::bigint))) as slot
  from counted where blocks > 0
), blocks as (select sk, x as block, count(*) as times from ({_rounds_sql()}) group by 1, 2),
parts as (
  select doc_id, sk, block, least(start + size, (block + 1) * {BLOCK_WORDS}) - greatest(start, block * {BLOCK_WORDS}) as words
  from (select *, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) as block from placed where size > 0)
), taken as (select doc_id, sum(words * times)::bigint as taken from parts join blocks using (sk, block) group by 1)
select doc_id, size::bigint as size, source_size, target, coalesce(taken, 0)::bigint as taken
from docs join sources using (sk) left join taken using (doc_id)
"""
