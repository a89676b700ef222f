"""The trie of conversation prefixes: every distinct sequence of first turns, who begins with it and what sharing it saves.

A prefix is known by the exclusive-or of hashes of its turns, each mixed with its place (two of 64 bits), so that digests of blocks
add up to digests of prefixes. Conversations are grouped by successive blocks of ``BLOCK`` turns first: a group is one digest of
all turns up to the end of a block, and however many conversations it holds it is one row from then on. Turn boundaries
inside a block are refined after that, from one row per distinct block. Where all that enter a block have the same one, its turns are a
chain and are read off; only blocks where siblings diverge are taken apart and grouped turn by turn.

Figures over subtrees need no walk: with S the words before the first node that a conversation leads (is smallest in), the saved
tokens of a node are the sum of S over its other members less the words before the node for each of them; leaves are counted by their
leading conversations. Both are sums over members, made with the same two steps.

A conversation may hold a third of all turns: turns are put in order by range over the cluster and numbered per task, and digests
before a block are summed in spans of ``SPAN`` blocks first. Copies of a conversation are one group; the ids that end in a
node are hashed from sorted runs, as a stream.

Defined results: rows without a conv_id belong to no conversation; turns of one number follow each other by role and text in
code point order, repeated rows count each; null roles and texts are empty; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import Stages, read, word_count

BLOCK = 8
SPAN = 1024
FAMILY = 20  # conversations of one family share the turns of its first
SHARED_TURNS = 4  # fewer than so many of them
_IDS_AT_ONCE = 8192
_KEY = ["depth", "p1", "p2"]
_PARENT = ["up", "u1", "u2"]


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``at``: the place of each turn among those of its conversation in the task, from 0."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
        lengths = np.diff(np.append(starts, len(conv)))
        at = np.arange(len(conv)) - np.repeat(starts, lengths)
        if last == conv[0]:
            at[: lengths[0]] += seen
        last, seen = conv[-1], at[-1] + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "at"])


def ordered_turns(conversations: DataFrame, stages: Stages) -> DataFrame:
    """conv_id, place (from 0), two hashes of role and text, words: the turns of each conversation in order."""
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("role", "text")],
        # Equal rows may be put in any order; this lets a row that is repeated very often be dealt to several tasks.
        F.monotonically_increasing_id().alias("copy"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    narrow = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("part"), "conv_id", F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(1), "role", "text").alias("t2"), word_count(F.col("text")).alias("words"))
    turns = stages.keep(narrow.mapInArrow(_number, "part int, conv_id long, t1 long, t2 long, words long, at long"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    # Only the first conversation of a task can have begun in an earlier one: at most one row per task.
    begun = runs.withColumn("before", F.sum("n").over(before)).filter("before > 0").drop("n")
    place = (F.col("at") + F.coalesce("before", F.lit(0))).alias("place")
    return turns.join(F.broadcast(begun), ["conv_id", "part"], "left").select("conv_id", place, "t1", "t2", "words")


def rebuilt(turns: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first turns from the first of their family, and these by conv_id with their length.

    The turns taken over stand for as many own ones, or for those there are.
    """
    first = F.when(F.col("place") < SHARED_TURNS - 1, F.struct("place", "t1", "t2", "words"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"), F.sort_array(F.collect_list(first)).alias("opening"))
    openings = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.col("opening").alias("taken"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int")
    convs = (
        convs.select("conv_id", "own", shared.alias("shared"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
        .join(openings, "family", "left").withColumn("taken", F.expr("coalesce(slice(taken, 1, shared), array())"))
        .selectExpr("conv_id", "shared", "taken", "size(taken) + greatest(own - shared, 0L) as length")
    )
    convs = stages.keep(convs)
    opened = convs.select("conv_id", "length", F.inline("taken"))
    rest = turns.join(convs.selectExpr("conv_id", "length", "shared", "size(taken) as kept"), "conv_id").filter(
        "place >= shared").selectExpr("conv_id", "length", "place - shared + kept as place", "t1", "t2", "words")
    return opened.unionByName(rest), convs.select("conv_id", "length")


def blocks_of(turns: DataFrame) -> DataFrame:
    """Per conversation and block: its turns (e1, e2, w), the prefix before (up, u1, u2, w0) and at its end (depth, p1, p2)."""
    block = F.col("place") - F.col("place") % BLOCK
    turn = F.struct("place", F.xxhash64("t1", "place").alias("e1"), F.xxhash64("t2", "place").alias("e2"), F.col("words").alias("w"))
    blocks = turns.groupBy("conv_id", block.alias("up")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.first("length").alias("length")
    ).selectExpr(
        "conv_id", "up", "length", f"up div {BLOCK * SPAN} as span", "turns",
        *[f"aggregate(turns.e{i}, 0L, (a, x) -> a ^ x) as d{i}" for i in (1, 2)],
        "aggregate(turns.w, 0L, (a, x) -> a + x) as dw",
    )
    sums = {"1": "bit_xor(d1)", "2": "bit_xor(d2)", "w": "sum(dw)"}
    earlier = "rows between unbounded preceding and 1 preceding"
    spans = blocks.groupBy("conv_id", "span").agg(*[F.expr(f"{total} as d{name}") for name, total in sums.items()]).selectExpr(
        "conv_id", "span", *[f"{total} over (partition by conv_id order by span {earlier}) as s{name}" for name, total in sums.items()])
    within = blocks.selectExpr("*", *[
        f"coalesce({total} over (partition by conv_id, span order by up {earlier}), 0L) as b{name}" for name, total in sums.items()])
    return within.join(spans.filter("span > 0"), ["conv_id", "span"], "left").selectExpr(
        "conv_id", "length", "up", *[f"b{i} ^ coalesce(s{i}, 0L) as u{i}" for i in (1, 2)], "bw + coalesce(sw, 0L) as w0", "turns",
        "up + size(turns) as depth", *[f"b{i} ^ coalesce(s{i}, 0L) ^ d{i} as p{i}" for i in (1, 2)])


def _turn_nodes(groups: DataFrame, figures: list[str]) -> DataFrame:
    """A row for each turn of each block."""
    def upto(i: int, end: str) -> str:
        return f"u{i} ^ aggregate(slice(turns.e{i}, 1, {end}), 0L, (a, x) -> a ^ x)"

    return groups.withColumn("j", F.explode(F.expr("sequence(1, size(turns))"))).selectExpr(
        "up + j as depth", *[f"{upto(i, 'j')} as p{i}" for i in (1, 2)], "up + j - 1 as up",
        *[f"{upto(i, 'j - 1')} as u{i}" for i in (1, 2)], "w0 + aggregate(slice(turns.w, 1, j - 1), 0L, (a, x) -> a + x) as before", *figures)


def refined(groups: DataFrame, sums: list[str]) -> DataFrame:
    """Nodes inside the blocks of the groups, with the sums and the smallest ``lead`` of their members.

    A block that all who come that far have is a chain; the others are taken apart and grouped turn by turn.
    """
    figures = [*sums, "lead"]
    rest = [name for name in groups.columns if name not in _PARENT]
    alone = groups.groupBy(*_PARENT).agg(F.count("*").alias("blocks"), F.first(F.struct(*rest)).alias("only")).filter(
        "blocks = 1").select(*_PARENT, "only.*")
    diverging = groups.join(alone.select(*_PARENT), _PARENT, "left_anti")
    apart = _turn_nodes(diverging, figures).groupBy(*_KEY).agg(
        *[F.first(name).alias(name) for name in (*_PARENT, "before")], *[F.sum(name).alias(name) for name in sums],
        F.min("lead").alias("lead"))
    return _turn_nodes(alone, figures).unionByName(apart)


def _grouped(blocks: DataFrame, lead: str, sums: dict[str, str]) -> DataFrame:
    same = [*_PARENT, "w0", "turns"]
    return blocks.groupBy(*_KEY).agg(
        *[F.first(name).alias(name) for name in same], F.expr(f"min({lead}) as lead"), *[F.expr(f"sum({x}) as {name}") for name, x in sums.items()])


def _root(convs: DataFrame, lead: str, sums: dict[str, str]) -> DataFrame:
    return convs.agg(F.expr(f"min({lead}) as lead"), *[F.expr(f"sum({x}) as {name}") for name, x in sums.items()]).filter(
        "lead is not null").selectExpr(
        "0L as depth", "0L as p1", "0L as p2", "cast(null as long) as up", "cast(null as long) as u1", "cast(null as long) as u2",
        "0L as before", *sums, "lead")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node in order, joined by commas, some thousands at a time."""
    for whole in batches:
        for low in range(0, whole.num_rows, _IDS_AT_ONCE):
            batch = whole.slice(low, _IDS_AT_ONCE)
            keys = np.stack([batch.column(name).to_numpy() for name in _KEY])
            ids = batch.column("conv_id").to_pylist()
            starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts, np.append(starts[1:], len(ids)), strict=True)]
            picked = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name).take(picked) for name in (*_KEY, "conv_id")], pa.array(texts, pa.string())], [*_KEY, "conv_id", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its runs of ids in order; only the current node's state is held."""
    current, state = None, None

    def rows(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array([key[i] for key, _ in done], pa.int64()) for i in range(3)], pa.array([digest for _, digest in done], pa.string())],
            [*_KEY, "ends_sha256"])

    for batch in batches:
        done = []
        columns = [batch.column(name).to_pylist() for name in (*_KEY, "ids")]
        for *key, ids in zip(*columns, strict=True):
            if key == current:
                state.update(b"," + ids.encode())
                continue
            if current is not None:
                done.append((current, state.hexdigest()))
            current, state = key, hashlib.sha256(ids.encode())
        if done:
            yield rows(done)
    if current is not None:
        yield rows([(current, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node in which conversations end the SHA-256 of their ids, ascending and joined by commas."""
    order = [*_KEY, "conv_id"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _join_ids, "depth long, p1 long, p2 long, conv_id long, ids string")
    return runs.repartition(*_KEY).sortWithinPartitions(*order).mapInArrow(
        _hash_ids, "depth long, p1 long, p2 long, ends_sha256 string")


def _child_counts(nodes: DataFrame) -> DataFrame:
    return nodes.filter("up is not null").groupBy(*[F.col(up).alias(key) for up, key in zip(_PARENT, _KEY, strict=True)]).agg(
        F.count("*").alias("n_children"))


def trie(turns: DataFrame, convs: DataFrame, stages: Stages) -> DataFrame:
    """One row per prefix of sequences of turns (conv_id, length, place, t1, t2, words); ``convs`` lists all ids with their length.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    blocks = stages.keep(blocks_of(turns))
    members = {"n": "1L"}
    nodes = stages.keep(refined(_grouped(blocks, "conv_id", members), ["n"]).unionByName(_root(convs, "conv_id", members)))
    # What each conversation leads: the words before its first node, and whether one of its nodes is a leaf.
    leads = nodes.join(_child_counts(nodes), _KEY, "left").groupBy(F.col("lead").alias("conv_id")).agg(
        F.expr("min_by(before, depth) as led_after"), F.expr("max(if(n_children is null, 1L, 0L)) as leaf"))
    words = blocks.groupBy("conv_id").agg(F.expr("max(w0 + aggregate(turns.w, 0L, (a, x) -> a + x)) as words"))
    shares = stages.keep(convs.join(words, "conv_id", "left").join(leads, "conv_id", "left").selectExpr(
        "conv_id", "length", "coalesce(led_after, words, 0L) as s", "coalesce(leaf, 0L) as leaf"))
    sums = {"n": "1L", "all_s": "s", "n_leaves": "leaf"}
    lead = "struct(conv_id, s)"
    groups = _grouped(blocks.join(shares.drop("length"), "conv_id"), lead, sums)
    found = stages.keep(refined(groups, list(sums)).unionByName(_root(shares, lead, sums)))
    ends = blocks.filter("depth = length").select("conv_id", *_KEY).unionByName(
        convs.filter("length = 0").selectExpr("conv_id", "0L as depth", "0L as p1", "0L as p2"))
    parents = found.select(*[F.col(key).alias(up) for key, up in zip(_KEY, _PARENT, strict=True)],
                           F.col("lead.conv_id").alias("parent_conv_id"))
    return (
        found.join(_child_counts(found), _KEY, "left").join(end_digests(ends), _KEY, "left").join(parents, _PARENT, "left")
        .selectExpr(
            "lead.conv_id as conv_id", "depth", "parent_conv_id", "n as n_convs", "coalesce(n_children, 0L) as n_children", "n_leaves",
            "all_s - lead.s - (n - 1) * before as saved_tokens",
            f"coalesce(ends_sha256, '{hashlib.sha256(b'').hexdigest()}') as ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    stages = Stages(spark)
    turns, convs = rebuilt(ordered_turns(read(spark, sf_dir, "conversations"), stages), stages)
    return trie(turns, convs, stages)


_CRC = (  # CRC-32 of an id's decimal digits, bit by bit
    "xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::ubigint)), "
    "lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), "
    "lambda a, z: case when a % 2 = 1 then xor(a // 2, 3988292384::ubigint) else a // 2 end)), 4294967295::ubigint)")

OP11_SQL = rf"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as t,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
    from conversations where conv_id is not null
), convs as (
    select conv_id, count(*) as own from turns group by conv_id
), shared as (
    select conv_id, own, ({_CRC} % {SHARED_TURNS})::bigint as h, conv_id - conv_id % {FAMILY} as family from convs
), known as (
    select s.conv_id, h, family, least(h, coalesce(b.own, 0)) as kept from shared s left join convs b on b.conv_id = s.family
), made as (
    select k.conv_id, place, role, t from known k join turns b on b.conv_id = k.family where place < kept
    union all
    select k.conv_id, place - h + kept, role, t from known k join turns using (conv_id) where place >= h
), hashed as (
    select conv_id, place, sha256(length(role)::varchar || '.' || role || t) as turn, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as words
    from made
), paths as (
    select conv_id, place + 1 as depth, words,
           string_agg(turn, '') over (partition by conv_id order by place) as path,
           string_agg(turn, '') over (partition by conv_id order by place rows between unbounded preceding and 1 preceding) as parent
    from hashed
    union all select conv_id, 0, 0, '', null from convs
), members as (
    select conv_id, depth, words, sha256(path) as node, case when depth > 0 then sha256(coalesce(parent, '')) end as parent,
           depth = max(depth) over (partition by conv_id) as last from paths
), nodes as (
    select node, any_value(parent) as parent, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
           (count(*) - 1) * any_value(words) as saved,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '')) as ends_sha256
    from members group by node
), children as (
    select parent, count(*) as n from nodes where parent is not null group by parent
), below as (
    select distinct a.node, b.node as sub from members a join members b on a.conv_id = b.conv_id and b.depth >= a.depth
), sums as (
    select below.node, sum(saved) as saved, sum(case when children.n is null then 1 else 0 end) as leaves
    from below join nodes on nodes.node = sub left join children on children.parent = sub group by below.node
)
select v.conv_id, v.depth::bigint as depth, up.conv_id as parent_conv_id, v.n_convs::bigint as n_convs, coalesce(children.n, 0)::bigint as n_children,
       sums.leaves::bigint as n_leaves, sums.saved::bigint as saved_tokens, v.ends_sha256
from nodes v join sums on sums.node = v.node left join nodes up on up.node = v.parent left join children on children.parent = v.node
"""
