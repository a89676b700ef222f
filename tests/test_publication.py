"""Generations, guarded replacement, stage lifetimes and counts: what survives a crash, a second writer and time."""

import json
import threading
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import exclude
from tallyhouse.operators.keyed import enrich
from tallyhouse.sinks import Generations, RunCounts, StageArea, replace_if_nonempty, sweep
from tallyhouse.sinks.replace import point_to_latest
from tallyhouse.sinks.stages import OWNER, owned_folder


def values(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def table(spark, request):
    name = "publication_" + request.node.name.split("[")[0]
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_of_two_writers_one_wins(spark, tmp_path, table):
    root = str(tmp_path)
    assert replace_if_nonempty(spark.range(1), table, root).number == 1
    # Both begin from the first generation; the second to finish loses, and its rows go.
    first = replace_if_nonempty(spark.range(10, 12), table, root, based_on=1)
    second = replace_if_nonempty(spark.range(20, 23), table, root, based_on=1)
    assert first and first.number == 2 and not second and second.lost and second.rows == 3
    assert values(spark.table(table)) == [(10,), (11,)]
    assert len(list((tmp_path / "data").iterdir())) == 2 and not list((tmp_path / "drafts").iterdir())
    assert replace_if_nonempty(spark.range(30, 31), table, root).number == 3


def test_of_many_writers_at_once_one_wins(spark, tmp_path):
    generations = [Generations(spark, str(tmp_path)) for _ in range(8)]
    folders, won = [], []
    for each in generations:
        folders.append(each.attempt())
        spark.range(1).write.parquet(folders[-1])
    start = threading.Barrier(len(generations))

    def run(i):
        start.wait()
        if generations[i].commit(0, folders[i], {"writer": i}) is not None:
            won.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(generations))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == 1 and generations[0].numbers() == [1] and generations[0].latest().facts == {"writer": won[0]}


def test_old_generations_go(spark, tmp_path, table):
    root = str(tmp_path)
    for i in range(4):
        assert replace_if_nonempty(spark.range(i + 1), table, root, keep=2)
        reader = spark.table(table)
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["0000000003", "0000000004"]
    assert len(list((tmp_path / "data").iterdir())) == 2
    assert reader.count() == 4
    before = Generations(spark, root)
    assert before.read(before.get(3)).count() == 3


def test_a_run_that_dies_before_publishing_changes_nothing(spark, tmp_path, table, monkeypatch):
    root = str(tmp_path)
    assert replace_if_nonempty(spark.range(2), table, root)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(Generations, "commit", die)
        with pytest.raises(RuntimeError, match="killed"):
            replace_if_nonempty(spark.range(5), table, root)
    assert values(spark.table(table)) == [(0,), (1,)]
    # What it left is untouched while it may still be running, and goes later.
    generations = Generations(spark, root)
    assert generations.sweep(2) == [] and len(list((tmp_path / "data").iterdir())) == 2
    assert len(generations.sweep(2, abandoned_after=timedelta(0))) == 1
    assert replace_if_nonempty(spark.range(5), table, root).number == 2


def test_a_run_that_dies_between_publishing_and_switching_is_mended(spark, tmp_path, table, monkeypatch):
    import tallyhouse.sinks.replace as replace

    root = str(tmp_path)
    assert replace_if_nonempty(spark.range(2), table, root)
    real, calls = replace.point_to_latest, []

    def die_after_commit(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(*args)

    with monkeypatch.context() as broken:
        broken.setattr(replace, "point_to_latest", die_after_commit)
        with pytest.raises(RuntimeError, match="killed"):
            replace_if_nonempty(spark.range(5), table, root)
    # Published, but the table still shows the old rows: whole, and mended by the next look.
    assert values(spark.table(table)) == [(0,), (1,)]
    assert point_to_latest(spark, table, Generations(spark, root)).number == 2
    assert spark.table(table).count() == 5
    assert not replace_if_nonempty(spark.range(0), table, root) and spark.table(table).count() == 5


def test_counts_come_from_the_writing_pass(spark, tmp_path, table):
    counts = RunCounts()
    exclusions = spark.createDataFrame([(1, "r", 0, "unit", "3"), (2, "r", 0, "unit", "x"), (3, "r", 1, "unit", "4")],
                                       "ExclusionID int, ReportName string, Deleted int, Criteria string, Value string")
    rows = exclude(spark.range(20).selectExpr("id", "id % 5 as unit"), exclusions, "r", {"unit": "unit"}, counts)
    rows = enrich(rows, spark.range(8).selectExpr("id as k", "'n' as name"), "id", "k", {"name": "name"}, counts=counts, step="names")
    done = replace_if_nonempty(rows, table, str(tmp_path), counts=counts)
    assert done.counts == {"exclude unit.rows": 20, "exclude unit.kept": 16, "names.unmatched": 9, "report.rows": 16}
    assert done.rows == 16 and spark.table(table).count() == 16
    # A step that the optimizer leaves out has no count, and the others still arrive.
    counts = RunCounts()
    gone = counts.watch(spark.range(3), "gone").join(spark.range(3).filter("false").toDF("id"), "id")
    spark.sql(f"DROP TABLE {table}")
    done = replace_if_nonempty(spark.range(2).unionByName(gone), table, str(tmp_path / "second"), counts=counts)
    assert done.counts["report.rows"] == 2 and "gone.rows" not in done.counts


def test_deciding_reads_nothing_back(spark, tmp_path, table):
    """One job writes; the empty run is known from its counts."""
    tracker, group = spark.sparkContext.statusTracker(), "replace-empty"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert not replace_if_nonempty(spark.range(100).filter("id < 0"), table, str(tmp_path))
        assert len(tracker.getJobIdsForGroup(group)) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ordered_files(small, tmp_path, table):
    spark = small  # without merging of small partitions
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    done = replace_if_nonempty(spark.range(5000).selectExpr("id * 37 % 5000 as id", "'x' as v"), table, str(tmp_path), order=[F.desc("id")])
    assert done.rows == 5000 and done.counts == {"report.rows": 5000}
    files = sorted(Path(Generations(spark, str(tmp_path)).latest().folder.removeprefix("file:")).glob("part-*.parquet"))
    assert len(files) > 1
    read = [r.id for file in files for r in spark.read.parquet(str(file)).collect()]
    assert read == sorted(read, reverse=True)


def test_stages_expire_and_end_with_their_application(spark, tmp_path):
    root = str(tmp_path)
    mine, brief, other = (owned_folder(spark, kind, root, lifetime) for kind, lifetime in (
        ("stages", timedelta(days=1)), ("stages", timedelta(seconds=-1)), ("llm", timedelta(days=1))))
    marker = Path(other) / OWNER
    marker.write_text(json.dumps({**json.loads(marker.read_text()), "owner": "another-application"}))
    (marker.parent / f".{OWNER}.crc").unlink()
    (tmp_path / "not-ours").mkdir()
    assert sweep(spark, root) == [Path(brief).name]
    assert sweep(spark, root, mine=True) == [Path(mine).name]
    assert sweep(spark, root, now=datetime.now(timezone.utc) + timedelta(days=2)) == [Path(other).name]
    assert [p.name for p in tmp_path.iterdir()] == ["not-ours"]


def test_a_new_stage_puts_the_end_off(spark, tmp_path):
    area = StageArea(spark, str(tmp_path), lifetime=timedelta(hours=1))
    area.keep(spark.range(1), "first")
    marker = Path(area.folder) / OWNER
    first = json.loads(marker.read_text())["expires"]
    kept = area.keep(spark.range(3), "second")
    assert json.loads(marker.read_text())["expires"] > first and kept.count() == 3
    assert sweep(spark, str(tmp_path)) == []
