"""Chained extracts: no day is lost or doubled, whenever a run dies."""

from datetime import datetime, timedelta

import pytest

from tallyhouse.sinks import Generations
from tallyhouse.streaming import Extract, ExtractLog

NOW = datetime(2024, 5, 10, 6)
DAY = timedelta(days=1)


@pytest.fixture
def source(spark):
    """One row per hour of the window, as an extract of the hours within it; remembers what it was asked for."""
    asked = []

    def extract(low, high):
        asked.append((low, high))
        hours = spark.range(0, 24 * 45).selectExpr("timestamp_ntz'2024-04-01 00:00:00' + id * interval '1' hour as at")
        return Extract(hours.filter(f"at >= timestamp_ntz'{low}' and at < timestamp_ntz'{high}'"), low, high)

    extract.asked = asked
    return extract


def hours(log):
    return sorted(r.at for r in log.rows().collect())


def test_windows_follow_each_other(spark, tmp_path, source):
    log = ExtractLog(spark, str(tmp_path))
    assert log.mark() is None
    first = log.run(source, now=NOW)
    assert (first.low, first.high, first.rows, first.fresh) == (datetime(2024, 5, 9), datetime(2024, 5, 10), 24, True)
    assert log.mark() == datetime(2024, 5, 10)
    assert log.run(source, now=NOW) is None  # the tenth is not over
    assert [w.low.day for w in log.catch_up(source, now=NOW + 3 * DAY)] == [10, 11, 12]
    assert len(hours(log)) == 96 == len(set(hours(log)))
    by_window = {r.window_start: r["count"] for r in log.rows().groupBy("window_start").count().collect()}
    assert by_window == {datetime(2024, 5, day): 24 for day in range(9, 13)}
    assert log.rows(since=datetime(2024, 5, 10), until=datetime(2024, 5, 11)).count() == 24


def test_a_rerun_of_a_finished_window_does_nothing(spark, tmp_path, source):
    log = ExtractLog(spark, str(tmp_path))
    log.run(source, now=NOW, low=datetime(2024, 5, 1), high=datetime(2024, 5, 3))
    log.run(source, now=NOW)
    asked = len(source.asked)
    again = log.run(source, now=NOW, low=datetime(2024, 5, 1), high=datetime(2024, 5, 3))
    assert not again.fresh and again.rows == 48 and len(source.asked) == asked and len(hours(log)) == 72
    with pytest.raises(ValueError, match="mark"):  # would double the second
        log.run(source, now=NOW, low=datetime(2024, 5, 2), high=datetime(2024, 5, 3))
    with pytest.raises(ValueError, match="mark"):  # would lose the fourth
        log.run(source, now=NOW, low=datetime(2024, 5, 5))
    with pytest.raises(ValueError, match="empty"):
        log.run(source, now=NOW, high=datetime(2024, 5, 4))


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_around_the_commit(spark, tmp_path, source, monkeypatch, when):
    log = ExtractLog(spark, str(tmp_path))
    log.run(source, now=NOW, low=datetime(2024, 5, 1), high=datetime(2024, 5, 2))
    real = Generations.commit

    def die(self, *args):
        if when == "after":
            real(self, *args)
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(Generations, "commit", die)
        with pytest.raises(RuntimeError, match="killed"):
            log.run(source, now=NOW)
    # Before the commit the day is extracted again; after it the next run goes on with the day that follows.
    assert log.mark() == datetime(2024, 5, 2 if when == "before" else 3)
    log.catch_up(source, now=NOW)
    assert log.mark() == datetime(2024, 5, 10)
    found = hours(log)
    assert len(found) == len(set(found)) == 9 * 24
    assert len(log.sweep()) == 0 and len(hours(log)) == 9 * 24


def test_of_two_runs_of_a_window_one_counts(spark, tmp_path, source):
    log, other = ExtractLog(spark, str(tmp_path)), ExtractLog(spark, str(tmp_path))

    def slow(low, high):
        other.run(source, now=NOW, low=datetime(2024, 5, 9), high=datetime(2024, 5, 10))
        return source(low, high)

    window = log.run(slow, now=NOW)
    assert not window.fresh and window.high == datetime(2024, 5, 10) and len(hours(log)) == 24
    assert len(log.windows()) == 1


def test_an_empty_window_moves_the_mark(spark, tmp_path, source):
    log = ExtractLog(spark, str(tmp_path))
    window = log.run(source, now=NOW, low=datetime(2023, 1, 1), high=datetime(2023, 1, 2))
    assert window.rows == 0 and log.mark() == datetime(2023, 1, 2) and log.rows().count() == 0
    with pytest.raises(ValueError, match="no window"):
        log.rows(since=NOW)
