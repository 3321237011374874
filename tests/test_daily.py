"""Event-time facts against the batch result, with late rows, reruns and runs that break off."""

import pytest
from pyspark.sql import functions as F

from ledgerlight.streaming import daily

DDL = "k string, at timestamp, v int"


@pytest.fixture
def fact():
    return daily.DailyFact(
        rows=lambda rows: rows.filter("v <> 0"),
        keys={"k": F.col("k")},
        parts={"n": F.count("*"), "v": F.sum("v"), "top": F.max("v")},
        merged={"n": F.sum("n"), "v": F.sum("v"), "top": F.max("top")},
        at="at",
    )


@pytest.fixture
def landing(spark, tmp_path, fact):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def land(*rows):
        df = spark.createDataFrame(list(rows), DDL.replace("timestamp", "string")).withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(source)

    def run(**options):
        stream = spark.readStream.schema(DDL).options(**options).parquet(source)
        return [str(d) for d in daily.run_daily(fact, stream, spark.read.schema(DDL).parquet(source), target, "1 day")]

    def right():
        got = sorted(map(tuple, fact.read(spark, target).collect()), key=str)
        sums = fact.of_days(spark.read.schema(DDL).parquet(source)).groupBy("k").agg(F.sum("n"), F.sum("v"), F.max("top"))
        assert got == sorted(map(tuple, sums.collect()), key=str)
        return got

    return land, run, right


def test_late_rows_are_recomputed_not_lost(spark, landing):
    land, run, right = landing
    land(("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-10 10:00:00", 2), (None, "2024-01-09 23:00:00", 3), ("z", "2024-01-09 23:00:00", 0))
    assert run() == []  # within a first batch nothing is late
    assert right() == [("a", 2, 3, 2), (None, 1, 3, 3)]
    assert run() == []
    # late for a closed day, late for an open one, new
    land(("a", "2024-01-01 11:00:00", 5), ("b", "2024-01-03 00:00:00", 7), ("a", "2024-01-09 12:00:00", 1), ("a", "2024-01-11 09:00:00", 4))
    assert run() == ["2024-01-01", "2024-01-03"]
    assert right() == [("a", 5, 13, 5), ("b", 1, 7, 7), (None, 1, 3, 3)]
    land(("b", "2024-01-10 12:00:00", 8), ("b", "2024-01-03 05:00:00", 9))
    assert run() == ["2024-01-03"]
    assert ("b", 3, 24, 9) in right()


def test_the_closed_days_leave_the_state(spark, landing, tmp_path):
    """The state store would lose the late row by itself: the sums alone are too small."""
    land, run, right = landing
    land(("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-20 10:00:00", 2))
    run()
    land(("a", "2024-01-01 11:00:00", 5), ("a", "2024-01-21 11:00:00", 5))
    kept = daily.recompute_late_days
    try:
        daily.recompute_late_days = lambda *a: []
        run()
        with pytest.raises(AssertionError):
            right()
    finally:
        daily.recompute_late_days = kept
    assert run() == ["2024-01-01"]  # still noted
    right()


def test_a_run_that_broke_off_is_started_again(spark, landing, monkeypatch):
    land, run, right = landing
    land(("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-20 10:00:00", 2))
    run()
    land(("a", "2024-01-01 11:00:00", 5), ("a", "2024-01-02 11:00:00", 5), ("a", "2024-01-20 11:00:00", 5))
    with monkeypatch.context() as m:
        m.setattr(daily, "_note", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    # the sums have the files already; which rows they left out is found without them
    assert run() == ["2024-01-01", "2024-01-02"]
    right()


def test_many_batches_in_one_run(spark, landing):
    land, run, right = landing
    for day in (1, 12, 2, 24, 3, 23):
        land(("a", f"2024-01-{day:02d} 10:00:00", day), ("b", f"2024-01-{day:02d} 11:00:00", 1))
    assert {"2024-01-02", "2024-01-03"} <= set(run(maxFilesPerTrigger=1))
    assert right() == [("a", 6, 65, 24), ("b", 6, 6, 1)]


def test_open_days_are_kept_out_of_the_heap(spark, landing, tmp_path):
    """The state stores keep their rows on disk, within a bound of memory; settings of the session come back."""
    land, run, right = landing
    names = [n for n in daily.STATE if spark.conf.get(n, None) is not None] if hasattr(daily, "STATE") else []
    before = {n: spark.conf.get(n) for n in names}
    land(("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-20 10:00:00", 2))
    run()
    settings = (tmp_path / "out" / "progress-sums" / "offsets" / "0").read_text()
    assert "RocksDBStateStoreProvider" in settings
    assert {n: spark.conf.get(n) for n in names} == before
    right()


def test_a_folder_of_a_batch_has_one_file(spark, landing, tmp_path):
    land, run, _ = landing
    land(*[(f"k{i}", "2024-01-01 10:00:00", 1) for i in range(50)])
    run()
    folders = list((tmp_path / "out" / "parts").glob("event_*"))
    assert [len(list(p.glob("*.parquet"))) for p in folders] == [1]


def test_folders_of_months_hold_days(spark, landing, fact, tmp_path):
    from dataclasses import replace

    land, _, _ = landing
    land(("a", "2024-01-01 10:00:00", 1), ("a", "2024-02-20 10:00:00", 2))
    source, target = str(tmp_path / "in"), str(tmp_path / "months")
    for _ in range(2):
        stream = spark.readStream.schema(DDL).parquet(source)
        daily.run_daily(replace(fact, period="month"), stream, spark.read.schema(DDL).parquet(source), target, "1 day")
        land(("a", "2024-01-02 10:00:00", 4))
    assert {p.name for p in (tmp_path / "months" / "parts").glob("event_*")} == {"event_period=2024-01-01", "event_period=2024-02-01"}
    assert [tuple(r) for r in fact.read(spark, target).collect()] == [("a", 3, 7, 4)]
