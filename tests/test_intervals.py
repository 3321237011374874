import re
import random

import pytest
from casebook import seconds
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.operators import intervals as iv
from ledgerlight.operators import ordered

LO, HI = "2024-01-01 10:00:00", "2024-01-03 02:00:00"


def test_completeness_window_is_what_every_feed_covers(frame, rows):
    a = frame("t timestamp", ("2024-01-01 00:30:00",), ("2024-01-05 10:59:00",))
    b = frame("s timestamp, e timestamp", ("2024-01-01 01:10:00", "2024-01-01 02:00:00"), ("2024-01-02 00:00:00", "2024-01-04 09:30:00"))
    empty = a.filter("false")
    window = iv.completeness_window([(a, "t", "t"), (b, "s", "e"), (empty, "t", "t")])
    assert rows(window) == [("2024-01-01 02:00:00", "2024-01-04 09:00:00")]
    assert iv.resolve_window(window) == ("2024-01-01 02:00:00", "2024-01-04 09:00:00")


def test_an_empty_window_is_refused(frame):
    nothing = frame("t timestamp", ("2024-01-01",)).filter("false")
    with pytest.raises(ValueError, match="no common window"):
        iv.resolve_window(iv.completeness_window([(nothing, "t", "t")]))


def test_states_are_runs_and_seeded_from_before(frame, rows):
    events = frame(
        "w string, t timestamp, n int",
        ("a", "2023-11-01 00:00:00", 2),  # ON long before the window, still ON at its start
        ("a", "2024-01-01 11:00:00", 3),  # still ON: no new run
        ("a", "2024-01-01 12:00:00.100", 0),
        ("a", "2024-01-01 12:00:00.900", 1),  # last one of the second counts
        ("a", "2024-01-01 13:00:00", None),  # unknown counts as OFF
        ("a", "2024-01-02 13:00:00", 0),  # still OFF, next day
        ("a", "2024-01-02 23:00:00", 1),
        ("a", "2024-01-03 02:00:00", 0),  # at the end of the window: outside
        ("b", "2024-01-01 10:00:00", 0),
    )
    got = iv.state_intervals(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    assert rows(got, "w", "window_state", "start", "end") == [
        ("a", "OFF", "2024-01-01 13:00:00", "2024-01-02 23:00:00"),
        ("a", "ON", LO, "2024-01-01 13:00:00"),
        ("a", "ON", "2024-01-02 23:00:00", HI),
        ("b", "OFF", LO, HI),
    ]


def test_concurrency_counts_at_least_a_second_and_clips(frame, rows):
    work = frame(
        "w string, s timestamp, e timestamp",
        ("a", "2024-01-01 09:00:00", "2024-01-01 10:00:10"),  # from before the window
        ("a", "2024-01-01 10:00:05.2", "2024-01-01 10:00:05.9"),  # within one second
        ("a", "2024-01-01 10:00:20", "2024-01-01 10:00:15"),  # ends before it starts
        ("a", "2024-01-02 23:59:58", "2024-01-05 00:00:00"),  # over midnight, past the window
    )
    got = iv.active_intervals(work, "w", "s", "e", LO, HI)
    assert rows(got, "start", "end", "queries_active") == [
        ("2024-01-01 10:00:00", "2024-01-01 10:00:05", 1),
        ("2024-01-01 10:00:05", "2024-01-01 10:00:06", 2),
        ("2024-01-01 10:00:06", "2024-01-01 10:00:10", 1),
        ("2024-01-01 10:00:10", "2024-01-01 10:00:20", 0),
        ("2024-01-01 10:00:20", "2024-01-01 10:00:21", 1),
        ("2024-01-01 10:00:21", "2024-01-02 23:59:58", 0),
        ("2024-01-02 23:59:58", HI, 1),
    ]


def test_intervals_are_cut_at_midnight(frame, rows):
    whole = frame(
        "w string, start timestamp, end timestamp",
        ("a", "2024-01-01 23:00:00", "2024-01-03 01:00:00"),
        ("b", "2024-01-01 10:00:00", "2024-01-02 00:00:00"),
        ("c", "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
    )
    cut = iv.split_by_day(whole).withColumn("day", F.col("day").cast("string"))
    assert rows(cut, "w", "start", "end", "day") == [
        ("a", "2024-01-01 23:00:00", "2024-01-02 00:00:00", "2024-01-01"),
        ("a", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-02"),
        ("a", "2024-01-03 00:00:00", "2024-01-03 01:00:00", "2024-01-03"),
        ("b", "2024-01-01 10:00:00", "2024-01-02 00:00:00", "2024-01-01"),
    ]


@pytest.fixture
def random_feeds(frame):
    """Queries and state events of two keys over three days, a third key without queries."""
    rng = random.Random(5)
    stamp = "2024-01-{:02d} {:02d}:{:02d}:{:02d}.{:03d}".format

    def moment():
        return stamp(rng.randint(1, 3), rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59), rng.randint(0, 999))

    work = []
    for i in range(150):
        a, b = sorted((moment(), moment()))
        work.append((rng.choice("ab"), a, b if rng.random() < 0.1 else a[:14] + b[14:]))
    events = [(rng.choice("abc"), moment(), rng.choice([0, 1, None])) for _ in range(60)]
    return (
        frame("w string, s timestamp, e timestamp", *work),
        frame("w string, t timestamp, n int", *events),
        work,
        events,
    )


def brute_force(work, events):
    """Seconds by flag of every hour, second by second."""
    lo, hi = int(seconds(LO)), int(seconds(HI))
    active, state = {}, {}
    for key, a, b in work:
        start = int(seconds(a))
        for t in range(max(lo, start), min(hi, max(int(seconds(b)), start + 1))):
            active[key, t] = active.get((key, t), 0) + 1
    counts = {}
    for key in {k for k, _, _ in work}:
        own = sorted((seconds(t), n or 0) for k, t, n in events if k == key)
        current, position = "OFF", 0
        for t in range(lo, hi):
            while position < len(own) and int(own[position][0]) <= t:
                current = "ON" if own[position][1] > 0 else "OFF"
                position += 1
            state[key, t] = current
            flag = "OFF" if current == "OFF" else "UTILIZED" if active.get((key, t)) else "ON_IDLE"
            counts[key, (t - lo) // 3600, flag] = counts.get((key, (t - lo) // 3600, flag), 0) + 1
    return counts


def as_counts(periods):
    lo = int(seconds(LO))
    return {
        (r.w, (r.at - lo) // 3600, r.utilization_flag): r.duration
        for r in periods.withColumn("at", F.unix_timestamp("hour")).collect()
    }


def test_the_sweep_agrees_with_brute_force(random_feeds):
    work, events, work_rows, event_rows = random_feeds
    steps = iv.activity_steps(work, "w", "s", "e", LO, HI)
    states = iv.state_marks(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    swept = iv.utilization_sweep(steps, states, "w", LO, HI)
    assert as_counts(swept) == brute_force(work_rows, event_rows)


def test_interval_tables_give_the_same_periods(random_feeds):
    work, events, work_rows, event_rows = random_feeds
    states = iv.state_intervals(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    active = iv.active_intervals(work, "w", "s", "e", LO, HI)
    periods = iv.classify_periods(work.select("w").distinct(), "w", states, active, LO, HI)
    assert as_counts(periods) == brute_force(work_rows, event_rows)


def test_segments_tile_the_window(random_feeds):
    work, events, *_ = random_feeds
    states = iv.state_intervals(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    active = iv.active_intervals(work, "w", "s", "e", LO, HI)
    keys = work.select("w").distinct()
    edges = [(states, "start"), (states, "end"), (active, "start"), (active, "end")]
    cut = iv.segment_timeline(keys, "w", edges, LO, HI).join(keys, "w", "left_semi")
    total = cut.groupBy("w").agg(F.sum(F.unix_timestamp("end") - F.unix_timestamp("start")).alias("s"))
    assert {r.s for r in total.collect()} == {int(seconds(HI) - seconds(LO))}
    ordered_by_start = Window.partitionBy("w").orderBy("start")
    gaps = cut.withColumn("next", F.lead("start").over(ordered_by_start)).filter("next <> end")
    assert gaps.count() == 0


def test_a_run_looks_ahead_without_summing_all_that_follows(random_feeds):
    """A frame that ends at the last row is summed anew for every row, squared work within a day."""
    _, events, *_ = random_feeds
    states = iv.state_intervals(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    assert "unboundedfollowing" not in states._jdf.queryExecution().optimizedPlan().toString().lower()


def test_the_edges_of_a_frame_are_taken_in_one_pass(random_feeds, rows):
    work, events, *_ = random_feeds
    states = iv.state_intervals(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    keys = work.select("w").distinct()

    def leaves(*edges):
        return iv.segment_timeline(keys, "w", edges, LO, HI)._jdf.queryExecution().optimizedPlan().collectLeaves().size()

    assert leaves((states, "start"), (states, "end")) == leaves((states, "start"))
    apart = [(states, "start"), (states.select("*"), "end")]
    assert rows(iv.segment_timeline(keys, "w", apart, LO, HI)) == rows(iv.segment_timeline(keys, "w", [(states, "start"), (states, "end")], LO, HI))


def test_marks_are_shuffled_once(random_feeds):
    """Both uses of the marks, what hours leave behind and the line itself, share a shuffle."""
    work, events, *_ = random_feeds
    states = iv.state_intervals(events, "w", "t", iv.cluster_state(F.col("n")), LO, HI)
    active = iv.active_intervals(work, "w", "s", "e", LO, HI)
    periods = iv.classify_periods(work.select("w").distinct(), "w", states, active, LO, HI)
    periods.collect()
    final = periods._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the steps of the activity, and the marks of both tables
    made = [x for x in final.splitlines() if re.search(r"Exchange hashpartitioning\(w#\d+, at#\d+", x) and "Reused" not in x]
    values = [x for x in made if "plan_id" in x]
    assert len(values) == 3


def test_hourly_utilization_is_null_where_all_is_off(frame, rows):
    periods = frame(
        "w string, hour timestamp, utilization_flag string, duration int",
        ("a", LO, "OFF", 3600), ("a", "2024-01-01 11:00:00", "UTILIZED", 1200),
        ("a", "2024-01-01 11:00:00", "ON_IDLE", 1300), ("a", "2024-01-01 11:00:00", "OFF", 1100),
    )
    assert rows(iv.hourly_utilization(periods, "w"), "utilized_seconds", "idle_seconds", "off_seconds", "total_seconds", "utilization_proportion") == [
        (0, 0, 3600, 3600, None), (1200, 1300, 1100, 3600, 0.48),
    ]
    rounded = iv.hourly_utilization(periods, "w", "decimal(3,2)")
    assert rounded.schema["utilization_proportion"].dataType.simpleString() == "decimal(3,2)"


def test_bucketed_windows_equal_plain_ones(spark):
    rng = random.Random(3)
    data = [(rng.choice("xyz"), i, i // rng.choice([40, 40, 40]), rng.randint(-3, 3)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, at int, bucket int, v int")
    w = Window.partitionBy("k").orderBy("at")
    plain = df.withColumns({
        "total": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "after": F.lead("at").over(w),
    })
    split = ordered.totals_and_next(df, ["k"], "bucket", "at", "v", "total", "after")
    columns = ["k", "at", "total", "after"]
    assert sorted(map(tuple, plain.select(columns).collect()), key=str) == sorted(
        map(tuple, split.select(columns).collect()), key=str
    )


@pytest.mark.parametrize("values", [2, 5])
def test_bucketed_runs_equal_plain_ones(spark, values):
    rng = random.Random(values)
    data = [(rng.choice("xyz"), i, i // rng.choice([7, 7, 7]), rng.randint(1, values)) for i in range(300)]
    df = spark.createDataFrame(data, "k string, at int, bucket int, v int")
    w = Window.partitionBy("k").orderBy("at")
    changes = df.withColumn("before", F.lag("v").over(w)).filter("before is null or before <> v")
    plain = changes.withColumn("end", F.lead("at").over(w)).select("k", "at", "v", "end")
    found = ordered.runs(df, ["k"], "bucket", "at", "v", "end").select("k", "at", "v", "end")
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, found.collect()), key=str)


def test_feeds_are_read_once(spark, tmp_path):
    """Scans and shuffles of the sweeps over stored feeds, as at full size."""
    from ledgerlight.plans.query_cost import QueryFeeds, cost_per_query, query_activity, query_states
    from ledgerlight.testbed.feeds import Feeds

    feeds = Feeds(spark, "/root/testdata/sf0.001").query_feeds
    stored = []
    for name in ("history", "events", "usage", "prices"):
        getattr(feeds, name).write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    feeds = QueryFeeds(*stored)
    lo, hi = feeds.window()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(df):
            df.collect()
            text = df._jdf.queryExecution().executedPlan().toString()
            return text.split("== Initial Plan ==")[0]

        def counts(text):
            scans = {n: len(re.findall(rf"FileScan parquet .*{tmp_path.name}/{n}", text)) for n in ("history", "events")}
            return scans, len(re.findall(r"\bExchange hashpartitioning", text))

        spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
        for df, most in ((query_activity(feeds, lo, hi), (1, 0)), (query_states(feeds, lo, hi), (1, 1)), (cost_per_query(feeds, (lo, hi)), (1, 1))):
            scans, exchanges = counts(plan(df))
            assert (scans["history"], scans["events"]) <= most
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
