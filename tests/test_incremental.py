"""Cost per query in loads against the full build, and the sinks it rests on."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlight.plans import incremental_cost as ic
from ledgerlight.plans.query_cost import CLOSED_RULES, QueryFeeds, Rules, cost_per_query
from ledgerlight.streaming import incremental

HISTORY = """statement_id string, workspace_id string, executed_by string, execution_status string,
  compute struct<type string, cluster_id string, warehouse_id string>, statement_text string, statement_type string,
  client_application string, waiting_for_compute_duration_ms bigint, waiting_at_capacity_duration_ms bigint,
  compilation_duration_ms bigint, total_task_duration_ms bigint, result_fetch_duration_ms bigint,
  start_time timestamp, end_time timestamp,
  query_source struct<job_info struct<job_id string>, legacy_dashboard_id string, dashboard_id string, alert_id string,
    notebook_id string, sql_query_id string, assistant_space_id string>"""
EVENTS = "warehouse_id string, event_type string, cluster_count int, event_time timestamp, event_date date"
USAGE = """usage_metadata struct<warehouse_id string>, usage_start_time timestamp, usage_end_time timestamp,
  usage_quantity decimal(38,18), usage_unit string, sku_name string, cloud string"""
PRICES = """sku_name string, cloud string, usage_unit string, currency_code string, price_start_time timestamp,
  price_end_time timestamp, pricing struct<effective_list struct<default decimal(38,18)>>"""
DAY0 = datetime(2024, 3, 1)
HOUR = timedelta(hours=1)


def statement(rng, n, start=None):
    start = start or DAY0 + timedelta(seconds=rng.randrange(0, 9 * 86400))
    length = rng.choice([5, 600, 4000, 30_000])
    warehouse = f"w{rng.randrange(3)}"
    ms = [rng.randrange(0, 3000) for _ in range(3)]
    return (
        f"s{n}", "1", f"u{n % 4}", "FINISHED", ("W", None, warehouse), f"SELECT {n}", "SELECT", "Console", *ms,
        rng.choice([0, 500, 9000, 80_000]), rng.randrange(0, 5000), start, start + timedelta(seconds=length),
        (None, None, None, None, None, None, "sp-1"),
    )


def event(rng, at=None):
    at = at or DAY0 + timedelta(seconds=rng.randrange(-3 * 86400, 9 * 86400))
    return (f"w{rng.randrange(3)}", "SCALED", rng.choice([0, 0, 1, 2, None]), at, at.date())


def usage(rng, hour, warehouse):
    start = DAY0 + hour * HOUR
    return ((f"w{warehouse}",), start, start + HOUR, rng.randrange(1, 9), "UNIT", f"sku{warehouse % 2}", "C0")


def price(sku, start, end, rate):
    return (f"sku{sku}", "C0", "UNIT", "USD", start, end, ((rate,),))


class Known:
    """Rows of the feeds by key, with the changes since the last load."""

    def __init__(self, spark):
        self.spark, self.rows, self.changed = spark, [{} for _ in range(4)], [[] for _ in range(4)]

    def put(self, feed, key, row):
        old = self.rows[feed].get(key)
        self.changed[feed] += [r for r in (old, row) if r is not None]
        if row is None:
            del self.rows[feed][key]
        else:
            self.rows[feed][key] = row

    def feeds(self, which):
        from decimal import Decimal

        schemas = (HISTORY, EVENTS, USAGE, PRICES)
        fix = {2: lambda r: (*r[:3], Decimal(r[3]), *r[4:]), 3: lambda r: (*r[:6], ((Decimal(r[6][0][0]),),))}
        frames = [self.spark.createDataFrame([fix.get(k, lambda r: r)(r) for r in w], s) for k, (w, s) in enumerate(zip(which, schemas, strict=True))]
        return QueryFeeds(*frames)

    def load(self):
        feeds, changed = self.feeds([list(r.values()) for r in self.rows]), self.feeds(self.changed)
        self.changed = [[] for _ in range(4)]
        return feeds, changed


@pytest.fixture
def known(spark, monkeypatch):
    monkeypatch.setenv("TZ", "UTC")
    import time

    time.tzset()
    rng, known = random.Random(7), Known(spark)
    for n in range(60):
        row = statement(rng, n)
        if row[-3] < DAY0 + timedelta(days=5):
            known.put(0, n, row)
    for n in range(24):
        row = event(rng)
        if row[3] < DAY0 + timedelta(days=5):
            known.put(1, n, row)
    known.put(1, "first", ("w0", "SCALED", 1, DAY0 - timedelta(days=20), (DAY0 - timedelta(days=20)).date()))
    for hour in range(30, 120):
        for w in range(3):
            known.put(2, (hour, w), usage(rng, hour, w))
    change = DAY0 + timedelta(days=3, hours=5)
    known.put(3, "a", price(0, datetime(2023, 1, 1), change, 2))
    known.put(3, "b", price(0, change, None, 3))
    known.put(3, "c", price(1, datetime(2023, 1, 1), DAY0 + timedelta(days=2), 5))
    yield rng, known
    monkeypatch.undo()
    time.tzset()


def result(df):
    cells = lambda x: round(x, 6) if isinstance(x, float) else [cells(y) for y in x] if isinstance(x, (list, tuple)) else x
    rows = df.withColumn("most_recent_billing_hour", F.col("most_recent_billing_hour").cast("string"))
    return sorted(cells(tuple(r)) for r in rows.collect())


def same(spark, path, feeds, window=None, rules=Rules()):
    got, want = result(ic.read_costs(spark, path)), result(cost_per_query(feeds, window, rules))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert got == want
    return want


def test_loads_equal_the_full_build(spark, known, tmp_path):
    rng, known = known
    rules = Rules()
    path = str(tmp_path / "cost")
    feeds, _ = known.load()
    assert ic.load_costs(path, feeds, rules=rules) == 0
    first = same(spark, path, feeds, rules=rules)

    # new days, and late rows of old ones
    for n in range(60, 90):
        known.put(0, n, statement(rng, n))
    for n in range(24, 30):
        known.put(1, n, event(rng, DAY0 + timedelta(days=rng.choice([1, 3, 6]), seconds=n)))
    for hour in range(120, 190):
        for w in range(3):
            known.put(2, (hour, w), usage(rng, hour, w))
    known.put(2, "late", usage(rng, 50, 1))
    feeds, changed = known.load()
    assert ic.load_costs(path, feeds, changed, rules=rules) == 1
    assert len(same(spark, path, feeds, rules=rules)) > len(first)

    # corrected end times, a statement on another warehouse, deleted statements, events and billing
    have = list(known.rows[0])
    for n in have[3:6]:
        row = list(known.rows[0][n])
        row[-2] = row[-3] + timedelta(seconds=7)
        known.put(0, n, tuple(row))
    row = list(known.rows[0][have[11]])
    row[4] = ("W", None, "w2" if row[4][2] != "w2" else "w1")
    known.put(0, have[11], tuple(row))
    for n in (*have[7:9], have[30]):
        known.put(0, n, None)
    for n in list(known.rows[1])[3:6]:
        known.put(1, n, None)
    known.put(2, (60, 0), None)
    # a price that comes late, and one that is corrected
    known.put(3, "d", price(1, DAY0 + timedelta(days=2), None, 7))
    known.put(3, "a", price(0, datetime(2023, 1, 1), DAY0 + timedelta(days=3, hours=5), 4))
    feeds, changed = known.load()
    assert ic.load_costs(path, feeds, changed, rules=rules) == 2
    same(spark, path, feeds, rules=rules)

    # billing from before the window: it begins earlier
    for hour in range(4, 30):
        known.put(2, (hour, 1), usage(rng, hour, 1))
    feeds, changed = known.load()
    ic.load_costs(path, feeds, changed, rules=rules)
    same(spark, path, feeds, rules=rules)

    # nothing: a load all the same
    feeds, changed = known.load()
    assert ic.load_costs(path, feeds, changed, rules=rules) == 4
    same(spark, path, feeds, rules=rules)


def test_a_window_can_shrink_and_move(spark, known, tmp_path):
    _, known = known
    path, feeds = str(tmp_path / "cost"), known.load()[0]
    nothing = known.feeds([[], [], [], []])
    windows = [("2024-03-02 00:00:00", "2024-03-05 00:00:00"), ("2024-03-02 09:00:00", "2024-03-04 15:00:00"), ("2024-03-01 09:00:00", "2024-03-06 00:00:00")]
    for k, window in enumerate(windows):
        ic.load_costs(path, feeds, nothing if k else None, window)
        same(spark, path, feeds, window)


def test_a_load_that_broke_off_is_repeated(spark, known, tmp_path, monkeypatch):
    rng, known = known
    path, feeds, rules = str(tmp_path / "cost"), known.load()[0], CLOSED_RULES
    ic.load_costs(path, feeds, rules=rules)
    for n in list(known.rows[0])[2:4]:
        known.put(0, n, None)
    known.put(0, 70, statement(rng, 70, DAY0 + timedelta(days=2)))
    known.put(3, "d", price(1, DAY0 + timedelta(days=2), None, 7))
    feeds, changed = known.load()
    with monkeypatch.context() as m:
        m.setattr(ic, "roll_up", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ic.load_costs(path, feeds, changed, rules=rules)
    assert ic.load_costs(path, feeds, changed, rules=rules) == 1
    same(spark, path, feeds, rules=rules)


def test_a_load_reads_events_and_history_of_its_span(spark, known, tmp_path):
    """Stored states stand for all events before, by a partition filter; history is cut by its times."""
    rng, known = known
    feeds = known.load()[0]
    feeds.events.write.partitionBy("event_date").parquet(str(tmp_path / "events"))
    feeds.history.write.parquet(str(tmp_path / "history"))
    events, history = (spark.read.parquet(str(tmp_path / n)) for n in ("events", "history"))
    stored = QueryFeeds(history, events, feeds.usage, feeds.prices)
    path = str(tmp_path / "cost")
    ic.load_costs(path, stored)
    load = ic.last_load(spark, path)
    seeded = ic.seeded(stored, path, "2024-03-04 00:00:00", (load.states_from, load.states_to))
    plan = seeded.events._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "event_date" in line)
    assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0] and "2024-03-03" in scan
    whole, cut = (f.events.filter("warehouse_id IS NOT NULL") for f in (stored, seeded))
    assert 0 < cut.count() < whole.count()
    # days without stored states read everything
    assert ic.seeded(stored, path, "2023-01-01 00:00:00", (load.states_from, load.states_to)) is stored


def test_touched_days_become_few_spans():
    days = [date(2024, 1, d) for d in (1, 2, 9, 20)]
    spans = ic.touched_spans(days, 1)
    assert [(s.first.day, s.last.day) for s in spans] == [(1, 2), (9, 9), (20, 20)]
    assert spans[1].start == "2024-01-08 00:00:00" and spans[1].end == "2024-01-11 00:00:00"
    assert [(s.first.day, s.last.day) for s in ic.touched_spans([date(2024, 1, d) for d in (1, 4)], 1)] == [(1, 4)]
    many = ic.touched_spans([date(2024, 1, 1) + timedelta(days=10 * k) for k in range(30)], 1)
    assert len(many) == ic.MOST_SPANS and many[0].first == date(2024, 1, 1) and many[-1].last == date(2024, 10, 17)
    assert ic.touched_spans([], 1) == []
    span = ic.Span(date(2024, 1, 5), date(2024, 1, 5), 1)
    assert span.inside("2024-01-05 06:00:00", "2024-01-09 00:00:00") == ("2024-01-05 06:00:00", "2024-01-07 00:00:00")
    assert span.inside("2024-02-01 00:00:00", "2024-02-09 00:00:00") == ("2024-02-01 00:00:00", "2024-02-01 01:00:00")
    assert span.inside("2023-02-01 00:00:00", "2023-02-09 00:00:00") == ("2023-02-08 23:00:00", "2023-02-09 00:00:00")


def test_changed_rows_come_in_both_versions(spark, rows):
    known = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    incoming = spark.createDataFrame([("b", 20), ("d", 4)], "k string, v int")
    gone = spark.createDataFrame([("c",)], "k string")
    assert rows(ic.both_versions(known, incoming, ["k"], gone)) == [("b", 2), ("b", 20), ("c", 3), ("d", 4)]


def test_groups_are_replaced_whole(spark, tmp_path, rows):
    path, ddl = str(tmp_path / "g"), "k string, n int, day string"

    def frame(*data, kind=ddl):
        return spark.createDataFrame(list(data), kind)

    start = frame(("a", 1, "d1"), ("a", 2, "d1"), ("b", 3, "d1"), ("c", 4, "d2"), (None, 5, "d2"), ("e", 6, "d3"))
    incremental.replace_groups(start, path, None, "day")
    untouched = {p.name for p in (tmp_path / "g" / "day=d3").iterdir()}
    groups = frame(("a", "d1"), (None, "d2"), ("c", "d2"), kind="k string, day string")
    for _ in range(2):
        incremental.replace_groups(frame(("a", 9, "d1"), ("a", 8, "d4")), path, groups, "day")
    assert rows(spark.read.parquet(path), "k", "n", "day") == [("a", 8, "d4"), ("a", 9, "d1"), ("b", 3, "d1"), ("e", 6, "d3")]
    assert {p.name for p in (tmp_path / "g" / "day=d3").iterdir()} == untouched
    assert not (tmp_path / "g" / "day=d2").exists()


def test_upserts_whose_partition_follows_the_key_look_nothing_up(spark, tmp_path, rows, monkeypatch):
    path, ddl = str(tmp_path / "u"), "k string, day string, at int"
    args = (path, ["k", "day"], ["at"], "day")
    incremental.upsert_partitions(spark.createDataFrame([("a", "d1", 1), ("b", "d2", 1)], ddl), *args, follows_key=True)
    read = []
    whole = incremental._values
    monkeypatch.setattr(incremental, "_values", lambda df, p: read.append(df._jdf.queryExecution().optimizedPlan().toString()) or whole(df, p))
    change = spark.createDataFrame([("a", "d1", 2), ("a", "d3", 5)], ddl)
    incremental.upsert_partitions(change, *args, follows_key=True)
    assert "parquet" not in read[0]
    assert rows(spark.read.parquet(path), "k", "day", "at") == [("a", "d1", 2), ("a", "d3", 5), ("b", "d2", 1)]
