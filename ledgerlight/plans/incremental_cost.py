"""Cost per query kept up to date: only what a load changes is computed again.

The share of a statement depends on all work, states, billing and prices of its hours,
so a late, corrected or deleted row changes the cost of other statements too.  A folder
therefore keeps

* ``hours``: the fact by statement and hour, by day.  A load finds the (warehouse, hour)
  groups that it touches and replaces them whole;
* ``costs``: the fact by statement, by day of its start.  The statements of replaced
  hours are rolled up again and replaced;
* ``states``: the last state of each warehouse at the end of each day, so that a load
  reads the events from its first touched day on;
* ``loads``: window and latest billing hour of each load, written last.  A load that
  breaks off is repeated with the same rows and gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight import schemas
from ledgerlight.functions.time import Instant, as_column, clip, day_of, hour_of, on_days_since, second_of
from ledgerlight.operators.allocation import apportion_by_hour, query_work, warehouse_queries
from ledgerlight.operators.ordered import totals_and_next
from ledgerlight.operators.pricing import interval_lookup, unit_prices
from ledgerlight.plans.query_cost import QueryFeeds, Rules, attributed_hours, narrow_work, roll_up, warehouse_usage
from ledgerlight.session import staged
from ledgerlight.sources.tables import conform, write_partitions
from ledgerlight.streaming.incremental import MARKS, exists, replace_groups

HOUR = ["warehouse_id", "hour_bucket"]
STATEMENT = ["statement_id", "warehouse_id"]
LOAD = "lo string, hi string, latest string, states_from date, states_to date"
#: Runs of touched days that are computed one by one; beyond that the nearest are joined.
MOST_SPANS = 8
ONE_DAY = timedelta(days=1)


@dataclass(frozen=True)
class Load:
    """What a finished load has left: its number, window, latest billing hour and days of stored states."""

    number: int
    lo: str
    hi: str
    latest: str | None
    states_from: date
    states_to: date


@dataclass(frozen=True)
class Span:
    """A run of touched days, and what is read for it: ``margin`` days more on either side."""

    first: date
    last: date
    margin: int

    @property
    def start(self) -> str:
        return f"{self.first - self.margin * ONE_DAY} 00:00:00"

    @property
    def end(self) -> str:
        return f"{self.last + (self.margin + 1) * ONE_DAY} 00:00:00"

    def inside(self, lo: str, hi: str) -> tuple[str, str]:
        """The span within a window; where it lies outside, the hour of the window next to it."""
        first, last = max(self.start, lo), min(self.end, hi)
        if first < last:
            return first, last
        one = timedelta(hours=1)
        if self.start < lo:
            return lo, moment(datetime.fromisoformat(lo) + one)
        return moment(datetime.fromisoformat(hi) - one), hi


def moment(at: Instant) -> str:
    """A moment as text that sorts by time."""
    if not isinstance(at, str):
        at = at.isoformat()
    return datetime.fromisoformat(at).strftime("%Y-%m-%d %H:%M:%S")


# -- marks and loads -----------------------------------------------------------------------


def save_marks(marks: DataFrame, path: str, load: int) -> None:
    """Store the marks that a load has reached, beside those of the loads before."""
    marks.withColumn("load", F.lit(load)).write.mode("overwrite").parquet(f"{path}/load-{load:06d}")


def read_marks(spark: SparkSession, path: str, load: int) -> DataFrame:
    """The marks as ``load`` left them; none before the first."""
    if load < 0:
        return spark.createDataFrame([], MARKS)
    return spark.read.parquet(f"{path}/load-{load:06d}").drop("load")


def last_load(spark: SparkSession, path: str) -> Load | None:
    """The last load that was finished; None before the first."""
    if not exists(spark, f"{path}/loads"):
        return None
    row = spark.read.schema(f"{LOAD}, load int").parquet(f"{path}/loads").orderBy(F.desc("load")).first()
    return None if row is None else Load(row.load, row.lo, row.hi, row.latest, row.states_from, row.states_to)


def both_versions(known: DataFrame, incoming: DataFrame, keys: Sequence[str], deleted: DataFrame | None = None) -> DataFrame:
    """The rows of a feed that a load changes, as they were and as they come.

    ``known`` is the feed before the load, ``incoming`` has new and corrected rows and
    ``deleted`` the keys of rows that go.
    """
    gone = incoming.select(*keys)
    if deleted is not None:
        gone = gone.unionByName(deleted.select(*keys))
    return known.join(gone.distinct(), list(keys), "left_semi").unionByName(incoming)


# -- what a load touches -------------------------------------------------------------------


def _hours_of_usage(usage: DataFrame) -> DataFrame:
    return usage.select("warehouse_id", hour_of("usage_start_time").alias("hour_bucket"))


def switched_hours(changed: DataFrame, events: DataFrame, lo: Instant, hi: Instant) -> DataFrame | None:
    """Hours from each changed event to the next event of its warehouse; None without any.

    Events before the first changed one are not read.
    """
    first = changed.agg(second_of(F.min("event_time")).cast("string")).first()[0]
    if first is None:
        return None
    second = ["warehouse_id", second_of("event_time").alias("at")]
    fresh = changed.select(*second).distinct()
    seconds = since(events, first).select(*second).unionByName(fresh).distinct()
    spans = totals_and_next(
        seconds.withColumns({"day": day_of("at"), "one": F.lit(1)}), ["warehouse_id"], "day", "at", "one", "n", "next"
    )
    begin, end = (clip(c, as_column(lo), as_column(hi)) for c in (F.col("at"), F.coalesce("next", as_column(hi))))
    hours = F.sequence(hour_of(begin), hour_of(end), F.expr("interval 1 hour"))
    return spans.join(fresh, ["warehouse_id", "at"], "left_semi").select("warehouse_id", F.explode(hours).alias("hour_bucket"))


def repriced_hours(changed: DataFrame, feeds: QueryFeeds, lo: Instant, hi: Instant, rules: Rules) -> DataFrame | None:
    """Hours with billing that a changed price interval covers; None without any change.

    The join runs from the few changed intervals to the usage, by SKU and month, and the
    usage read is that between the first start and the last end.
    """
    intervals = unit_prices(changed, keys=rules.price_keys).drop("unit_price").distinct()
    first, last, open_ = intervals.agg(
        F.min("price_start_time").cast("string"),
        F.max("price_end_time").cast("string"),
        F.bool_or(F.col("price_end_time").isNull()),
    ).first()
    if first is None:
        return None
    at = F.col(rules.price_at)
    usage = warehouse_usage(feeds, lo, hi).filter(at >= as_column(first))
    usage = usage if open_ else usage.filter(at <= as_column(last))
    billed = usage.select(*dict.fromkeys([*rules.price_keys, rules.price_at]), "warehouse_id", hour_of("usage_start_time").alias("hour_bucket"))
    found = interval_lookup(
        billed.distinct(),
        rules.price_at,
        intervals.withColumn("__changed", F.lit(True)),
        "price_start_time",
        "price_end_time",
        rules.price_keys,
        rules.price_closed,
        span=(lo, hi),
    )
    return found.filter("__changed").select(*HOUR)


def moved_rows(feeds: QueryFeeds, before: tuple[Instant, Instant], now: tuple[Instant, Instant]) -> tuple[DataFrame, DataFrame]:
    """Work and usage that are in one of two windows and not in the other.

    Only rows near the bounds that moved pass the filters, which reach the scan.
    """
    los, his = (sorted(map(moment, pair)) for pair in zip(before, now, strict=True))
    history = feeds.history.filter((F.col("end_time") <= as_column(los[1])) | (F.col("start_time") >= as_column(his[0])))
    work = narrow_work(replace(feeds, history=history), los[0], his[1])
    usage = warehouse_usage(feeds, los[0], his[1]).filter(
        (F.col("usage_start_time") < as_column(los[1])) | (F.col("usage_end_time") > as_column(his[0]))
    )
    return work, usage


def touched_hours(
    changed: QueryFeeds, feeds: QueryFeeds, before: tuple[Instant, Instant], now: tuple[Instant, Instant], rules: Rules = Rules()
) -> DataFrame:
    """The (warehouse, hour) whose cost, utilization or work a load may change.

    ``changed`` has the rows that are new, corrected or deleted, as they were and as they
    are, ``feeds`` all rows after the load; ``before`` and ``now`` are the windows of the
    last load and of this one.  Billing changes its own hour and work the hours it
    covers.  An event sets the state up to the next event of its warehouse.  A price
    changes the hours that are billed in its interval.  Where the window moves, at either
    end, the rows that come in and those that fall out count.
    """
    before, now = (tuple(map(moment, window)) for window in (before, now))
    lo, hi = min(before[0], now[0]), max(before[1], now[1])
    work, usage = moved_rows(feeds, before, now) if before != now else (None, None)
    found = [
        _hours_of_usage(warehouse_usage(changed, lo, hi)),
        apportion_by_hour(narrow_work(changed, lo, hi)).select(*HOUR),
        switched_hours(changed.events, feeds.events, lo, hi),
        repriced_hours(changed.prices, feeds, lo, hi, rules),
        None if work is None else apportion_by_hour(work).select(*HOUR),
        None if usage is None else _hours_of_usage(usage),
    ]
    return reduce(DataFrame.unionByName, [f for f in found if f is not None]).distinct()


def touched_spans(days: Sequence[date], margin: int) -> list[Span]:
    """Runs of days, joined where what is read for them would meet."""
    runs: list[list[date]] = []
    for day in sorted(days):
        if runs and (day - runs[-1][1]).days <= 2 * margin + 1:
            runs[-1][1] = day
        else:
            runs.append([day, day])
    while len(runs) > MOST_SPANS:
        k = min(range(len(runs) - 1), key=lambda k: runs[k + 1][0] - runs[k][1])
        runs[k : k + 2] = [[runs[k][0], runs[k + 1][1]]]
    return [Span(first, last, margin) for first, last in runs]


# -- states --------------------------------------------------------------------------------


def since(events: DataFrame, first: Instant) -> DataFrame:
    """Events from a moment on; by their day too, where the feed has one."""
    start = as_column(first)
    rows = events.filter(F.col("event_time") >= start)
    return rows.filter(on_days_since("event_date", start)) if "event_date" in events.columns else rows


def carry_states(feeds: QueryFeeds, path: str, first: date, last: date, onward: bool) -> None:
    """Write the last event of each warehouse as of the end of each day from ``first`` to ``last``.

    ``onward``: the day before ``first`` is stored, and events before are not read.
    Otherwise they count for the first day.  One partition a day, one row a warehouse.
    """
    spark, columns = feeds.events.sparkSession, ["warehouse_id", "day", "last"]
    events = feeds.events.filter(F.col("event_time") < as_column(f"{last + ONE_DAY}"))
    events = since(events, f"{first}") if onward else events
    day = F.greatest(F.lit(first), F.col("event_time").cast("date"))
    own = (
        events.filter(F.col("warehouse_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("warehouse_id", day.alias("day"))
        .agg(F.max(F.struct("event_time", F.col("cluster_count").cast("int").alias("cluster_count"))).alias("last"))
    )
    own = staged(own)
    if onward:
        kept = stored_states(spark, path, first - ONE_DAY)
        own = own.unionByName(kept.select("warehouse_id", "day", F.struct("event_time", "cluster_count").alias("last")))
    calendar = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    grid = own.select("warehouse_id").distinct().select("warehouse_id", F.explode(calendar).alias("day"), F.lit(None).cast(own.schema["last"].dataType).alias("last"))
    filled = own.select(*columns).unionByName(grid).groupBy("warehouse_id", "day").agg(F.max("last").alias("last"))
    upto = Window.partitionBy("warehouse_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    rows = filled.withColumn("last", F.last("last", ignorenulls=True).over(upto)).filter(F.col("day") >= F.lit(first))
    write_partitions(staged(rows.select("warehouse_id", "last.event_time", "last.cluster_count", "day")), f"{path}/states", ["day"])


def stored_states(spark: SparkSession, path: str, day: date) -> DataFrame:
    """(warehouse_id, event_time, cluster_count, day): the last events as of the end of a day."""
    rows = spark.read.schema("warehouse_id string, event_time timestamp, cluster_count int, day date").parquet(f"{path}/states")
    return rows.filter((F.col("day") == F.lit(day)) & F.col("event_time").isNotNull())


def seeded(feeds: QueryFeeds, path: str, first: str, have: tuple[date, date]) -> QueryFeeds:
    """The feeds with the events of the days from ``first`` on, and before them the stored last ones."""
    day = date.fromisoformat(first[:10])
    if not have[0] <= day - ONE_DAY <= have[1]:
        return feeds
    columns = ["warehouse_id", "event_time", F.col("cluster_count").cast("int").alias("cluster_count")]
    kept = stored_states(feeds.events.sparkSession, path, day - ONE_DAY).select(*columns)
    return replace(feeds, events=since(feeds.events, f"{day}").select(*columns).unionByName(kept))


def _refresh_states(feeds: QueryFeeds, changed: QueryFeeds | None, path: str, before: Load | None, lo: str, hi: str) -> tuple[date, date]:
    """Store the states of new days and of those that changed events reach; the days stored then."""
    first, last = date.fromisoformat(lo[:10]) - ONE_DAY, date.fromisoformat(hi[:10])
    if before is None or first < before.states_from:
        carry_states(feeds, path, first, last, onward=False)
        return first, last
    new = before.states_to + ONE_DAY
    event = changed.events.agg(F.min("event_time").cast("date")).first()[0]
    begin, last = min(new, event or new), max(last, before.states_to)
    if begin <= before.states_from:
        carry_states(feeds, path, before.states_from, last, onward=False)
    elif begin <= last:
        carry_states(feeds, path, begin, last, onward=True)
    return before.states_from, last


# -- loads ---------------------------------------------------------------------------------


def load_costs(
    path: str,
    feeds: QueryFeeds,
    changed: QueryFeeds | None = None,
    window: tuple[Instant, Instant] | None = None,
    rules: Rules = Rules(),
    margin: int = 1,
) -> int:
    """Bring the facts at ``path`` up to the rows of ``feeds``; the number of the load.

    ``changed`` has the rows that the load brings, corrects or deletes, as they were and
    as they are (:func:`both_versions`); the first load takes all and needs none.  The
    result equals a full build over ``feeds`` and ``window``, which is theirs unless given.

    Feeds are read from ``margin`` days before a run of touched days to as long after
    it.  Within that time of its start and end a query must do its work, and a billing
    row must end.  The days that are touched are all that the driver gets.
    """
    spark = feeds.history.sparkSession
    before = last_load(spark, path)
    lo, hi = map(moment, window or feeds.window())
    states = _refresh_states(feeds, changed, path, before, lo, hi)
    if before is None:
        hours = _day_rows(attributed_hours(feeds, lo, hi, rules, latest=F.lit(None).cast("timestamp")))
        replace_groups(hours, f"{path}/hours", None, "day")
        costs = roll_up(_read_hours(spark, path), feeds, lo, hi, rules)
        replace_groups(_start_rows(costs), f"{path}/costs", None, "query_date")
    else:
        was = before.lo, before.hi
        touched = touched_hours(changed, feeds, was, (lo, hi), rules)
        touched = staged(touched.withColumn("day", day_of("hour_bucket").cast("date")))
        spans = touched_spans([r.day for r in touched.select("day").distinct().collect()], margin)
        if spans:
            hours = staged(_touched_rows(feeds, path, touched, spans, states, lo, hi, rules))
            replace_groups(hours, f"{path}/hours", touched, "day")
            _refresh_costs(path, feeds, changed, hours, spans, was, (lo, hi), rules)
    number = 0 if before is None else before.number + 1
    latest = latest_billed(feeds, lo, hi, None if before is None else before.latest)
    record = spark.createDataFrame([(lo, hi, latest, *states)], LOAD)
    record.write.mode("overwrite").parquet(f"{path}/loads/load={number}")
    return number


def read_costs(spark: SparkSession, path: str) -> DataFrame:
    """Cost per query as the last load left it."""
    latest = last_load(spark, path).latest
    fact = schemas.fact("cost_per_query")
    rows = spark.read.parquet(f"{path}/costs").withColumn("most_recent_billing_hour", as_column(latest))
    return conform(rows, fact)


def latest_billed(feeds: QueryFeeds, lo: Instant, hi: Instant, known: str | None) -> str | None:
    """Latest hour with billing inside the window; ``known`` is where to look first."""

    def latest(begin: Instant) -> str | None:
        return warehouse_usage(feeds, begin, hi).agg(hour_of(F.max("usage_start_time")).cast("string")).first()[0]

    found = latest(known) if known is not None and moment(lo) < known < moment(hi) else None
    return found or latest(lo)


def _day_rows(hours: DataFrame) -> DataFrame:
    return hours.drop("most_recent_billing_hour").withColumn("day", day_of("hour_bucket").cast("date"))


def _start_rows(costs: DataFrame) -> DataFrame:
    return costs.withColumn("query_date", day_of("start_time").cast("date"))


def _read_hours(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/hours").withColumn("most_recent_billing_hour", F.lit(None).cast("timestamp"))


def _touched_rows(
    feeds: QueryFeeds, path: str, touched: DataFrame, spans: Sequence[Span], states: tuple[date, date], lo: str, hi: str, rules: Rules
) -> DataFrame:
    """The new rows of the touched hours, span by span."""
    made = []
    for span in spans:
        first, last = span.inside(lo, hi)
        own = touched.filter(F.col("day").between(F.lit(span.first), F.lit(span.last)))
        rows = attributed_hours(seeded(feeds, path, first, states), first, last, rules, latest=F.lit(None).cast("timestamp"))
        made.append(_day_rows(rows.join(own.select(*HOUR), HOUR, "left_semi")))
    return reduce(DataFrame.unionByName, made)


def _refresh_costs(
    path: str,
    feeds: QueryFeeds,
    changed: QueryFeeds,
    hours: DataFrame,
    spans: Sequence[Span],
    was: tuple[str, str],
    now: tuple[str, str],
    rules: Rules,
) -> None:
    """Roll up the statements of replaced hours again, and replace their costs.

    A statement changes with its hours; it goes where its own row, or the window, says
    so.  History is read where it overlaps the spans, the hour fact on the days that the
    statements work.
    """
    spark = hours.sparkSession
    start = day_of("start_time").cast("date").alias("query_date")
    of_row = ["statement_id", F.col("compute.warehouse_id").alias("warehouse_id"), start]
    own = changed.history.filter(F.col("compute.warehouse_id").isNotNull()).select(*of_row)
    moved = moved_rows(feeds, was, now)[0].select(*STATEMENT) if was != now else own.select(*STATEMENT)
    changing = staged(hours.select(*STATEMENT).unionByName(own.select(*STATEMENT)).unionByName(moved).distinct())

    near = reduce(Column.__or__, [(F.col("start_time") < as_column(s.end)) & (F.col("end_time") > as_column(s.start)) for s in spans])
    history = feeds.history.filter(near).join(changing.select("statement_id").distinct(), "statement_id", "left_semi")
    groups = staged(history.filter(F.col("compute.warehouse_id").isNotNull()).select(*of_row).unionByName(own).distinct())

    work = query_work(warehouse_queries(history, *now))
    begin, end = (day_of(f"query_work_{side}_time").cast("date") for side in ("start", "end"))
    worked = work.select(F.explode(F.sequence(begin, F.greatest(begin, end), F.expr("interval 1 day"))).alias("day"))
    days = [r.day for r in worked.distinct().collect()]
    rows = _read_hours(spark, path).filter(F.col("day").isin(days)).join(changing, STATEMENT, "left_semi")
    costs = roll_up(rows, replace(feeds, history=history), *now, rules)
    replace_groups(_start_rows(costs), f"{path}/costs", groups, "query_date")
