"""Intervals derived from events: states, activity, segments and their use by hour.

All bounds are whole seconds inside a half-open window ``[lo, hi)`` of whole hours.
Events are first reduced to one row per key and second, with partial aggregation before
the shuffle, so that no group below holds more rows than its bucket has seconds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.functions.time import (
    Instant,
    as_column,
    clip,
    day_of,
    hour_of,
    second_of,
    whole_seconds_between,
)
from ledgerlight.operators.ordered import runs, totals_and_next

OFF, ON = "OFF", "ON"


def completeness_window(feeds: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """One row ``(lo, hi)``: the whole hours that every feed covers.

    Each feed is ``(frame, column of its earliest time, column of its latest time)``.
    ``lo`` is the first whole hour after the latest of the earliest times, ``hi`` the
    hour of the earliest of the latest times.
    """
    spans = [df.agg(F.min(first).alias("earliest"), F.max(last).alias("latest")) for df, first, last in feeds]
    return reduce(DataFrame.unionByName, spans).agg(
        (hour_of(F.max("earliest")) + F.expr("interval 1 hour")).alias("lo"),
        hour_of(F.min("latest")).alias("hi"),
    )


def resolve_window(window: DataFrame) -> tuple[Instant, Instant]:
    """Bounds of a one-row window, to be used as literals that scans can prune by.

    Carried as text: a Python datetime would be read in the driver's own time zone.
    """
    row = window.select(F.col("lo").cast("string"), F.col("hi").cast("string")).first()
    if row is None or row[0] is None or row[1] is None:
        raise ValueError("the feeds have no common window")
    return row[0], row[1]


def cluster_state(count: Column) -> Column:
    """OFF at zero clusters and where the count is unknown, else ON."""
    return F.when(count > 0, ON).otherwise(OFF)


def state_marks(events: DataFrame, key: str, ts: str, state: Column, lo: Instant, hi: Instant) -> DataFrame:
    """State per key from a second on: ``(key, at, window_state)``.

    Within a second the last event counts.  Everything before ``lo`` folds into the state
    held at ``lo``, however long ago it was set.
    """
    lower, upper = as_column(lo), as_column(hi)
    return (
        events.filter((F.col(ts) < upper) & F.col(key).isNotNull())
        .select(key, F.greatest(lower, second_of(ts)).alias("at"), F.struct(ts, state.alias("state")).alias("__last"))
        .groupBy(key, "at")
        .agg(F.max("__last")["state"].alias("window_state"))
    )


def activity_steps(work: DataFrame, key: str, start: str, end: str, lo: Instant, hi: Instant) -> DataFrame:
    """Net change of the number at work per key and second: ``(key, at, step)``.

    A row of ``work`` counts from the second of its start to the second of its end, at
    least one second, inside ``[lo, hi]``.
    """
    lower, upper = as_column(lo), as_column(hi)
    begin = second_of(start)
    finish = F.greatest(second_of(end), begin + F.expr("interval 1 second"))
    edges = F.array(
        F.struct(clip(begin, lower, upper).alias("at"), F.lit(1).alias("step")),
        F.struct(clip(finish, lower, upper).alias("at"), F.lit(-1).alias("step")),
    )
    return (
        work.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull())
        .select(key, F.inline(edges))
        .groupBy(key, "at")
        .agg(F.sum("step").alias("step"))
    )


def state_intervals(
    events: DataFrame, key: str, ts: str, state: Column, lo: Instant, hi: Instant
) -> DataFrame:
    """Runs of equal state per key: ``(key, window_state, start, end)``.

    A run ends where the next one starts, the last at ``hi``.  See :func:`state_marks`
    for what holds within a second and before ``lo``.
    """
    by_second = state_marks(events, key, ts, state, lo, hi).select(
        key, F.col("at").alias("start"), "window_state", day_of("at").alias("__day")
    )
    return runs(by_second, [key], "__day", "start", "window_state", "end").select(
        key, "window_state", "start", F.coalesce("end", as_column(hi)).alias("end")
    )


def active_intervals(work: DataFrame, key: str, start: str, end: str, lo: Instant, hi: Instant) -> DataFrame:
    """Periods of constant concurrency per key: ``(key, start, end, queries_active)``.

    The steps of :func:`activity_steps` are summed in order and each instant holds until
    the next; the last ends at ``hi``.
    """
    net = activity_steps(work, key, start, end, lo, hi).select(
        key, F.col("at").alias("start"), "step", day_of("at").alias("__day")
    )
    return (
        totals_and_next(net, [key], "__day", "start", "step", "queries_active", "end")
        .select(key, "start", F.coalesce("end", as_column(hi)).alias("end"), "queries_active")
        .filter(F.col("start") < F.col("end"))
    )


def split_by_day(intervals: DataFrame, start: str = "start", end: str = "end", day: str = "day") -> DataFrame:
    """Intervals cut at midnight, with the day of each piece; empty pieces are left out."""
    one_day = F.expr("interval 1 day")
    days = F.sequence(day_of(start), F.greatest(day_of(start), day_of(end)), one_day)
    cut = intervals.withColumn("__day", F.explode(days))
    return (
        cut.withColumns(
            {
                start: F.greatest(F.col(start), F.col("__day")),
                end: F.least(F.col(end), F.col("__day") + one_day),
                day: F.col("__day").cast("date"),
            }
        )
        .filter(F.col(start) < F.col(end))
        .drop("__day")
    )


def hour_ticks(keys: DataFrame, lo: Instant, hi: Instant, out: str = "hour") -> DataFrame:
    """Every key with every hour of ``[lo, hi)``."""
    hours = F.sequence(as_column(lo), as_column(hi) - F.expr("interval 1 hour"), F.expr("interval 1 hour"))
    return keys.filter(as_column(lo) < as_column(hi)).withColumn(out, F.explode(hours))


def segment_timeline(
    keys: DataFrame, key: str, edges: Sequence[tuple[DataFrame, str]], lo: Instant, hi: Instant
) -> DataFrame:
    """Elementary periods per key between all distinct edges and hour ticks.

    ``keys`` has one row per key and ``edges`` lists ``(frame, time column)``.  The hour
    ticks are always among the edges, so the period after an edge never leaves its hour
    and each (key, hour) is cut on its own.
    """
    lower, upper = as_column(lo), as_column(hi)
    ticks = hour_ticks(keys.select(key), lo, hi, "start")
    of_frame: dict[int, tuple[DataFrame, list[str]]] = {}
    for df, ts in edges:
        of_frame.setdefault(id(df), (df, []))[1].append(ts)
    # all edges of a frame from one pass over it, as it may be long in the making
    marks = [df.select(key, F.explode(F.array(*columns)).alias("start")) for df, columns in of_frame.values()]
    instants = reduce(DataFrame.unionByName, marks, ticks).filter(
        (F.col("start") >= lower) & (F.col("start") < upper)
    )
    hour = hour_of("start")
    inside = Window.partitionBy(key, "hour").orderBy("start")
    return (
        instants.distinct()
        .withColumn("hour", hour)
        .withColumn("end", F.coalesce(F.lead("start").over(inside), F.col("hour") + F.expr("interval 1 hour")))
        .select(key, "start", "end", "hour")
    )


def utilization_sweep(steps: DataFrame, states: DataFrame, key: str, lo: Instant, hi: Instant) -> DataFrame:
    """Seconds per key, hour and flag UTILIZED, ON_IDLE or OFF, in one sweep.

    ``steps`` and ``states`` come from :func:`activity_steps` and :func:`state_marks`.  A
    period is OFF without a state or in state OFF, UTILIZED while something runs and
    ON_IDLE otherwise.  No intervals are built or joined: each (key, hour) starts from an
    opening mark with the balance and the state that earlier hours left behind, and is
    swept on its own.  The opening marks of all hours up to the next one with marks come
    from the summary of the hour before them.  Keys without any activity are left out.
    """
    lower, upper, hour = as_column(lo), as_column(hi), F.expr("interval 1 hour")
    marks = (
        steps.unionByName(states, allowMissingColumns=True)
        .filter((F.col("at") < upper) & hour_of("at").isNotNull() & F.col(key).isNotNull())
        .withColumn("hour", hour_of("at"))
    )
    of_hour = marks.groupBy(key, "hour").agg(
        F.sum("step").alias("step"),
        F.max_by("window_state", F.when(F.col("window_state").isNotNull(), F.col("at"))).alias("window_state"),
    )
    whole, by_hour = Window.partitionBy(key), Window.partitionBy(key).orderBy("hour")
    passed = by_hour.rowsBetween(Window.unboundedPreceding, 0)
    left_behind = of_hour.select(
        key,
        "hour",
        F.sum("step").over(passed).alias("step"),
        F.last("window_state", ignorenulls=True).over(passed).alias("window_state"),
        F.lag("hour").over(by_hour).isNull().alias("__first"),
        F.lead("hour", 1).over(by_hour).alias("__next"),
        F.max("step").over(whole).isNotNull().alias("__busy"),
    ).filter("__busy")
    last_hour = upper - hour
    before = F.when(F.col("__first"), F.sequence(lower, F.col("hour"), hour))
    after = F.when(
        F.col("hour") < last_hour, F.sequence(F.col("hour") + hour, F.coalesce("__next", last_hour), hour)
    )
    nothing = F.array().cast("array<timestamp>")
    carried = F.struct("step", "window_state")
    openings = F.concat(
        F.transform(F.coalesce(before, nothing), lambda h: F.struct(h.alias("at"), F.when(F.lit(False), carried).alias("c"))),
        F.transform(F.coalesce(after, nothing), lambda h: F.struct(h.alias("at"), carried.alias("c"))),
    )
    opening = left_behind.select(key, F.inline(openings)).select(
        key, "at", F.col("c.step"), F.col("c.window_state"), F.col("at").alias("hour"), F.lit(0).alias("__own")
    )
    ordered = Window.partitionBy(key, "hour").orderBy("at", "__own")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.lead("at").over(ordered), F.col("hour") + F.expr("interval 1 hour"))
    swept = marks.withColumn("__own", F.lit(1)).unionByName(opening).select(
        key,
        "hour",
        F.last("window_state", ignorenulls=True).over(so_far).alias("__state"),
        F.sum("step").over(so_far).alias("__active"),
        F.min("__own").over(so_far).alias("__opened"),
        whole_seconds_between(F.col("at"), until).alias("duration"),
    )
    return _seconds_by_flag(swept.filter(F.col("__opened") == 0), key)


def classify_periods(
    keys: DataFrame, key: str, states: DataFrame, activity: DataFrame, lo: Instant, hi: Instant
) -> DataFrame:
    """The result of :func:`utilization_sweep` from interval tables.

    Instead of joining periods to the intervals they overlap, both interval tables become
    marks on one timeline and the values in force are carried forward: inside each (key,
    hour), from an opening mark that holds what earlier hours left behind.
    """
    marks = _marks(states, key, "window_state").unionByName(
        _marks(activity, key, "queries_active"), allowMissingColumns=True
    )
    marks = (
        # what the join below asks for is stated here, so that both uses of the marks share one shuffle
        marks.filter((F.col("at") >= as_column(lo)) & (F.col("at") < as_column(hi)))
        .filter(F.col(key).isNotNull() & hour_of("at").isNotNull())
        .groupBy(key, F.col("at"))
        .agg(F.max("window_state").alias("window_state"), F.max("queries_active").alias("queries_active"))
        .withColumn("hour", hour_of("at"))
    )
    left_behind = marks.groupBy(key, "hour").agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct("at", c))).alias(c) for c in ("window_state", "queries_active")]
    )
    earlier = Window.partitionBy(key).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        hour_ticks(keys.select(key), lo, hi)
        .join(left_behind, [key, "hour"], "left")
        .select(
            key,
            "hour",
            F.col("hour").alias("at"),
            *[
                F.last(F.col(c)[c], ignorenulls=True).over(earlier).alias(c)
                for c in ("window_state", "queries_active")
            ],
            F.lit(0).alias("__own"),
        )
    )
    line = marks.withColumn("__own", F.lit(1)).unionByName(opening)
    ordered = Window.partitionBy(key, "hour").orderBy("at", "__own")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    value = {c: F.last(F.col(c), ignorenulls=True).over(so_far)["value"] for c in ("window_state", "queries_active")}
    until = F.coalesce(F.lead("at").over(ordered), F.col("hour") + F.expr("interval 1 hour"))
    return _seconds_by_flag(
        line.select(
            key,
            "hour",
            whole_seconds_between(F.col("at"), until).alias("duration"),
            value["window_state"].alias("__state"),
            value["queries_active"].alias("__active"),
        ),
        key,
    ).join(keys.select(key), key, "left_semi")


def hourly_utilization(periods: DataFrame, key: str, decimal: str | None = None) -> DataFrame:
    """Seconds by flag and the utilized share of ON time per key and hour.

    The share is NULL in an hour that is OFF throughout.  ``decimal`` gives it a rounded
    decimal type.
    """
    seconds = {
        name: F.coalesce(F.sum(F.when(F.col("utilization_flag") == flag, F.col("duration"))), F.lit(0)).alias(name)
        for name, flag in (("utilized_seconds", "UTILIZED"), ("idle_seconds", "ON_IDLE"), ("off_seconds", "OFF"))
    }
    share = F.try_divide(F.col("utilized_seconds"), F.col("utilized_seconds") + F.col("idle_seconds"))
    return (
        periods.groupBy(key, "hour")
        .agg(*seconds.values(), F.coalesce(F.sum("duration"), F.lit(0)).alias("total_seconds"))
        .withColumn("utilization_proportion", share.cast(decimal) if decimal else share)
    )


def _seconds_by_flag(swept: DataFrame, key: str) -> DataFrame:
    """Durations of swept periods summed by key, hour and flag; empty periods drop out."""
    flag = (
        F.when(F.coalesce(F.col("__state"), F.lit(OFF)) == OFF, "OFF")
        .when(F.col("__active") > 0, "UTILIZED")
        .otherwise("ON_IDLE")
    )
    return (
        swept.filter(F.col("duration") > 0)
        .groupBy(key, "hour", flag.alias("utilization_flag"))
        .agg(F.sum("duration").alias("duration"))
    )


def _marks(intervals: DataFrame, key: str, value: str) -> DataFrame:
    """A mark where an interval starts and one where it ends; at one instant starts win.

    A mark is a struct that sorts ends (0) before starts (1); the value of an end is NULL.
    """
    ends = F.struct(F.lit(0).alias("opens"), F.lit(None).cast(intervals.schema[value].dataType).alias("value"))
    starts = F.struct(F.lit(1).alias("opens"), F.col(value).alias("value"))
    both = F.array(
        F.struct(F.col("start").alias("at"), starts.alias(value)),
        F.struct(F.col("end").alias("at"), ends.alias(value)),
    )
    return intervals.select(key, F.inline(both))
