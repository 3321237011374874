"""Streams of documents, mergeable distinct counts, stored categories and checks while writing."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.operators import distinct, quality
from ledgerlight.plans import category_table
from ledgerlight.plans.assistant_cost import categorise_cost, space_cost_by_category
from ledgerlight.sources.documents import flatten_messages
from ledgerlight.streaming import messages


@pytest.fixture
def raw(spark):
    schema = schemas.document("message")

    def make(*rows):
        """(id, created ms, updated ms, content) as documents."""
        blank = {f.name: None for f in schema.fields}
        made = [blank | {"id": i, "message_id": i, "created_timestamp": c, "last_updated_timestamp": u, "content": t, "user_id": "1"} for i, c, u, t in rows]
        return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in made], schema)

    return make


def test_replayed_and_duplicated_documents_change_nothing(spark, raw, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    users = spark.createDataFrame([("1", "a@x")], "user_id string, user_email string")
    day = 86_400_000

    def run(*rows):
        if rows:
            raw(*rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.document("message")).parquet(source)
        messages.stream_messages(stream, users, target, progress).awaitTermination()
        stored = spark.read.parquet(target)
        return sorted((r.message_id, r.user_question, r.user_email) for r in stored.collect())

    first = [("m1", day, day, "one"), ("m2", 400 * day, 400 * day, "two"), ("m0", None, day, "no time")]
    want = [("m0", "no time", "a@x"), ("m1", "one", "a@x"), ("m2", "two", "a@x")]
    assert run(*first) == want
    assert run() == want
    untouched = {p.name for p in (tmp_path / "out" / "created_day=1971-02-05").iterdir()}
    assert run(first[0], first[0], ("m1", day, day - 5, "older")) == want
    assert run(("m1", day, day + 5, "newer"), ("m3", day, day, "three")) == [want[0], ("m1", "newer", "a@x"), want[2], ("m3", "three", "a@x")]
    assert run(*first) == [want[0], ("m1", "newer", "a@x"), want[2], ("m3", "three", "a@x")]
    assert {p.name for p in (tmp_path / "out" / "created_day=1971-02-05").iterdir()} == untouched
    # the same as a batch over the last versions
    batch = flatten_messages(raw(("m1", day, day + 5, "newer"), *first[1:], ("m3", day, day, "three")), users)
    stored = spark.read.parquet(target).select(*batch.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))


@pytest.mark.parametrize("period", ["day", "year"])
def test_a_folder_of_streamed_messages_has_one_file(spark, tmp_path, period):
    """A batch has no adaptive execution of its own, and each of its tasks would write into every folder."""
    raw_schema, source, target = schemas.document("message"), str(tmp_path / "in"), str(tmp_path / "out")
    users = spark.createDataFrame([("7", "a@x")], "user_id string, user_email string")
    day = 86_400_000
    rows = [{"id": f"m{i}", "created_timestamp": (i % 10) * 100 * day + i, "last_updated_timestamp": i + 1} for i in range(1, 200)]
    spark.createDataFrame(rows, raw_schema).repartition(4).write.parquet(source)
    options = {} if period == "day" else {"period": period}
    stream = spark.readStream.schema(raw_schema).parquet(source)
    messages.stream_messages(stream, users, target, str(tmp_path / "progress"), **options).awaitTermination()
    folders = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "out").glob("created_day=*")}
    assert set(folders.values()) == {1}
    assert len(folders) == {"day": 10, "year": 3}[period]
    assert spark.read.parquet(target).select("message_id").distinct().count() == 199


@pytest.fixture
def visits():
    rng = random.Random(5)
    rows = [(f"u{rng.randrange(400)}", f"s{rng.randrange(5)}", f"2024-0{rng.randrange(1, 4)}-1{rng.randrange(9)}") for _ in range(3000)]
    return [*rows, (None, "s1", "2024-01-11"), ("", "s1", "2024-01-11"), ("x", None, None)]


def test_distinct_users_merge_over_any_dimension(spark, visits):
    df = spark.createDataFrame(visits, "who string, space string, day string").repartition(3)
    numbers = distinct.number_ids(df, "who")
    known = {r.who: r.number for r in numbers.collect()}
    assert sorted(known.values()) == list(range(len({v[0] for v in visits if v[0] is not None})))
    grain = distinct.distinct_bitmaps(df.join(numbers, "who", "left"), ["space", "day"])
    sketches = distinct.distinct_sketches(df, ["space", "day"], "who")
    coarser = distinct.merge_bitmaps(grain.withColumn("month", F.substring("day", 1, 7)), ["space", "month"])
    for of, dims in ((grain, ["day"]), (grain, ["space"]), (grain, []), (coarser, ["month"]), (coarser, ["space", "month"])):
        want = defaultdict(set)
        for who, space, day in visits:
            if who is not None:
                at = {"day": day, "space": space, "month": day and day[:7]}
                want[tuple(at[d] for d in dims)].add(who)
        got = {tuple(r[d] for d in dims): r.users for r in distinct.count_bitmaps(of, dims, "users").collect()}
        assert got == {k: len(v) for k, v in want.items()}
        if of is grain:
            about = {tuple(r[d] for d in dims): r.users for r in distinct.count_sketches(sketches, dims, "users").collect()}
            assert all(abs(about[k] - len(v)) <= 0.1 * len(v) + 1 for k, v in want.items())


def test_new_ids_follow_the_known_ones(spark):
    first = distinct.number_ids(spark.createDataFrame([("b",), ("a",), ("b",)], "who string"), "who")
    more = distinct.number_ids(spark.createDataFrame([("c",), ("a",), (None,)], "who string"), "who", first)
    known, both = ({r.who: r.number for r in df.collect()} for df in (first, more))
    assert both == {**known, "c": 2}
    none = spark.createDataFrame([], "who string")
    assert distinct.number_ids(none, "who").collect() == []


COST = """statement_id string, query_source_type string, query_source_id string, workspace_id string, statement_text string,
  query_work_task_time_seconds double, query_attributed_dollars_estimation double, query_attributed_units_estimation double"""


def test_categories_are_stored_once_and_joined_without_a_shuffle(spark, tmp_path):
    texts = ["SELECT 1", " describe t", "SELECT approx_top_k(c, 1024)", "with sampleddata as (select 1) select 2", None]
    rows = [(f"q{n}", "ASSISTANT SPACE" if n % 7 else "OTHER", f"sp{n % 3}", "1", texts[n % 5], float(n % 2), n / 8, n / 4) for n in range(200)]
    cost = spark.createDataFrame(rows, COST)
    links = spark.createDataFrame([(f"q{n}",) for n in range(0, 200, 9)] + [(None,)], "statement_id string")
    spaces = spark.createDataFrame([(f"sp{n}", f"Space {n}") for n in range(2)], "space_id string, name string")
    table, costs = f"categories_{tmp_path.name}".replace("-", "_"), f"costs_{tmp_path.name}".replace("-", "_")

    def scanned():
        return spark.table(table).count()

    first = cost.filter("CAST(substring(statement_id, 2) AS INT) < 120")
    assert category_table.fill_categories(first, links.filter("statement_id <> 'q9'"), table, buckets=4) == 0
    before = scanned()
    assert category_table.fill_categories(first, links.filter("statement_id <> 'q9'"), table, buckets=4) == 1
    assert scanned() == before  # nothing is new
    category_table.fill_categories(cost, links, table, buckets=4)
    new = sum(r[1] == "ASSISTANT SPACE" and int(r[0][1:]) >= 120 for r in rows)
    assert scanned() == before + new + 1  # q9 is named by a message now
    category_table.save_cost(cost, costs, buckets=4)

    want = categorise_cost(cost.withColumns({c: F.lit(None).cast("string") for c in ("executed_by",)}), links)
    stored = category_table.categorised_cost(spark, costs, table)
    picked = ("statement_id", "cost_category", "cost_class", "query_attributed_dollars_estimation")
    assert sorted(map(tuple, stored.select(*picked).collect())) == sorted(map(tuple, want.select(*picked).collect()))
    by_category = [sorted(map(str, space_cost_by_category(c, spaces).collect())) for c in (stored, want)]
    assert by_category[0] == by_category[1]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = category_table.categorised_cost(spark, costs, table)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "statement_text" not in plan
    for name in (table, costs):
        spark.sql(f"DROP TABLE {name}")


def test_violations_are_counted_by_the_writing_job(spark, tmp_path):
    rows = [(1, "a", 5), (1, "b", -1), (2, None, None), (3, "c", 0), (None, "d", 2), (None, "e", 1)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    path = str(tmp_path / "checked")
    counts = quality.write_checked(df, lambda x: x.write.parquet(path), unique=["k"], non_negative=["v"], not_null=["s", "v"])
    assert counts == {"rows": 6, "non_negative:v": 1, "not_null:s": 1, "not_null:v": 1, "unique": 4}
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == sorted(rows, key=str)
    none = quality.write_checked(df.limit(0), lambda x: x.write.parquet(f"{path}-none"), unique=["k"])
    assert none == {"rows": 0, "unique": 0}
    # a fact grouped by its key is not dealt again
    grouped = df.groupBy("k").agg(F.sum("v").alias("v"))
    seen = []
    quality.write_checked(grouped, lambda x: seen.append(x) or x.write.parquet(f"{path}-grouped"), unique=["k"])
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
