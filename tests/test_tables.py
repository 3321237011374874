import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.operators import quality
from ledgerlight.sources import tables
from ledgerlight.streaming import incremental


def test_declared_tables_take_casts_and_keep_comments(spark, rows):
    declared = schemas.fact("app_usage")
    tables.declare_table(spark, "apps_fact", declared, ["workspace_id"], comment="It's the app fact")
    tables.declare_table(spark, "apps_fact", declared, ["workspace_id"])  # exists already: left alone
    row = spark.sql(
        "SELECT 'a' app_id, 'A' app_name, '2024-01-01' usage_date, 1 workspace_id, NULL workspace_name, 1.5 units,"
        " '2' dollars, 3 lifecycle_events, 4 distinct_users"
    )
    tables.insert_overwrite(row, "apps_fact")
    tables.insert_overwrite(row.withColumn("app_id", F.lit("b")), "apps_fact")
    back = spark.table("apps_fact")
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in declared}
    assert {f.name: f.metadata.get("comment") for f in back.schema} == {f.name: f.metadata["comment"] for f in declared}
    assert [r.app_id for r in back.collect()] == ["b"]
    assert spark.catalog.getTable("apps_fact").description == "It's the app fact"
    assert [c.name for c in spark.catalog.listColumns("apps_fact") if c.isPartition] == ["workspace_id"]
    assert tables.drop_tables(spark, ["apps_fact", "never_there"]) == ["apps_fact"]
    assert tables.table_or_empty(spark, "apps_fact", declared).count() == 0


def test_replacing_a_table_replaces_its_schema(spark):
    tables.replace_table(spark.range(3), "swap")
    tables.replace_table(spark.range(4).select(F.col("id").alias("n"), (F.col("id") % 2).alias("p")), "swap", ["p"], ["n"])
    assert spark.table("swap").columns == ["n", "p"]
    assert spark.table("swap").count() == 4
    tables.drop_tables(spark, ["swap"])


def test_null_partitions_survive(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x"), ("b", None)], "v string, p string")
    tables.write_partitions(df, path, ["p"])
    tables.write_partitions(spark.createDataFrame([("c", "x")], "v string, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "v", "p") == [("b", None), ("c", "x")]


def test_conform_and_union(spark, rows):
    wanted = schemas.struct("a int, b string")
    with pytest.raises(ValueError, match="missing"):
        tables.conform(spark.range(1), wanted)
    one = spark.createDataFrame([("1",)], "a string")
    two = spark.createDataFrame([("x", 2)], "b string, a int")
    assert rows(tables.union_frames([one, two], wanted)) == [(1, None), (2, "x")]


def test_merged_files_views_and_bound_sql(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(path)
    merged = tables.register_view(tables.read_merged(spark, path), "merged")
    assert sorted(merged.columns) == ["a", "b"]
    got = tables.query(spark, "SELECT a FROM IDENTIFIER(:t) WHERE a >= :low", {"t": "merged", "low": 2})
    assert rows(got) == [(2,)]
    assert tables.rows_to_frame(spark, [("v",)], "c string").first().c == "v"


def test_checks_and_enforcement(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 2)], "k string, n int")
    assert rows(quality.check_unique(df, ["k"])) == [("a", 2)]
    assert rows(quality.check_non_negative(df, ["n"])) == [("a", -1)]
    assert rows(quality.check_not_null(df, ["k", "n"])) == [(None, 2)]
    assert rows(quality.check_schema(df, schemas.struct("k string, n bigint, m int"), "t"), "column_name", "problem") == [("m", "missing"), ("n", "type changed")]
    with pytest.raises(quality.QualityError, match="grain"):
        quality.enforce(quality.check_unique(df, ["k"]), "grain must be unique")
    quality.enforce(df.filter("false"), "nothing")
    with pytest.raises(Exception, match="grain must be unique"):
        quality.assert_empty(quality.check_unique(df, ["k"]), "grain must be unique").collect()
    assert quality.assert_empty(df.filter("false"), "fine").collect()[0].passed is None


def test_marks_miss_neither_tied_nor_late_rows(frame, spark, rows):
    feed = frame("workspace_id string, t timestamp, v int", ("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("b", "2024-01-02", 3), ("c", "2024-01-05", 4))
    first = incremental.load_up_to(feed, "t", "2024-01-02")
    marks = incremental.advance_marks(incremental.no_marks(spark), first, "feed", "t")
    assert rows(marks) == [("feed", "a", "2024-01-01 00:00:00"), ("feed", "b", "2024-01-02 00:00:00")]
    tied_and_late = frame("workspace_id string, t timestamp, v int", ("b", "2024-01-02", 5), ("b", "2024-01-01 23:00:00", 6))
    second = incremental.rows_after_marks(feed.union(tied_and_late), marks, "feed", "t", overlap="1 hour")
    assert rows(second, "v") == [(1,), (2,), (3,), (4,), (5,), (6,)]
    whole = incremental.upsert_latest(first, second, ["v"], ["t"])
    assert rows(whole, "v") == [(1,), (2,), (3,), (4,), (5,), (6,)]
    marks = incremental.advance_marks(marks, second, "feed", "t")
    assert rows(incremental.rows_after_marks(feed, marks, "feed", "t", overlap="0 seconds"), "v") == [(2,), (3,), (4,)]


def test_upserts_touch_their_partitions_and_repeat_safely(spark, tmp_path, rows):
    path = str(tmp_path / "u")
    ddl = "k string, day string, at int, v string"
    args = (path, ["k"], ["at"], "day")
    incremental.upsert_partitions(spark.createDataFrame([("a", "d1", 1, "old"), ("b", "d2", 1, "kept")], ddl), *args)
    untouched = {p.name for p in (tmp_path / "u" / "day=d2").iterdir()}
    change = spark.createDataFrame([("a", "d1", 2, "new"), ("c", "d1", 1, "added")], ddl)
    for _ in range(2):
        incremental.upsert_partitions(change, *args)
    late = spark.createDataFrame([("a", "d1", 0, "late")], ddl)
    incremental.upsert_partitions(late, *args)
    assert rows(spark.read.parquet(path), "k", "v") == [("a", "new"), ("b", "kept"), ("c", "added")]
    assert {p.name for p in (tmp_path / "u" / "day=d2").iterdir()} == untouched
    # a key moves to another partition, and the partition it leaves is empty
    incremental.upsert_partitions(spark.createDataFrame([("b", "d1", 2, "moved")], ddl), *args)
    assert rows(spark.read.parquet(path), "k", "day", "v") == [("a", "d1", "new"), ("b", "d1", "moved"), ("c", "d1", "added")]
    assert not (tmp_path / "u" / "day=d2").exists()


def test_overwriting_replaces_all_partitions_in_either_session_mode(spark, rows):
    for n, mode in enumerate(("static", "dynamic")):
        table = f"overwritten_{n}"
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        schema = schemas.struct("v int, p string")
        tables.declare_table(spark, table, schema, ["p"])
        tables.insert_overwrite(spark.createDataFrame([(1, "x"), (2, "y")], schema), table)
        tables.insert_overwrite(spark.createDataFrame([(3, "x")], schema), table)
        assert rows(spark.table(table), "v", "p") == [(3, "x")]
        tables.insert_overwrite(spark.createDataFrame([(4, "y")], schema), table, touched_only=True)
        assert rows(spark.table(table), "v", "p") == [(3, "x"), (4, "y")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
        tables.drop_tables(spark, [table])
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_broken_lines_are_told_from_documents(spark, tmp_path, rows):
    (tmp_path / "lines.json").write_text('{"k": 1, "s": "a"}\n{"k": \n\n{"k": "x"}\nnull\n{"s": "b"}\n')
    schema = schemas.struct("k int, s string")
    path = str(tmp_path / "lines.json")
    assert rows(tables.read_documents(spark, path, schema)) == [(1, "a"), (None, "b")]
    assert rows(tables.read_bad_lines(spark, path, schema)) == [("null",), ('{"k": "x"}',), ('{"k": ',)]


def test_the_latest_of_rows_with_maps(spark, rows):
    from ledgerlight.operators.versions import latest_version

    data = [("a", 1, {"x": "1"}), ("a", 2, {"x": "2"}), ("a", 2, {"x": "3"}), ("b", None, None)]
    best = latest_version(spark.createDataFrame(data, "k string, at int, m map<string,string>"), ["k"], ["at"])
    assert sorted((r.k, r["at"], r.m) for r in best.collect()) == [("a", 2, {"x": "3"}), ("b", None, None)]


def test_stream_sums_survive_reruns_and_take_late_files(spark, tmp_path, rows):
    source, target, progress = (str(tmp_path / n) for n in ("in", "sums", "progress"))
    ddl = "day string, v int"

    def land(*data):
        spark.createDataFrame(list(data), ddl).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(ddl).parquet(source)
        sums = {"n": F.lit(1).cast("bigint"), "v": F.col("v").cast("bigint")}
        incremental.stream_partial_sums(stream, ["day"], sums, target, progress).awaitTermination()
        return rows(incremental.read_partial_sums(spark, target, ["day"], ["n", "v"]))

    land(("d1", 1), ("d1", 2), ("d2", 3))
    assert run() == [("d1", 2, 3), ("d2", 1, 3)]
    assert run() == [("d1", 2, 3), ("d2", 1, 3)]
    land(("d1", 10))  # late for a day already summed
    assert run() == [("d1", 3, 13), ("d2", 1, 3)]


def test_staged_rows_are_in_the_shared_folder_until_dropped(spark):
    from pathlib import Path

    from ledgerlight.session import drop_staged, shared_dir, staged

    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    drop_staged(spark)
    rows = staged(spark.range(10).filter("id > 3"))
    assert rows.count() == 6
    assert "Range" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert list(Path(configured).glob("staged-*"))
    assert drop_staged(spark) == 1 and not list(Path(configured).glob("staged-*"))


def test_marks_are_stored_by_load(spark, tmp_path, rows, frame):
    from ledgerlight.plans.incremental_cost import read_marks, save_marks

    path = str(tmp_path / "marks")
    assert read_marks(spark, path, -1).count() == 0
    marks = frame("source string, workspace_id string, high_mark timestamp", ("feed", "a", "2024-01-01"))
    save_marks(marks, path, 0)
    feed = frame("workspace_id string, t timestamp", ("a", "2024-01-02"))
    save_marks(incremental.advance_marks(read_marks(spark, path, 0), feed, "feed", "t"), path, 1)
    assert rows(read_marks(spark, path, 0)) == [("feed", "a", "2024-01-01 00:00:00")]
    assert rows(read_marks(spark, path, 1)) == [("feed", "a", "2024-01-02 00:00:00")]
