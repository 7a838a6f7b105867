import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tagmill import session
from tagmill.functions import dates, types
from tagmill.operators import calendar
from tagmill.operators import events as E
from tagmill.operators.casetags import tag_columns
from tagmill.operators.interest import degree_matrix
from tagmill.plans import loads
from tagmill.plans.labels import product_tag_partition
from tagmill.sinks import files, jdbc, partitions, runlog
from tagmill.sources import jdbc as source_jdbc
from tagmill.sources import tables
from tagmill.sources.files import read_tsv, vendor_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_date_parameters():
    assert dates.shift("2024-03-03", -7) == "2024-02-25"
    assert dates.month_name("event_yyyymm", dates.shift("2024-03-03", -7)) == "event_202402"
    assert dates.table_suffix("2024-01-31") == "2024_01_31" and dates.compact("2024-01-31") == "20240131"
    assert jdbc.snapshot_name("t", "2024-01-31") == "t_2024_01_31"
    assert loads.month_bounds("2024-12-31") == ("2024-12-01", "2025-01-01")
    assert vendor_path("/in/", "seg_{date}*.csv", "2024-01-05") == "/in/seg_20240105*.csv"


def test_malformed_times_become_null(spark):
    texts = ["20240131235959123", "2024", "20241331235959123", "x0240131235959123", None]
    df = spark.createDataFrame([(t,) for t in texts], "tm string")
    got = [r[0] for r in df.select(dates.parse_tm(F.col("tm"))).collect()]
    assert got == [dt.datetime(2024, 1, 31, 23, 59, 59, 123000), None, None, None, None]
    assert df.select(dates.parse_tm(F.col("tm"), zoned=True)).dtypes[0][1] == "timestamp"


def test_grid_reaches_back(spark):
    df = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-02-28')) AS dt")
    got = [r.dt.isoformat() for r in E.snapshots_on_grid(df, "2024-01-29").collect()]
    assert got == ["2024-01-01", "2024-01-15", "2024-01-29", "2024-02-12", "2024-02-26"]


def test_dedup_treats_nulls_as_equal(spark):
    df = spark.createDataFrame(
        [("u", None, 3), ("u", None, 1), ("u", "x", 2), ("u", "x", 5), ("v", None, 4)], "a string, b string, n int"
    )
    assert rows(E.dedup_events(df, ["a", "b"], order_by="n")) == [("u", "x", 2), ("u", None, 1), ("v", None, 4)]
    once = E.dedup_events(df, ["a", "b"])
    assert once.count() == 3 and E.dedup_events(once, ["a", "b"]).count() == 3
    report = E.duplicate_report(df, ["a", "b"], "a").first()
    assert tuple(report) == (5, 3, 2)
    assert tuple(E.duplicate_report(df.limit(0), ["a", "b"], "a").first()) == (0, 0, 0)


def test_typed_wide(spark):
    values = [(" 7 ", "1e3", "x", True), ("1.5", "nan", "y", False)]
    df = spark.createDataFrame(values, "i string, f string, s string, b boolean")
    got = types.cast_wide(df, {"i": "int64", "f": "float64", "s": "int32", "b": "bool"})
    assert [t for _, t in got.dtypes] == ["bigint", "double", "int", "string"]
    first, second = got.collect()
    assert tuple(first) == (7, 1000.0, None, "true") and second.i is None and second.f != second.f


def test_partition_overwrite_touches_only_its_partitions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    partitions.create_like(spark, "parts", df, ["p"])
    assert partitions.overwrite_partitions(df, "parts") == 2
    again = spark.createDataFrame([("b", 3), ("b", 4)], "p string, n int")
    assert partitions.overwrite_partitions(again, "parts") == 2
    assert partitions.overwrite_partitions(again.limit(0), "parts") == 0
    assert rows(spark.table("parts")) == [(1, "a"), (3, "b"), (4, "b")]


def test_full_overwrite_may_read_its_target_and_empties_it(spark):
    assert loads.load_full(spark.range(3), "whole") == 3
    assert loads.load_full(spark.table("whole").where("id > 0"), "whole") == 2
    assert rows(spark.table("whole")) == [(1,), (2,)]
    assert loads.load_full(spark.range(0), "whole") == 0
    assert rows(spark.table("whole")) == []
    with pytest.raises(ValueError, match="no partitions"):
        partitions.overwrite_partitions(spark.range(1), "whole")


def test_replace_day_refuses_other_days(spark, tmp_path):
    day = spark.sql("SELECT 1 AS n, date'2024-01-01' AS dt UNION ALL SELECT 2, date'2024-01-02'")
    partitions.overwrite_paths(day, str(tmp_path / "d"), ["dt"])
    with pytest.raises(Exception, match="row outside 2024-01-02"):
        partitions.replace_day(day, str(tmp_path / "d"), "2024-01-02")
    assert partitions.replace_day(day.where("n = 2"), str(tmp_path / "d"), "2024-01-02") == 1
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2


def test_run_log_keeps_one_row_per_task_and_date(spark, tmp_path):
    log = str(tmp_path / "log")
    for task, day, count in (("a", 1, 1), ("a", 2, 2), ("b", 1, 3), ("a", 1, 9)):
        runlog.log_run(spark, log, task, f"2024-01-0{day}", "db", "t", count)
    assert sorted((r.task_id, str(r.run_date), r.row_count) for r in runlog.read_log(spark, log).collect()) == [
        ("a", "2024-01-01", 9),
        ("a", "2024-01-02", 2),
        ("b", "2024-01-01", 3),
    ]


def test_product_tags_without_rows_keep_the_partition_and_log_zero(spark, tmp_path):
    names = ["product_label", "mapping_col", "transfer_rule", "value", "product_type", "dt"]
    rules = spark.createDataFrame([("P", "url", "%a%", "v", "t1", "2024-01-01")], names)
    run = {"task_id": "t", "run_date": "2024-01-02", "log_path": str(tmp_path / "log"), "product_label2": "second"}
    source = spark.createDataFrame([("abc",), ("xyz",)], "url string")
    assert product_tag_partition(source, rules, "p", "tags", **run) == 2
    assert product_tag_partition(source.limit(0), rules, "p", "tags", **run) == 0
    assert rows(spark.table("tags").select("url", "user_tag", "product_label2", "product_type")) == [
        ("abc", "v", "second", "t1"),
        ("xyz", None, "second", "t1"),
    ]
    assert [(r.hive_db, r.target_table, r.row_count) for r in runlog.read_log(spark, run["log_path"]).collect()] == [
        ("default", "tags", 0)
    ]


def test_append_is_rerun_safe(spark):
    first, second = spark.range(0, 5).withColumnRenamed("id", "k"), spark.range(0, 9).withColumnRenamed("id", "k")
    assert loads.load_append(first, "grown", "k", "2024-01-01") == 5
    for _ in range(2):
        assert loads.load_append(second, "grown", "k", "2024-01-02") == 4
    assert loads.load_append(second, "grown", "k", "2024-01-03") == 0
    assert [r.k for r in spark.table("grown").orderBy("k").collect()] == list(range(9))
    with pytest.raises(ValueError, match="after 2024-01-01"):
        loads.load_append(second, "grown", "k", "2024-01-01")


def test_append_takes_late_and_missing_keys(spark):
    rows_of = lambda *ids: spark.createDataFrame([(i, d) for i, d in delivered if i in ids], "id int, d string")
    delivered = [(1, "d1"), (2, "d2"), (3, "d2"), (4, "d3"), (5, None), (6, None)]
    assert loads.load_append(rows_of(1, 2, 5), "late", "d", "2024-01-01") == 3
    for _ in range(2):
        assert loads.load_append(rows_of(1, 2, 3, 4, 5, 6), "late", "d", "2024-01-02") == 3
    assert sorted(r.id for r in spark.table("late").collect()) == [1, 2, 3, 4, 5, 6]
    nulls = spark.createDataFrame([(1, None)], "id int, d string")
    loads.load_append(nulls, "late_nulls", "d", "2024-01-01")
    assert loads.load_append(rows_of(1, 2), "late_nulls", "d", "2024-01-02") == 2


def test_many_cases_make_a_shallow_tree(spark):
    rules = spark.range(3_000).selectExpr("'url' AS mapping_col", "concat('%', id, 'x%') AS transfer_rule", "'v' AS value")
    tags = tag_columns(rules)
    got = spark.createDataFrame([("a17x",), ("a",)], "url string").withColumns(tags).collect()
    assert [r.user_tag for r in got] == ["v", None]


def test_unknown_degree_is_an_error(spark):
    facts = spark.createDataFrame([(1, "c", "high")], "customuid int, interest_category string, degree string")
    with pytest.raises(Exception, match="degree outside the given ones: high"):
        degree_matrix(facts, categories=["c"], degrees=["low"]).collect()


def test_tsv_keeps_every_text(spark, tmp_path):
    texts = ["a\tb", "a\nb\r", "\\", "\\n", "\\\\t\\", "\\N", "", None, '"q"', "é"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int")
    files.export_tsv(df, str(tmp_path / "t"))
    assert [r.t for r in sorted(read_tsv(spark, str(tmp_path / "t"), df.schema).collect(), key=lambda r: r.i)] == texts


def test_load_specs(spark):
    record = {"hive_db": "default", "sql_db": "crm", "table": "x", "pattern_type": "full", "key_to_new_data": "",
              "crontab_update_frequency": "* * * * *", "driver_memory_import_data": "3g"}
    spec = tables.LoadSpec.from_record(record)
    assert spec.target == "default.crm_x" and loads.load(spark.range(2), spec, "2024-01-01") == 2
    listed = spark.createDataFrame([("default", "crm", "x", "full")], ["hive_db", "sql_db", "table", "pattern_type"])
    assert [s.target for s in tables.LoadSpec.from_table(listed)] == [spec.target]
    with pytest.raises(ValueError, match="key_to_new_data"):
        tables.LoadSpec.from_record({**record, "pattern_type": "append"})
    with pytest.raises(ValueError, match="none of"):
        tables.LoadSpec.from_record({**record, "pattern_type": "other"})
    with pytest.raises(ValueError, match="plain name"):
        tables.LoadSpec.from_record({**record, "table": "x; DROP"})
    month = tables.LoadSpec("default", "crm", "m", "yyyymm", "day")
    days = spark.sql("SELECT explode(sequence(date'2024-01-30', date'2024-02-02')) AS day")
    assert loads.load(days, month, "2024-02-10") == 2 and loads.load(days, month, "2024-01-10") == 2
    assert spark.table(month.target).groupBy("yyyymm").count().count() == 2


VENDOR = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_vendor_files(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('id,name\n1,"a, b"\n2,\n', encoding="utf-8")
    bad.write_text("id,name\n1,a\nx,b\n", encoding="utf-8")
    with pytest.raises(ValueError, match="1 unreadable lines.*x,b"):
        loads.load_vendor_file(spark, str(bad), VENDOR, "vendor", "2024-01-01")
    for _ in range(2):
        assert loads.load_vendor_file(spark, str(good), VENDOR, "vendor", "2024-01-01") == 2
    assert loads.load_vendor_file(spark, str(bad), VENDOR, "vendor", "2024-01-02", bad_lines=1) == 1
    assert rows(spark.table("vendor").select("id", "name")) == [(1, "a"), (1, "a, b"), (2, None)]


def test_exports_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", 'q"x', 1), ("", None, 2)], "s string, t string, dt int")
    out = str(tmp_path / "out")
    csv = lambda: spark.read.schema(df.schema).options(header=True, nullValue="none").csv(out)
    for export, read in ((files.export_tsv, lambda: read_tsv(spark, out, df.schema)), (files.export_csv, csv)):
        export(df, out)
        assert {tuple(r) for r in read().collect()} == {("a\tb", 'q"x', 1), ("", None, 2)}
        export(df, out, "2")
        assert read().count() == 1


def test_templates(spark):
    frame = spark.range(5)
    got = tables.run_template(spark, "SELECT {c} FROM {t} WHERE id < :n", {"c": "id"}, {"n": 2}, t=frame)
    assert rows(got) == [(0,), (1,)]
    with pytest.raises(ValueError, match="plain name"):
        tables.run_template(spark, "SELECT {c}", {"c": "1; DROP"})
    assert tables.run_text_template(spark, "SELECT '{baseTime}' AS d", baseTime="2024-01-01").first().d == "2024-01-01"
    with pytest.raises(ValueError, match="unsafe"):
        tables.run_text_template(spark, "SELECT '{d}'", d="x' OR '1")
    with pytest.raises(ValueError, match="unsafe"):
        tables.run_text_template(spark, "SELECT '{d}'", d="\\")
    assert tables.preview(frame, 2, "id").count() == 2


def test_jdbc_text():
    """Options and statements only: no database is started for tests."""
    link = source_jdbc.Connection.sqlserver("host:1", "db", "me", "secret")
    assert "secret" not in repr(link) and link.url == "jdbc:sqlserver://host:1;databaseName=db"
    options = jdbc.write_options(link, "t", truncate=True)
    assert options["dbtable"] == "t" and options["truncate"] == "true" and options["password"] == "secret"
    assert source_jdbc.split_options("k", 1, 9, 4)["numPartitions"] == "4"
    delete, insert = jdbc.day_statements("t_staging", "t", ["a", 'b"c'], "2024-01-08")
    assert delete == "DELETE FROM t WHERE \"dt\" = '2024-01-08'"
    assert insert == 'INSERT INTO t ("a", "b""c") SELECT "a", "b""c" FROM t_staging'
    with pytest.raises(ValueError):
        jdbc.day_statements("s", "t; DROP", ["a"], "2024-01-08")


def test_scratch_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster)


def test_day_slice_prunes_partitions(spark, tmp_path, capsys):
    df = spark.sql("SELECT 1 AS n, explode(sequence(date'2024-01-01', date'2024-01-10')) AS dt")
    df.write.partitionBy("dt").parquet(str(tmp_path / "p"))
    day = E.day_slice(spark.read.parquet(str(tmp_path / "p")), "2024-01-15")
    day.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(dt" in plan and day.count() == 1 and "Python" not in plan


def test_calendar_prunes_partitions_when_read(spark, tmp_path):
    path = str(tmp_path / "by_day")
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-02-28')) AS dt")
    days.selectExpr("dt", "cast(day(dt) % 5 as string) AS u").write.partitionBy("dt").parquet(path)
    stored = spark.read.schema("u string, dt date").parquet(path)
    table = calendar.calendar(spark, "2023-12-25", "2024-03-31")
    grid = calendar.snapshots_by_calendar(stored, table, "2024-01-29")
    assert "dynamicpruning" in grid._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.dt.isoformat() for r in grid.collect()) == ["2024-01-01", "2024-01-15", "2024-01-29", "2024-02-12", "2024-02-26"]
    windows = calendar.look_backs(table, F.col("weekday") == 1, 6)
    inside = calendar.events_in_windows(stored, windows)
    assert "dynamicpruning" in inside._jdf.queryExecution().executedPlan().toString()
    got = {r.base.isoformat(): r.n for r in inside.groupBy("base").agg(F.count("*").alias("n")).collect()}
    assert got["2024-01-07"] == got["2024-02-25"] == 7 and got["2024-03-03"] == 3 and "2023-12-31" not in got


def test_sketches_of_windows(spark):
    df = spark.range(40_000).selectExpr("cast(id % 15000 as string) AS distinct_id", "date_add(date'2024-01-01', cast(id % 10 as int)) AS dt")
    df = df.unionAll(spark.sql("SELECT cast(null as string), date'2024-01-01'"))
    windows = spark.sql("SELECT date'2024-01-10' AS base, explode(sequence(date'2024-01-01', date'2024-01-10')) AS day").unionAll(
        spark.sql("SELECT date'2023-06-01', date'2023-06-01'")
    )
    sketches = calendar.daily_sketches(df)
    got = {r.base.isoformat(): r.users for r in calendar.users_in_windows(sketches, windows).collect()}
    assert sketches.count() == 10 and abs(got["2024-01-10"] - 15_000) < 450 and got["2023-06-01"] == 0
