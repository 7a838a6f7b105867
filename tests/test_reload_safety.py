"""Schema reconciliation, staged publication, late copies, counts of the writing job, tags by lookup."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagmill.operators import casetags
from tagmill.plans import exports, loads
from tagmill.sinks import partitions
from tagmill.sinks.schemas import SchemaMismatch, merged_schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ddl(text):
    return StructType.fromDDL(text)


def test_merged_schema(spark):
    target = ddl("id int, price float, day date, name string, p string")
    schema, added, widened = merged_schema(target, ddl("ID bigint, price float, extra decimal(5,2), day timestamp_ntz, p string"), ["p"])
    assert schema.simpleString() == "struct<id:bigint,price:float,day:timestamp_ntz,name:string,extra:decimal(5,2),p:string>"
    assert [f.name for f in added] == ["extra"] and widened == ["id", "day"]
    same, added, widened = merged_schema(target, ddl("id smallint, p string"), ["p"])
    assert same == ddl("id int, price float, day date, name string, p string") and not added and not widened


@pytest.mark.parametrize(
    "source",
    ["id string, p string", "id int, price double, p int", "id int", "price decimal(10,2), p string", "name binary, p string"],
)
def test_lossy_sources_are_refused(spark, source):
    with pytest.raises(SchemaMismatch):
        merged_schema(ddl("id int, price float, name string, p string"), ddl(source), ["p"])


def test_grown_shrunk_and_widened_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, old string, p string")
    partitions.create_like(spark, "reshaped", first, ["p"], path)
    partitions.overwrite_partitions(first, "reshaped")
    second = spark.createDataFrame([("y", 2**40, 0.5)], "p string, id bigint, new double")
    assert partitions.overwrite_partitions(second, "reshaped") == 1
    assert rows(spark.table("reshaped").select("id", "old", "new", "p")) == [(1, "a", None, "x"), (2**40, None, 0.5, "y")]
    narrow = spark.createDataFrame([("x", 7)], "p string, id int")
    partitions.overwrite_partitions(narrow, "reshaped")
    assert rows(spark.table("reshaped").where("p = 'x'").select("id", "old", "new")) == [(7, None, None)]
    before = rows(spark.table("reshaped"))
    with pytest.raises(SchemaMismatch):
        partitions.overwrite_partitions(spark.createDataFrame([("x", "seven")], "p string, id string"), "reshaped")
    assert rows(spark.table("reshaped")) == before
    spark.sql("DROP TABLE reshaped")


def test_managed_tables_are_not_dropped_to_widen_them(spark):
    partitions.create_like(spark, "managed", spark.createDataFrame([(1,)], "id int"))
    partitions.overwrite_table(spark.createDataFrame([(1,)], "id int"), "managed")
    with pytest.raises(SchemaMismatch):
        partitions.overwrite_table(spark.createDataFrame([(1,)], "id bigint"), "managed")
    partitions.overwrite_table(spark.createDataFrame([(3, "n")], "id int, note string"), "managed")
    assert rows(spark.table("managed")) == [(3, "n")]
    spark.sql("DROP TABLE managed")


def test_full_load_that_reads_its_own_table_may_grow(spark, tmp_path):
    loads.load_full(spark.createDataFrame([(1,), (2,)], "id int"), "doubled", str(tmp_path / "g"))
    assert loads.load_full(spark.table("doubled").withColumn("twice", F.col("id") * 2), "doubled") == 2
    assert rows(spark.table("doubled")) == [(1, 2), (2, 4)]
    spark.sql("DROP TABLE doubled")


def test_a_failed_publication_keeps_the_old_partition(spark, tmp_path):
    df = spark.createDataFrame([(i, "2024-01-01" if i % 2 else "2024-01-02") for i in range(40)], "n int, dt string")
    partitions.create_like(spark, "published", df, ["dt"], str(tmp_path / "p"))
    partitions.overwrite_partitions(df, "published")
    day = df.where("dt = '2024-01-01'")
    before = rows(spark.table("published"))
    dying = day.repartition(4).withColumn("n", F.when(F.col("n") == 17, F.raise_error(F.lit("dies")).cast("int")).otherwise(-F.col("n")))
    with pytest.raises(Exception, match="dies"):
        partitions.publish_partition(dying, "published", "dt", "2024-01-01")
    assert rows(spark.table("published")) == before
    with pytest.raises(Exception, match="row outside"):
        partitions.publish_partition(df, "published", "dt", "2024-01-01")
    assert rows(spark.table("published")) == before
    at = partitions.partition_location(spark, "published", "dt", "2024-01-01")
    assert partitions.publish_partition(day.withColumn("n", -F.col("n")), "published", "dt", "2024-01-01") == 20
    assert partitions.partition_location(spark, "published", "dt", "2024-01-01") != at
    assert rows(spark.table("published").where("dt = '2024-01-01'")) == rows(day.withColumn("n", -F.col("n")))
    assert rows(spark.table("published").where("dt = '2024-01-02'")) == rows(df.where("dt = '2024-01-02'"))
    now = partitions.partition_location(spark, "published", "dt", "2024-01-01")
    assert now not in partitions.stale_folders(spark, "published", "dt", "2024-01-01")
    assert partitions.publish_partition(day.limit(0), "published", "dt", "2024-01-01") == 0
    assert now in partitions.stale_folders(spark, "published", "dt", "2024-01-01")
    assert partitions.publish_partition(day.withColumn("dt", F.lit("2024-01-03")), "published", "dt", "2024-01-03") == 20
    assert spark.table("published").groupBy("dt").count().orderBy("dt").collect() == [("2024-01-02", 20), ("2024-01-03", 20)]
    spark.sql("DROP TABLE published")


def test_a_lost_file_stops_a_publication(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a")], "n int, dt string")
    partitions.create_like(spark, "short", df, ["dt"], str(tmp_path / "s"))
    partitions.overwrite_partitions(df, "short")

    class Seen:
        get = {"rows": 2}

    monkeypatch.setattr(partitions, "counted", lambda rows, copies=None: (rows, Seen()))
    with pytest.raises(RuntimeError, match="nothing is published"):
        partitions.publish_partition(df, "short", "dt", "a")
    assert rows(spark.table("short")) == [(1, "a")]
    spark.sql("DROP TABLE short")


def test_late_copies_are_counted(spark, tmp_path):
    kind = "k int, v string"
    loads.load_append(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], kind), "copies", "k", "2024-01-01", str(tmp_path / "c"))
    late = [(1, "a"), (2, "b"), (2, "b"), (2, "c"), (None, "n"), (None, "n"), (None, None), (1, "late below")]
    for _ in range(2):
        assert loads.load_append(spark.createDataFrame(late, kind), "copies", "k", "2024-01-02") == 4
    got = spark.table("copies").where("load_dt = '2024-01-02'").select("k", "v")
    assert rows(got) == sorted([(2, "b"), (2, "c"), (None, "n"), (None, None)], key=repr)
    spark.sql("DROP TABLE copies")


def test_event_counts_come_from_the_writing_job(spark, tmp_path):
    from tagmill.operators.events import EVENT_COLUMNS

    base = spark.range(30).select(*[F.lit("v").alias(c) if c not in ("dt", "url") else F.lit(None).cast("string").alias(c) for c in EVENT_COLUMNS], "id")
    df = base.withColumns({"dt": F.to_date(F.lit("2024-01-08")), "url": (F.col("id") % 7).cast("string")}).drop("id")
    path = str(tmp_path / "days")
    assert exports.daily_event_counts(df, "2024-01-15", path) == (30, 7)
    assert spark.read.parquet(path).count() == 7 and "_copies" not in spark.read.parquet(path).columns
    assert exports.daily_event_counts(df.limit(0), "2024-01-15", path) == (0, 0)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


@pytest.mark.parametrize("scope", ["value", "column"])
def test_tags_by_lookup_equal_the_expression(spark, monkeypatch, scope):
    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abc-_%\\é") for _ in range(n))
    texts = [None, "", "%", "abc"] + [word(rnd.randint(1, 14)).replace("\\", "") for _ in range(150)]
    df = spark.createDataFrame([(t, rnd.choice(texts), i) for i, t in enumerate(texts * 2)], "`first url` string, b string, user_tag_1 int")
    rules = [(rnd.choice(["first url", "b"]), f"%{word(rnd.randint(0, 3)).replace(chr(92), '')} %", rnd.choice("xyz")) for _ in range(300)]
    rules += [("b", "_b%c", "x"), ("b", "%\\_%", "y"), ("b", None, "z"), ("b", "abc", None), ("first url", "a%", "w")]
    code_map = spark.createDataFrame(rules, "mapping_col string, transfer_rule string, value string")
    want = df.withColumns(casetags.tag_columns(code_map, scope))
    got = casetags.with_tags_by_lookup(df, code_map, scope)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(*[F.col(f"`{c}`") for c in want.columns])) == rows(want)
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "_text0" not in plan(casetags.with_tags(df, code_map.limit(20), scope))
    monkeypatch.setattr(casetags, "COMPARED", 100)
    assert "_text0" in plan(casetags.with_tags(df, code_map, scope))


def test_lookup_without_rules(spark):
    df = spark.createDataFrame([("a",)], "u string")
    assert casetags.with_tags_by_lookup(df, spark.createDataFrame([], "mapping_col string, transfer_rule string, value string")).columns == ["u"]


def test_deliveries_keep_what_they_cannot_read(spark, tmp_path):
    files = {
        "a.csv": "id,name,score\n1,x,0.5\n2,y,bad\n3,z\n4,w,1,9\n\n5,\"q,r\",2\n",
        "b.csv": "﻿SCORE,Id,name\n7.5,8,b\nid,name,score,more\n",
        "c.csv": "9,no,1\n",
        "d.csv": "id,name,score\n10,x,1\nname,id,score\nx,11,1\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    kind = ddl("id long, name string, score double")
    good, bad = loads.read_deliveries(spark, str(tmp_path), kind)
    base = F.element_at(F.split("source_file", "/"), -1)
    assert rows(good.withColumn("source_file", base)) == sorted(
        [(1, "x", 0.5, "a.csv"), (5, "q,r", 2.0, "a.csv"), (8, "b", 7.5, "b.csv")], key=repr
    )
    want = [("a.csv", t, "unreadable") for t in ("2,y,bad", "3,z", "4,w,1,9")] + [("b.csv", "id,name,score,more", "unreadable")]
    want += [("c.csv", "9,no,1", "no header"), ("d.csv", "10,x,1", "two headers"), ("d.csv", "x,11,1", "two headers")]
    assert rows(bad.withColumn("source_file", base)) == sorted(want, key=repr)


def test_equal_depth_cuts(spark):
    from tagmill.sources.jdbc import equal_depth_predicates

    df = spark.range(4000).selectExpr("if(id % 3 = 0, 5, id) AS k", "if(id % 50 = 0, null, date_add(date'2024-01-01', cast(id * id % 700 as int))) AS d")
    for column, most in (("k", 1400), ("d", 520)):
        cuts = equal_depth_predicates(df, column, 10)
        counts = df.agg(*[F.count_if(F.coalesce(F.expr(c), F.lit(False))) for c in cuts]).first()
        assert sum(counts) == 4000 and max(counts) <= most and len(cuts) > 5
    assert equal_depth_predicates(df.limit(0), "k", 10) == equal_depth_predicates(df, "k", 1) == ["1 = 1"]
    with pytest.raises(ValueError):
        equal_depth_predicates(df.selectExpr("cast(k as double) k"), "k", 3)


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    from tagmill.sinks.bucketed import side_by_side, write_bucketed

    a = spark.range(200).selectExpr("cast(id % 60 as string) AS u", "id AS x").dropDuplicates(["u"])
    b = spark.range(30, 90).selectExpr("cast(id as string) AS u", "id AS y")
    write_bucketed(a, "side_a", "u", str(tmp_path / "a"), 4)
    write_bucketed(b, "side_b", "u", str(tmp_path / "b"), 4)
    both = side_by_side(spark, "side_a", "side_b", "u")
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert rows(both) == rows(a.join(b, "u", "full_outer"))
    assert "Exchange" not in spark.table("side_a").groupBy("u").count()._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        side_by_side(spark, "side_a", "side_a", "u")
    for name in ("side_a", "side_b"):
        spark.sql(f"DROP TABLE {name}")


def test_all_templates_are_tried(spark, tmp_path):
    texts = {"one": "SELECT 1 AS n", "bad": "SELECT missing FROM nowhere", "two": "SELECT 2 AS n"}
    with pytest.raises(Exception, match="nowhere"):
        exports.template_exports(spark, texts, str(tmp_path), "2024-01-20")
    assert [spark.read.parquet(f"{tmp_path}/{n}_2024_01_20").first().n for n in ("one", "two")] == [1, 2]


def test_base_queries_survive_a_missing_module(monkeypatch):
    import sys

    import __spark_entry__ as entry
    from workload import all_queries

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.warns(UserWarning, match="corpus_pipeline"):
        assert set(entry.queries()) == set(all_queries())
