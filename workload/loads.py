"""Loads into tables and files, each read back after its last run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tagmill.plans import loads
from tagmill.session import materialize, scratch_path
from tagmill.sinks import files
from tagmill.sinks.partitions import create_like, overwrite_partitions, overwrite_paths, publish_partition, replace_day
from tagmill.sources.files import read_tsv
from tagmill.sources.jdbc import equal_depth_predicates
from tagmill.sources.tables import LoadSpec
from workload.inputs import scratch_table, small, table, written


def load_full(spark, folder):
    """A first, doubled content is replaced by the source."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_full")
    loads.load_full(orders.unionAll(orders), name, path)
    loads.load_full(orders, name, path)
    return written(spark, name, path)


def load_append(spark, folder):
    """The source grows between two loads; the second load runs twice."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_append")
    early = orders.where(F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz"))
    loads.load_append(early, name, "o_orderdate", "2024-01-01", path)
    for _ in range(2):
        loads.load_append(orders, name, "o_orderdate", "2024-01-02", path)
    return written(spark, name, path)


def load_append_late(spark, folder):
    """The second delivery adds rows on the largest date of the first and rows without a date."""
    orders = table(spark, folder, "orders")
    last = F.lit("1998-03-02").cast("timestamp_ntz")
    dated = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")))
    early = (F.col("o_orderdate") < last) | ((F.col("o_orderdate") == last) & (F.col("o_orderkey") % 2 == 0))
    early |= F.col("o_orderdate").isNull() & (F.col("o_orderkey") % 100 == 0)
    name, path = scratch_table(spark, "orders_late")
    loads.load_append(dated.where(early), name, "o_orderdate", "2024-01-01", path)
    for _ in range(2):
        loads.load_append(dated, name, "o_orderdate", "2024-01-02", path)
    return written(spark, name, path)


def load_append_copies(spark, folder):
    """Rows of the largest date come late and in equal copies: a delivery holds as many as its number says."""
    orders = table(spark, folder, "orders")
    last = F.lit("2001-08-01").cast("timestamp_ntz")
    edge = orders.where(F.col("o_orderdate") == last).unionAll(orders.where("o_orderkey % 25 = 0").withColumn("o_orderdate", F.lit(None).cast("timestamp_ntz")))

    def delivered(copies):
        return orders.where(F.col("o_orderdate") < last).unionAll(edge.withColumn("i", F.explode(F.sequence(F.lit(1), copies))).drop("i"))

    name, path = scratch_table(spark, "orders_copies")
    loads.load_append(delivered(1 + F.col("o_custkey") % 2), name, "o_orderdate", "2024-01-01", path)
    for _ in range(2):
        loads.load_append(delivered(2 + F.col("o_custkey") % 3), name, "o_orderdate", "2024-01-02", path)
    return written(spark, name, path)


def load_month_reshaped(spark, folder):
    """Between two loads the source gains a column, loses one and widens another; the table follows."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_reshaped")
    loads.load_month(orders.withColumn("o_custkey", F.col("o_custkey").cast("int")), name, "o_orderdate", path=path)
    grown = orders.withColumn("o_channel", F.concat(F.lit("ch"), (F.col("o_orderkey") % 3).cast("string"))).drop("o_orderpriority")
    for month in ("1996-02-10", "1997-12-31"):
        loads.load_month(grown, name, "o_orderdate", month, path)
    return written(spark, name, path)


def publish_interrupted(spark, folder):
    """Every month is published by itself; one again, first by a job that dies midway, then by one that ends."""
    orders = table(spark, folder, "orders").withColumn("ym", F.date_format("o_orderdate", "yyyyMM"))
    name, path = scratch_table(spark, "orders_published")
    create_like(spark, name, orders, ["ym"], path)
    overwrite_partitions(orders, name)
    for month, sign in (("199702", 1), ("199703", -1)):
        rows = orders.where(F.col("ym") == month).withColumn("o_totalprice", -F.col("o_totalprice"))
        dying = F.when(F.col("o_orderkey") % 7 == 0, F.raise_error(F.lit("dies midway")).cast("double")).otherwise(F.col("o_totalprice"))
        try:
            publish_partition(rows.withColumn("o_totalprice", dying), name, "ym", month)
        except Exception as error:  # noqa: BLE001
            if "dies midway" not in str(error):
                raise
        if sign < 0:
            publish_partition(rows, name, "ym", month)
    publish_partition(orders.limit(0), name, "ym", "199704")
    held = materialize(spark.table(name), "published")
    spark.sql(f"DROP TABLE {name}")
    return held


def load_append_emptied(spark, folder):
    """A load is run again without rows and so takes its rows back."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_emptied")
    early = orders.where(F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz"))
    loads.load_append(early, name, "o_orderdate", "2024-01-01", path)
    loads.load_append(orders, name, "o_orderdate", "2024-01-02", path)
    loads.load_append(early, name, "o_orderdate", "2024-01-02", path)
    return written(spark, name, path)


def load_month_emptied(spark, folder):
    """A month that the source has lost is emptied."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_month_emptied")
    loads.load_month(orders, name, "o_orderdate", path=path)
    without = orders.where(F.date_format("o_orderdate", "yyyyMM") != "199712")
    loads.load_month(without, name, "o_orderdate", "1997-12-31", path)
    return written(spark, name, path)


def load_full_partitioned(spark, folder):
    """The target is partitioned; partitions the source no longer has go too."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_partitioned")
    create_like(spark, name, orders, ["o_orderpriority"], path)
    overwrite_partitions(orders, name)
    loads.load_full(orders.where(F.col("o_orderpriority") != "1-URGENT"), name, path)
    return written(spark, name, path)


def day_replaced_by_nothing(spark, folder):
    """A day of a folder with all days is replaced by no rows; returns the last days, as its SQL does."""
    orders = table(spark, folder, "orders").withColumn("dt", F.to_date("o_orderdate"))
    path = scratch_path(spark, "days")
    overwrite_paths(orders, path, ["dt"])
    replace_day(orders.limit(0), path, "1998-07-27")
    return spark.read.schema(orders.schema).parquet(path).where(F.col("dt") >= F.lit("1998-07-25").cast("date"))


def day_emptied_in_folder(spark, folder):
    """A day of a folder with all days is replaced by no rows; the whole folder comes back."""
    orders = table(spark, folder, "orders").withColumn("dt", F.to_date("o_orderdate"))
    path = scratch_path(spark, "days")
    overwrite_paths(orders, path, ["dt"])
    replace_day(orders.limit(0), path, "1998-07-27")
    return spark.read.schema(orders.schema).parquet(path)


def job_table_loads(spark, folder):
    """Loads as a job table lists them, each by its pattern; returns what the targets hold."""
    run = uuid.uuid4().hex[:12]
    jobs = small(
        spark,
        [
            ("default", f"crm{run}", "supplier", "full", None),
            ("default", f"crm{run}", "orders", "append", "o_orderdate"),
            ("default", f"erp{run}", "orders", "yyyymm", "o_orderdate"),
        ],
        ["hive_db", "sql_db", "table", "pattern_type", "key_to_new_data"],
    )
    held = []
    for spec in LoadSpec.from_table(jobs):
        path = scratch_path(spark, spec.table)
        loads.load(table(spark, folder, spec.table), spec, "1997-12-31", path)
        rows = written(spark, spec.target, path).agg(F.count(F.lit(1)).alias("row_count"))
        held.append(rows.select(F.lit(spec.table).alias("source"), F.lit(spec.pattern_type).alias("pattern"), "row_count"))
    return held[0].unionAll(held[1]).unionAll(held[2])


def load_month(spark, folder):
    """All months are loaded with negated prices; one month is then loaded right."""
    orders = table(spark, folder, "orders")
    name, path = scratch_table(spark, "orders_month")
    loads.load_month(orders.withColumn("o_totalprice", -F.col("o_totalprice")), name, "o_orderdate", path=path)
    loads.load_month(orders, name, "o_orderdate", "1997-12-31", path)
    return written(spark, name, path)


def mapping_refresh(spark, folder):
    """Refreshed twice; the second run reads the table it replaces."""
    name, path = scratch_table(spark, "supplier_map")
    loads.refresh_mapping(table(spark, folder, "supplier").withColumn("s_name", F.lower("s_name")), name, path)
    loads.refresh_mapping(spark.table(name).withColumn("s_name", F.upper("s_name")), name, path)
    return written(spark, name, path)


_VENDOR = StructType(
    [
        StructField("user_id", LongType()),
        StructField("segment", StringType()),
        StructField("score", DoubleType()),
    ]
)


def vendor_file_load(spark, folder):
    customer = table(spark, folder, "customer")
    drop = scratch_path(spark, "vendor")
    sent = customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("score")
    )
    files.export_csv(sent, drop)
    name, path = scratch_table(spark, "vendor")
    for _ in range(2):
        loads.load_vendor_file(spark, drop, _VENDOR, name, "2024-01-05", path=path)
    return written(spark, name, path)


def vendor_quarantine(spark, folder):
    """Two deliveries with their columns in another order, some lines broken; good and bad rows are kept apart."""
    customer = table(spark, folder, "customer")
    drop = scratch_path(spark, "deliveries")
    score = F.when(F.col("c_custkey") % 40 == 7, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    segment = F.when(F.col("c_custkey") % 60 == 11, F.lit("a,b")).otherwise(F.col("c_mktsegment"))
    sent = customer.select(F.col("c_custkey").alias("user_id"), segment.alias("segment"), score.alias("score"))
    for i, order in enumerate((["user_id", "segment", "score"], ["score", "user_id", "segment"])):
        part = sent.where(F.col("user_id") % 2 == i).select(order)
        part.write.options(header=True, quote="'").csv(f"{drop}/from{i}")
    names = [f"vendor_{kind}_{uuid.uuid4().hex[:12]}" for kind in ("good", "bad")]
    root = scratch_path(spark, "vendors")
    for _ in range(2):
        loads.load_deliveries(spark, f"{drop}/*", _VENDOR, *names, "2024-01-05", path=root)
    source = F.element_at(F.split("source_file", "/"), -2).alias("source")
    good = spark.table(names[0]).select("user_id", "segment", "score", F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"), source, "dt")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _VENDOR.fields]
    held = materialize(good.unionAll(spark.table(names[1]).select(*none, "line", "reason", source, "dt")), "vendors")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return held


def equal_depth_reads(spark, folder):
    """Orders read by the conditions that quantiles of a skewed key give: parts, rows, and whether they are even."""
    orders = table(spark, folder, "orders")
    held = []
    for key in (F.pow(F.col("o_orderkey") % 5000, F.lit(3)).cast("bigint"), F.nullif(F.to_date("o_orderdate"), F.lit("1995-01-02").cast("date"))):
        rows = orders.withColumn("k", key)
        cuts = equal_depth_predicates(rows, "k", 16)
        counts = rows.agg(*[F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(cuts)])
        every = F.array(*counts.columns)
        total = F.aggregate(every, F.lit(0).cast("bigint"), lambda n, c: n + c)
        held.append(counts.select(F.lit(str(rows.schema["k"].dataType.typeName())).alias("kind"), F.size(every).alias("parts"), total.alias("row_count"), (F.array_max(every) * 16 <= 2 * total).alias("even")))
    return held[0].unionAll(held[1])


def slice_export_tsv(spark, folder):
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "tsv")
    files.export_tsv(orders, path, "1998-03-02", "o_orderdate")
    return read_tsv(spark, path, orders.schema)


def text_export_tsv(spark, folder):
    """Texts with line breaks, one line a row."""
    documents = table(spark, folder, "documents")
    path = scratch_path(spark, "text-tsv")
    files.export_tsv(documents, path)
    return read_tsv(spark, path, documents.schema)


def text_export_csv(spark, folder):
    """Texts with line breaks, quoted."""
    documents = table(spark, folder, "documents")
    path = scratch_path(spark, "text-csv")
    files.export_csv(documents, path)
    return spark.read.schema(documents.schema).options(header=True, multiLine=True).csv(path)


def slice_export_csv(spark, folder):
    """Every event, quoted JSON and microseconds included."""
    events = table(spark, folder, "events")
    path = scratch_path(spark, "csv")
    files.export_csv(events, path)
    return spark.read.schema(events.schema).option("header", True).csv(path)


QUERIES = {
    f.__name__: f
    for f in (
        load_full,
        load_full_partitioned,
        load_append,
        load_append_late,
        load_append_copies,
        load_append_emptied,
        load_month,
        load_month_emptied,
        load_month_reshaped,
        publish_interrupted,
        job_table_loads,
        day_replaced_by_nothing,
        day_emptied_in_folder,
        mapping_refresh,
        vendor_file_load,
        vendor_quarantine,
        equal_depth_reads,
        slice_export_tsv,
        slice_export_csv,
        text_export_tsv,
        text_export_csv,
    )
}

SQL = {
    "load_full": "SELECT * FROM orders",
    "load_append": """SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1998-06-01' THEN DATE '2024-01-01'
  ELSE DATE '2024-01-02' END AS load_dt FROM orders""",
    "load_full_partitioned": "SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'",
    "load_append_late": """SELECT * EXCLUDE (d) REPLACE (d AS o_orderdate), CASE WHEN d < TIMESTAMP '1998-03-02'
    OR (d = TIMESTAMP '1998-03-02' AND o_orderkey % 2 = 0) OR (d IS NULL AND o_orderkey % 100 = 0)
  THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS load_dt
FROM (SELECT *, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS d FROM orders)""",
    "load_append_copies": """WITH e AS (SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '2001-08-01'
  UNION ALL SELECT * REPLACE (NULL::TIMESTAMP AS o_orderdate) FROM orders WHERE o_orderkey % 25 = 0)
SELECT *, DATE '2024-01-01' AS load_dt FROM orders WHERE o_orderdate < TIMESTAMP '2001-08-01'
UNION ALL SELECT e.*, DATE '2024-01-01' FROM e, range(2) t(i) WHERE i <= o_custkey % 2
UNION ALL SELECT e.*, DATE '2024-01-02' FROM e, range(4) t(i) WHERE i > o_custkey % 2 AND i <= 1 + o_custkey % 3""",
    "load_month_reshaped": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN m NOT IN ('199602', '199712') THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN m IN ('199602', '199712') THEN 'ch' || (o_orderkey % 3) END AS o_channel, m AS yyyymm
FROM (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders)""",
    "publish_interrupted": """SELECT * REPLACE (CASE WHEN ym = '199703' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice)
FROM (SELECT *, strftime(o_orderdate, '%Y%m') AS ym FROM orders) WHERE ym <> '199704'""",
    "day_emptied_in_folder": """SELECT *, CAST(o_orderdate AS DATE) AS dt FROM orders
  WHERE CAST(o_orderdate AS DATE) <> DATE '1998-07-27'""",
    "load_append_emptied": """SELECT *, DATE '2024-01-01' AS load_dt FROM orders
  WHERE o_orderdate < TIMESTAMP '1995-01-01'""",
    "load_month_emptied": """SELECT *, strftime(o_orderdate, '%Y%m') AS yyyymm FROM orders
  WHERE strftime(o_orderdate, '%Y%m') <> '199712'""",
    "day_replaced_by_nothing": """SELECT *, CAST(o_orderdate AS DATE) AS dt FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-07-25' AND CAST(o_orderdate AS DATE) <> DATE '1998-07-27'""",
    "job_table_loads": """SELECT 'supplier' AS source, 'full' AS pattern, count(*) AS row_count FROM supplier
UNION ALL SELECT 'orders', 'append', count(*) FROM orders
UNION ALL SELECT 'orders', 'yyyymm', count(*) FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199712'""",
    "load_month": """SELECT * REPLACE (CASE WHEN strftime(o_orderdate, '%Y%m') = '199712' THEN o_totalprice
  ELSE -o_totalprice END AS o_totalprice), strftime(o_orderdate, '%Y%m') AS yyyymm FROM orders""",
    "mapping_refresh": "SELECT * REPLACE (upper(s_name) AS s_name) FROM supplier",
    "vendor_file_load": """SELECT c_custkey AS user_id, c_mktsegment AS segment, c_acctbal AS score,
  DATE '2024-01-05' AS dt FROM customer""",
    "vendor_quarantine": """WITH c AS (SELECT c_custkey AS user_id, c_custkey % 2 AS i,
    CASE WHEN c_custkey % 60 = 11 THEN '''a,b''' ELSE c_mktsegment END AS segment, c_acctbal AS score,
    CASE WHEN c_custkey % 40 = 7 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS told,
    c_custkey % 40 = 7 OR c_custkey % 60 = 11 AS bad FROM customer)
SELECT CASE WHEN NOT bad THEN user_id END AS user_id, CASE WHEN NOT bad THEN segment END AS segment, CASE WHEN NOT bad THEN score END AS score,
  CASE WHEN bad THEN CASE WHEN i = 0 THEN user_id || ',' || segment || ',' || told ELSE told || ',' || user_id || ',' || segment END END AS line,
  CASE WHEN bad THEN 'unreadable' END AS reason, 'from' || i AS source, DATE '2024-01-05' AS dt FROM c""",
    "equal_depth_reads": """SELECT 'long' AS kind, 16 AS parts, count(*) AS row_count, true AS even FROM orders
UNION ALL SELECT 'date', 16, count(*), true FROM orders""",
    "slice_export_tsv": "SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '1998-03-02'",
    "slice_export_csv": "SELECT * FROM events",
    "text_export_tsv": "SELECT * FROM documents",
    "text_export_csv": "SELECT * FROM documents",
}
