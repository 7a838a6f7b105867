"""Publishing to relational tables over JDBC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tagmill.functions.dates import table_suffix
from tagmill.sinks.partitions import counted
from tagmill.sources.jdbc import Connection
from tagmill.sources.tables import checked_name

BATCH_ROWS = 10_000
# Connections one write may open at a time.
CONNECTIONS = 16


def snapshot_name(table: str, day: str) -> str:
    """``table_yyyy_MM_dd``."""
    return f"{table}_{table_suffix(day)}"


def write_options(connection: Connection, table: str, truncate: bool = False) -> dict[str, str]:
    options = {
        **connection.options(),
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(CONNECTIONS),
    }
    return {**options, "truncate": "true"} if truncate else options


def overwrite_jdbc(df: DataFrame, connection: Connection, table: str, truncate: bool = False) -> None:
    """Replace a relational table; ``truncate`` keeps its definition and grants."""
    df.write.format("jdbc").options(**write_options(connection, table, truncate)).mode("overwrite").save()


def _dealt(df: DataFrame) -> DataFrame:
    """One partition per connection by a shuffle, so the stage that computes the rows keeps its tasks."""
    return df.repartition(CONNECTIONS)


def write_snapshot(df: DataFrame, connection: Connection | str, table: str, day: str) -> str:
    """Replace the table of one date; returns its name.

    A text in place of a connection is a folder on shared storage; the table is then
    the Parquet folder of its name below it.
    """
    name = snapshot_name(table, day)
    if isinstance(connection, str):
        df.write.mode("overwrite").parquet(f"{connection.rstrip('/')}/{name}")
        return name
    overwrite_jdbc(_dealt(df), connection, name)
    return name


def day_statements(staging: str, table: str, columns: list[str], day: str, dt: str = "dt") -> list[str]:
    """Statements that put one staged day in place of the published one."""
    listed = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    where = f"\"{checked_name(dt)}\" = '{date.fromisoformat(day).isoformat()}'"
    return [
        f"DELETE FROM {checked_name(table)} WHERE {where}",
        f"INSERT INTO {checked_name(table)} ({listed}) SELECT {listed} FROM {checked_name(staging)}",
    ]


def run_statements(spark: SparkSession, connection: Connection, statements: list[str]) -> None:
    """Run statements in one transaction on the relational server."""
    jvm = spark.sparkContext._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(connection.driver)
    link = jvm.java.sql.DriverManager.getConnection(connection.url, connection.user, connection.password)
    try:
        link.setAutoCommit(False)
        for text in statements:
            statement = link.createStatement()
            statement.execute(text)
            statement.close()
        link.commit()
    finally:
        link.close()


def publish_day(
    df: DataFrame, connection: Connection, staging: str, table: str, day: str, dt: str = "dt"
) -> None:
    """Replace one day of a relational table, which is created if it is missing.

    Rows go to a staging table first.  A task that ran twice could have stored
    its rows twice there, so the staged count is compared with the rows sent
    before one transaction deletes the old day and copies the new one.
    """
    out, seen = counted(_dealt(df))
    overwrite_jdbc(out, connection, staging, truncate=True)
    staged = (
        df.sparkSession.read.format("jdbc")
        .options(**connection.options())
        .option("dbtable", f"(SELECT count(*) AS n FROM {checked_name(staging)}) c")
        .load()
        .first()[0]
    )
    if int(staged) != seen.get["rows"]:
        raise RuntimeError(f"{staging} holds {staged} rows, {seen.get['rows']} were sent; run again")
    df.limit(0).write.format("jdbc").options(**write_options(connection, table)).mode("append").save()
    run_statements(df.sparkSession, connection, day_statements(staging, table, df.columns, day, dt))
