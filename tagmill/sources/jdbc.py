"""Relational sources over JDBC.  Connection options come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.sources.tables import checked_name

# Driver of the relational server results are published to (fixed value).
SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"


@dataclass(frozen=True)
class Connection:
    """A JDBC endpoint; the password never shows in ``repr``."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = SQLSERVER_DRIVER

    @classmethod
    def sqlserver(cls, server: str, database: str, user: str, password: str) -> "Connection":
        return cls(f"jdbc:sqlserver://{server};databaseName={database}", user, password)

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {k: v for k, v in given.items() if v is not None}


def split_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Read in parallel by ranges of ``column``; rows outside the bounds are read too."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def equal_depth_predicates(stored: DataFrame, column: str, parts: int) -> list[str]:
    """Conditions that cut a table into about equally many rows each, by the quantiles of ``column``.

    ``stored`` is what is known of the table, such as its last mirror.  Every row meets exactly one
    condition, rows above or below all stored ones and rows without the column included.  A
    value cannot be split: one that holds more than its share makes a part of its own.
    """
    name = checked_name(column)
    kind = stored.schema[column].dataType.typeName()
    if kind in ("float", "double"):
        raise ValueError(f"{column}: split by a whole number, date, time or decimal")
    if parts < 2:
        return ["1 = 1"]
    shares = [i / parts for i in range(1, parts)]
    found = stored.select(F.percentile_approx(name, shares, 100 * parts).alias("cuts"))
    texts = found.select(F.transform("cuts", lambda c: c.cast("string")).alias("cuts")).first().cuts
    quote = "'" if kind in ("date", "timestamp", "timestamp_ntz") else ""
    cuts = [quote + c + quote for c in texts or []]
    if not cuts:
        return ["1 = 1"]
    out, above = [], ""
    for cut in dict.fromkeys(cuts):
        out.append(f"{above}{name} < {cut}" if out else f"{name} < {cut} OR {name} IS NULL")
        heavy = cuts.count(cut) > 1
        if heavy:
            out.append(f"{name} = {cut}")
        above = f"{name} {'>' if heavy else '>='} {cut} AND "
    return [*out, above.removesuffix(" AND ")]


def read_jdbc(
    spark: SparkSession,
    connection: Connection,
    table: str,
    split_by: str | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    predicates: list[str] | None = None,
) -> DataFrame:
    """A table over JDBC; filters and columns reach the server.

    With ``predicates``, such as those of ``equal_depth_predicates``, one task reads the
    rows of each.
    With ``split_by`` the bounds are asked of the server and the table is read by
    ``partitions`` tasks.  Without it one task reads everything, which suits
    mapping tables only.
    """
    if predicates:
        properties = {k: v for k, v in connection.options().items() if k != "url"}
        return spark.read.jdbc(connection.url, table, predicates=predicates, properties={**properties, "fetchsize": str(fetch_size)})
    reader = (
        spark.read.format("jdbc")
        .options(**connection.options())
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    if split_by:
        by = checked_name(split_by)
        ask = f"(SELECT min({by}) AS lo, max({by}) AS hi FROM {checked_name(table)}) b"
        low, high = spark.read.format("jdbc").options(**connection.options()).option("dbtable", ask).load().first()
        if low is not None:
            reader = reader.options(**split_options(split_by, low, high, partitions))
    return reader.load()
