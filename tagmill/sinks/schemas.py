"""Bringing rows and a target table to one schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tagmill.functions.text import quoted

_WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
# Decimal digits a whole number of each kind may have.
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))


class SchemaMismatch(ValueError):
    """A column of the source cannot be stored in the target without loss."""


def holds_all(wide: DataType, narrow: DataType) -> bool:
    """Whether every value of ``narrow`` is one of ``wide``, and files of ``narrow`` can be read as ``wide``."""
    if wide == narrow:
        return True
    if narrow in _WHOLE:
        if wide in _WHOLE:
            return _WHOLE.index(wide) > _WHOLE.index(narrow)
        if isinstance(wide, DecimalType):
            return wide.precision - wide.scale >= _DIGITS[narrow]
        return isinstance(wide, DoubleType) and narrow != LongType()
    if isinstance(narrow, FloatType):
        return isinstance(wide, DoubleType)
    if isinstance(narrow, DecimalType) and isinstance(wide, DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return isinstance(narrow, DateType) and isinstance(wide, TimestampNTZType)


def merged_schema(target: StructType, source: StructType, partitions: list[str]) -> tuple[StructType, list[StructField], list[str]]:
    """What the target must become to hold the source too: its schema, its new columns and the names of widened ones.

    Names are compared without case.  New columns go behind the others, before the partition
    columns.  A type neither of which holds the other, a changed partition column
    and a partition column that the source lacks are errors.
    """
    given = {f.name.lower(): f for f in source.fields}
    known = {f.name.lower() for f in target.fields}
    fields, widened = [], []
    for field in target.fields:
        new = given.get(field.name.lower())
        part = field.name in partitions
        if new is None and part:
            raise SchemaMismatch(f"the source lacks the partition column {field.name}")
        if new is None or holds_all(field.dataType, new.dataType):
            fields.append(StructField(field.name, field.dataType))
        elif holds_all(new.dataType, field.dataType) and not part:
            fields.append(StructField(field.name, new.dataType))
            widened.append(field.name)
        else:
            kinds = f"{field.dataType.simpleString()} cannot hold {new.dataType.simpleString()}"
            raise SchemaMismatch(f"column {field.name}: {kinds}")
    added = [StructField(f.name, f.dataType) for f in source.fields if f.name.lower() not in known]
    end = [f for f in fields if f.name in partitions]
    return StructType([f for f in fields if f.name not in partitions] + added + end), added, widened


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name in ("Location", "Type")}


def _registered_anew(spark: SparkSession, table: str, schema: StructType, partitions: list[str]) -> None:
    """Give an external table's files a catalog entry with wider types; no file is touched."""
    known = _described(spark, table)
    if known.get("Type") != "EXTERNAL":
        raise SchemaMismatch(f"{table} is managed: its columns can be widened only if it has a location of its own")
    moved = []
    if partitions:
        for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
            spec = ", ".join(f"`{k}` = '{v}'" for k, v in (p.split("=", 1) for p in row[0].split("/")))
            facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where("col_name = 'Location'").first()
            moved.append((spec, facts.data_type))
    ddl = f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet"
    if partitions:
        ddl += " PARTITIONED BY (" + ", ".join(quoted(c) for c in partitions) + ")"
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"{ddl} LOCATION '{known['Location']}'")
    for spec, location in moved:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{location}'")


def reconciled(df: DataFrame, table: str, partitions: list[str]) -> DataFrame:
    """``df`` in the columns of ``table``, after the table has learnt what it lacks.

    Columns the source gained are added to the table, where older rows are NULL.  Columns it
    lost are NULL in the new rows.  A narrower type is cast; a wider one widens the table,
    whose older Parquet files are then read as the wider type.  Whatever could
    lose values is refused before anything is written.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    schema, added, widened = merged_schema(target, df.schema, partitions)
    if widened:
        _registered_anew(spark, table, schema, partitions)
    elif added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({StructType(added).toDDL()})")
    given = {c.lower(): c for c in df.columns}
    cells = []
    for field in spark.table(table).schema.fields:
        source = given.get(field.name.lower())
        value = F.col(quoted(source)) if source else F.lit(None)
        cells.append(value.cast(field.dataType).alias(field.name))
    return df.select(*cells)
