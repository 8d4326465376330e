"""Catalog operators: database, external partitioned table, partitions.

All statements are Spark SQL DDL against the session catalog.  Partition
registration is one statement for any number of partitions, and partition
discovery is a directory listing -- no data is read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rivulet.session import list_dirs


def _quote(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; ``location`` keeps managed files in a
    shared folder rather than the driver's working directory."""
    where = f" LOCATION {_quote(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{where}")


def use_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"USE `{db}`")


def create_external_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_col: str,
    location: str,
    fmt: str = "parquet",
) -> None:
    """``CREATE TABLE IF NOT EXISTS t (...) USING fmt PARTITIONED BY (p) LOCATION``.

    The partition column is added as text when ``schema`` does not carry it
    (files in partition folders do not hold the partition value)."""
    fields = list(schema.fields)
    if partition_col not in schema.fieldNames():
        fields.append(T.StructField(partition_col, T.StringType()))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING {fmt} "
        f"PARTITIONED BY (`{partition_col}`) LOCATION {_quote(location)}"
    )


# Partitions registered per ``ALTER TABLE ... ADD`` statement.
ADD_PARTITIONS_CHUNK = 1000


def add_partitions(spark: SparkSession, table: str, partition_col: str, locations: Mapping[str, str]) -> int:
    """Register partitions with explicit locations (any directory layout),
    idempotently (``ADD IF NOT EXISTS``), many partitions per statement."""
    items = sorted(locations.items())
    for i in range(0, len(items), ADD_PARTITIONS_CHUNK):
        specs = " ".join(
            f"PARTITION (`{partition_col}` = {_quote(v)}) LOCATION {_quote(loc)}"
            for v, loc in items[i:i + ADD_PARTITIONS_CHUNK]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    return len(items)


def discover_partition_dirs(spark: SparkSession, location: str, partition_col: str | None = None) -> dict[str, str]:
    """Map partition value -> directory for the sub-folders of ``location``.

    Folders named ``col=value`` give ``value``; plain folders (``2017-5-22``)
    give their name.  Hidden folders (``_``/``.``) are skipped.
    """
    out = {}
    base = location.rstrip("/")
    for name in list_dirs(spark, base):
        if name.startswith(("_", ".")):
            continue
        value = name.split("=", 1)[1] if partition_col and name.startswith(f"{partition_col}=") else name
        out[value] = f"{base}/{name}"
    return out


def repair(spark: SparkSession, table: str) -> None:
    """Discover ``name=value`` partition folders (``MSCK REPAIR TABLE``)."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")
