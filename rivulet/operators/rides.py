"""Ride storage: delimited ride file -> ETL -> keyed table, and the report input.

The table is keyed by ``order_id`` within the day partition ``partitionpath``
and picks among repeated orders by ``ts`` (departure epoch seconds), then by
the other ride fields so that the choice is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.operators.etl import ride_etl
from rivulet.operators.lake import LakeTable
from rivulet.sources.delimited import read_delimited

RIDE_TIEBREAK = ("pre_total_fee", "start_dest_distance", "product_id", "type", "traffic_type", "departure_time")
REPORT_COLUMNS = ("product_id", "type", "traffic_type", "pre_total_fee", "start_dest_distance", "departure_time")


def ride_table(spark: SparkSession, path: str, kind: str = "cow") -> LakeTable:
    return LakeTable(spark, path, key="order_id", precombine="ts", partition="partitionpath",
                     kind=kind, tiebreak=RIDE_TIEBREAK)


def store_rides(spark: SparkSession, source: str, table_path: str, commit: str | None = None) -> LakeTable:
    """Read the tab-separated ride file, run the ETL and overwrite the table."""
    table = ride_table(spark, table_path)
    table.overwrite(ride_etl(read_delimited(spark, source)), commit=commit)
    return table


def report_input(table: LakeTable) -> DataFrame:
    """The six columns the ride reports read from the stored table."""
    return table.snapshot().select(*REPORT_COLUMNS)
