"""Stand-ins for the reference's inputs, derived from the given tables.

The reference ships no data, so its three inputs are re-derived by formula:

* ``rides``      ride-order records (one per ``lineitem`` row)
* ``trip_log``   a keyed change log of trips, one commit per day (``events``)
* ``order_msgs`` order records that become keyed JSON messages (``events``)

The formulas are fixed: the SQL oracle in ``__spark_entry__`` derives the same
rows with the same arithmetic.  Every column is computed JVM-side; the scans
read only the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.ipv4 import IP_RANGES, int_to_ipv4
from rivulet.sources.delimited import RIDE_FILE_SCHEMA
from rivulet.sources.tables import load


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride records as stored in the delimited file (year/month/day as ints)."""
    li = load(spark, sf_dir, "lineitem")
    by = {
        "order_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "product_id": F.col("l_linenumber"),
        "city_id": F.col("l_suppkey") % 300,
        "district": F.col("l_partkey") % 50,
        "county": F.col("l_partkey") % 7,
        "type": F.when(F.col("l_linestatus") == "F", 0).when(F.col("l_linestatus") == "O", 1),
        "combo_type": F.col("l_orderkey") % 3,
        "traffic_type": F.when(F.col("l_partkey") % 100 == 0, F.lit(302)).otherwise(F.col("l_partkey") % 9),
        "passenger_count": F.col("l_orderkey") % 5,
        "driver_product_id": F.col("l_suppkey") % 4,
        "start_dest_distance": F.floor("l_extendedprice"),
        "arrive_time": F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 5 MINUTES"), "yyyy-MM-dd HH:mm:ss"),
        "departure_time": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        "pre_total_fee": F.col("l_extendedprice") / F.lit(500.0),
        "normal_time": F.col("l_orderkey") % 60,
        "bubble_trace_id": F.concat(F.lit("trace-"), F.col("l_orderkey").cast("string")),
        "product_1level": F.col("l_suppkey") % 2,
        "dest_lng": (F.col("l_partkey") % 180) / F.lit(2.0),
        "dest_lat": (F.col("l_partkey") % 90) / F.lit(2.0),
        "starting_lng": (F.col("l_suppkey") % 180) / F.lit(4.0),
        "starting_lat": (F.col("l_suppkey") % 90) / F.lit(4.0),
        "year": F.year("l_shipdate"),
        "month": F.month("l_shipdate"),
        "day": F.dayofmonth("l_shipdate"),
    }
    return li.select(*(by[f.name].cast(f.dataType).alias(f.name) for f in RIDE_FILE_SCHEMA.fields))


def trip_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip change log: key ``uuid``, partition ``partitionpath``, precombine ``ts``.

    ``commit_time`` is the day of ``ts`` as a 14-digit instant; rows with
    ``is_delete`` are deletes of their key.
    """
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("uuid"),
        (F.col("user_id") % 4).cast("string").alias("partitionpath"),
        "event_id",
        "ts",
        F.col("value").alias("fare"),
        F.concat(F.lit("driver-"), (F.col("event_id") % 7).cast("string")).alias("driver"),
        F.concat(F.lit("rider-"), F.col("user_id").cast("string")).alias("rider"),
        ((F.col("event_id") % 90).cast("double") / F.lit(90.0)).alias("begin_lat"),
        ((F.col("event_id") % 180).cast("double") / F.lit(180.0)).alias("begin_lon"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("000000")).alias("commit_time"),
        (F.col("event_type") == "error").alias("is_delete"),
    )


def order_ip(event_id) -> F.Column:
    """A deterministic address inside one of the ten order ranges, each in turn."""
    e = F.col(event_id) if isinstance(event_id, str) else event_id
    inside = [F.lit(lo) + (e * 7919) % (hi - lo + 1) for lo, hi in IP_RANGES]
    return F.element_at(F.array(*inside), (e % 10 + 1).cast("int"))


def order_msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records (one per event) in the shape the order producer emits."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.concat(
            F.date_format("ts", "yyyyMMddHHmmssSSS"),
            F.lpad((F.col("event_id") % 1000000).cast("string"), 6, "0"),
        ).alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("order_time"),
        int_to_ipv4(order_ip("event_id")).alias("ip"),
        F.col("value").alias("order_money"),
        F.when(F.col("event_type") == "click", 0)
        .when(F.col("event_type") == "error", 1)
        .when(F.col("event_type") == "view", 2)
        .otherwise(3)
        .alias("order_status"),
        "event_id",
        "ts",
    )
