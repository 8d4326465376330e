"""Row-level ETL: ride records and order messages -> table rows.

Pure projections (no shuffle, no UDF): they fuse into the scan's whole-stage
codegen span and run the same in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.timefmt import (
    ORDER_TIME_FORMAT,
    dash_path,
    epoch_seconds,
    parse_time,
    prefix,
)


def ride_etl(df: DataFrame) -> DataFrame:
    """Add ``partitionpath`` (``y-m-d``, no zero padding), drop the date parts,
    add ``ts`` = epoch seconds of ``departure_time`` (the precombine field)."""
    return (
        df.withColumn("partitionpath", dash_path("year", "month", "day"))
        .drop("year", "month", "day")
        .withColumn("ts", epoch_seconds("departure_time"))
    )


# JSON fields of an order message pulled out as text (Spark stream form).
_ORDER_TEXT_FIELDS = (
    ("user_id", "userId"),
    ("order_time", "orderTime"),
    ("ip", "ip"),
    ("order_money", "orderMoney"),
    ("order_status", "orderStatus"),
)


def order_etl(messages: DataFrame) -> DataFrame:
    """Message rows -> order rows, every JSON field kept as text.

    ``order_id`` is the message key.  ``ts`` is the parsed ``order_time``
    (precombine field), ``day`` its first ten characters (partition).
    """
    carried = [F.col(c) for c in ("topic", "partition", "offset", "timestamp")]
    as_text = {"order_id": "key", "message": "value"}
    base = messages.select(*(F.col(c).cast("string").alias(name) for name, c in as_text.items()), *carried)
    # one JSON parse per message for all five fields (json_tuple), instead of
    # one parse per field; values come back as text, as get_json_object gives
    names = [name for name, _ in _ORDER_TEXT_FIELDS]
    fields = [field for _, field in _ORDER_TEXT_FIELDS]
    base = base.select(
        *[c for c in base.columns if c != "message"],
        F.json_tuple("message", *fields).alias(*names),
    )
    return base.withColumns(
        {
            "ts": parse_time("order_time", ORDER_TIME_FORMAT),
            "day": prefix("order_time", 10),
        }
    )


ORDER_JSON_SCHEMA = T.StructType(
    [
        T.StructField("orderId", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("orderTime", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("orderMoney", T.DoubleType()),
        T.StructField("orderStatus", T.IntegerType()),
    ]
)


def parse_json_tolerant(
    messages: DataFrame, schema: T.StructType = ORDER_JSON_SCHEMA, value_col: str = "value"
) -> DataFrame:
    """Declared-schema JSON decode that skips unparsable text and keeps
    missing or wrong-typed fields as NULL (rows survive)."""
    text = F.col(value_col).cast("string")
    parsed = messages.select(text.alias("_text")).where(
        F.get_json_object("_text", "$").isNotNull()
    )
    return parsed.select(F.from_json("_text", schema).alias("_r")).select("_r.*")


def order_json_etl(messages: DataFrame) -> DataFrame:
    """Declared-schema order stream: typed fields plus ``partition_day``
    (first 10 characters of ``orderTime``) and ``ts`` (first 17 characters of
    ``orderId``, the time part of the id)."""
    return parse_json_tolerant(messages).withColumns(
        {"partition_day": prefix("orderTime", 10), "ts": prefix("orderId", 17)}
    )
