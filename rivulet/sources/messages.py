"""Keyed JSON messages: encoding, message-shaped files, and the stream source.

A message row has the broker's shape (``key``, ``value`` as bytes, ``topic``,
``partition``, ``offset``, ``timestamp``).  When a broker is deployed the
stream reads ``format('kafka')``; without one, the same rows are kept as
Parquet files and read by the file stream source, where ``maxBytesPerTrigger``
plays the part of ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Input of one micro-batch; what is left waits for the next.
MAX_BYTES_PER_TRIGGER = 4 << 30

# Field names of the order JSON, in the producer's order.
ORDER_JSON_FIELDS = ("orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus")


def encode_orders(
    orders: DataFrame,
    topic: str = "order-topic",
    partitions: int = 3,
    broken_every: int | None = None,
) -> DataFrame:
    """Order records -> message rows: key = order id, value = JSON of the record.

    ``broken_every=n`` replaces the value of every message whose ``event_id``
    is a multiple of ``n`` by truncated (malformed) JSON, to exercise tolerant
    parsing downstream.  All rows are kept.
    """
    payload = F.to_json(
        F.struct(
            F.col("order_id").alias("orderId"),
            F.col("user_id").alias("userId"),
            F.col("order_time").alias("orderTime"),
            F.col("ip").alias("ip"),
            F.col("order_money").alias("orderMoney"),
            F.col("order_status").alias("orderStatus"),
        )
    )
    if broken_every:
        payload = F.when(
            F.col("event_id") % broken_every == 0,
            F.concat(F.lit("{\"orderId\": \"broken"), F.substring(payload, 2, 20)),
        ).otherwise(payload)
    return orders.select(
        F.col("order_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("timestamp"),  # all that a broker keeps
        F.lit(0).alias("timestampType"),
    )


def write_message_files(messages: DataFrame, path: str, files: int | None = None) -> str:
    """Keep messages as Parquet files.  ``files=n`` splits them into ``n``
    offset ranges (a file stream then replays them as ordered micro-batches);
    ``files=None`` keeps the input's parallelism (one file per task)."""
    out = messages.repartitionByRange(files, "offset") if files else messages
    out.write.mode("overwrite").parquet(path)
    return path


def write_messages(
    messages: DataFrame,
    path: str | None = None,
    kafka_options: dict[str, str] | None = None,
    files: int | None = None,
) -> None:
    """Message sink: ``format('kafka')`` with ``kafka_options``
    (``kafka.bootstrap.servers``, ``topic``) when a broker is deployed,
    otherwise message-shaped Parquet files under ``path``."""
    if kafka_options is not None:
        messages.select("key", "value").write.format("kafka").options(**kafka_options).save()
        return
    if path is None:
        raise ValueError("path or kafka_options is required")
    write_message_files(messages, path, files)


def read_message_stream(
    spark: SparkSession,
    path: str | None = None,
    max_files: int | None = None,
    kafka_options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming message source.

    With ``kafka_options`` (``kafka.bootstrap.servers``, ``subscribe``, ...)
    this is the broker source with ``startingOffsets=latest``,
    ``maxOffsetsPerTrigger=100000`` and ``failOnDataLoss=false`` unless
    overridden.  Otherwise message-shaped Parquet files under ``path``, up to
    ``MAX_BYTES_PER_TRIGGER`` a micro-batch, or ``max_files`` files where given.
    """
    if kafka_options is not None:
        opts = {
            "startingOffsets": "latest",
            "maxOffsetsPerTrigger": "100000",
            "failOnDataLoss": "false",
        }
        opts.update(kafka_options)
        return spark.readStream.format("kafka").options(**opts).load()
    if path is None:
        raise ValueError("path or kafka_options is required")
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", MAX_BYTES_PER_TRIGGER)
    return reader.parquet(path)
