"""Order-message streams: ETL to typed rows, upsert into a lake table.

Both jobs are ordinary Structured Streaming plans: a message source, a
stateless projection (``order_etl`` / ``order_json_etl``), and a sink.  Late
and duplicate orders are handled by the table's key + precombine merge, not
by watermarks, so the streaming plan keeps no state of its own; progress
lives in the checkpoint folder and the upsert sink is idempotent per stream and
batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.etl import order_etl, order_json_etl
from rivulet.operators.lake import LakeTable
from rivulet.sources.messages import read_message_stream


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def order_stream(
    spark: SparkSession, source: str | None, max_files: int | None = None,
    kafka_options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages -> order rows with text fields, ``ts`` and ``day``."""
    return order_etl(read_message_stream(spark, source, max_files, kafka_options))


def typed_order_stream(
    spark: SparkSession, source: str | None, max_files: int | None = None,
    kafka_options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages -> typed order rows (declared JSON schema) with ``ts`` and
    ``partition_day``; unreadable messages are skipped."""
    return order_json_etl(read_message_stream(spark, source, max_files, kafka_options))


def start_upsert(
    rows: DataFrame,
    table: LakeTable,
    checkpoint: str,
    query_name: str = "order-upsert",
    trigger: str | None = None,
) -> StreamingQuery:
    """Append-mode stream whose every micro-batch is upserted into ``table``
    as one write, named by the checkpoint folder and the batch id (a replayed
    batch is rewritten, not duplicated; other streams' writes stay)."""
    writer = (
        rows.writeStream.outputMode("append")
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(table.batch_writer(checkpoint))
    )
    return _trigger(writer, trigger).start()


def start_json_print(
    spark: SparkSession,
    source: str,
    sink: str | None,
    checkpoint: str,
    max_files: int | None = None,
    trigger: str | None = None,
    query_name: str = "order-json",
    sink_format: str = "parquet",
) -> StreamingQuery:
    """Tolerant declared-schema decode of the order stream; every row goes to
    the sink: Parquet files under ``sink``, ``console`` (the driver's output),
    or ``memory`` (a temporary view named ``query_name``; for tests)."""
    if sink_format not in ("parquet", "console", "memory"):
        raise ValueError("sink_format must be 'parquet', 'console' or 'memory'")
    rows = typed_order_stream(spark, source, max_files)
    writer = (
        rows.writeStream.outputMode("append")
        .queryName(query_name)
        .format(sink_format)
        .option("checkpointLocation", checkpoint)
    )
    if sink_format == "parquet":
        writer = writer.option("path", sink)
    return _trigger(writer, trigger).start()


def start_copy(
    rows: DataFrame, sink: str, checkpoint: str, query_name: str, trigger: str = "0 seconds"
) -> StreamingQuery:
    """Every row of a stream to Parquet folders by micro-batch (``batch``); a repeated
    micro-batch replaces its folder."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    writer = rows.writeStream.outputMode("append").queryName(query_name)
    return _trigger(writer.option("checkpointLocation", checkpoint).foreachBatch(put), trigger).start()


def drain(query: StreamingQuery) -> None:
    """Let a continuous query work through all that its source has now, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Block until every query has stopped; re-raise the first failure.
    A query still running after ``timeout_s`` seconds is stopped and a
    ``TimeoutError`` raised."""
    for q in queries:
        done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
        if timeout_s is not None and not done:
            q.stop()
            raise TimeoutError(f"streaming query {q.name or q.id} still running after {timeout_s} s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    spark.streams.resetTerminated()


def active_queries(spark: SparkSession) -> list[str]:
    """Names (or ids) of the streaming queries running in this session."""
    return [q.name or q.id for q in spark.streams.active]


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """Block until any streaming query of the session stops (or timeout)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return bool(spark.streams.awaitAnyTermination(timeout_s))
