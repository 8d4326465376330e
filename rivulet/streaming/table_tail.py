"""Streaming reads of a lake table: its changes, or its raw change log.

``start_changes`` streams the table's changes: the rows of completed writes, each
write once.  What it streams is the list of completed writes (a line a write), so
its state is one id a write, not a row of the table; a write that failed or is
under way is never seen, and one that is repeated is seen once.  Each micro-batch
reads the folders of its writes as a batch and puts them into folders of the same
names, so a repeated micro-batch replaces itself.

``start_tail`` copies the raw log.  The log is a folder of Parquet files partitioned by generation, commit and
write; the file stream source lists new files per trigger (every 4 seconds by
default, ``availableNow`` in tests).  A tail follows the table over overwrites:
the rows of a new generation arrive like any others (those of an overwrite that
fails later, too).  A replayed write is a new file to this reader, so consumers
that need state must reduce to the latest row per identity rather than count
raw rows; nor does it leave out writes that fail later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.lake import COMMIT, GENERATION, PART, WRITE, LakeTable

# How long a completed write is remembered for telling its repeats (by the time of the
# newest), and writes of one micro-batch.
REMEMBERED = "7 days"
WRITES_PER_TRIGGER = 1000


def completed_writes(table: LakeTable, remembered: str = REMEMBERED, per_trigger: int = WRITES_PER_TRIGGER) -> DataFrame:
    """``(write_id, generation, completed_at)``: a stream of the table's completed writes."""
    if table.data_schema is None:
        raise FileNotFoundError(f"no table at {table.path}")
    lines = (
        table.spark.readStream.schema("write_id string, generation int, completed_at timestamp")
        .option("maxFilesPerTrigger", per_trigger)
        .json(f"{table.path}/completed")
    )
    return lines.withWatermark("completed_at", remembered).dropDuplicatesWithinWatermark(["generation", "write_id"])


def changes_of(table: LakeTable, writes: list[tuple[int, str]]) -> DataFrame:
    """The log rows of these (generation, write id); only their folders are read."""
    rows = table.spark.read.schema(table._read_schema(PART, GENERATION, COMMIT, WRITE))
    rows = rows.option("basePath", f"{table.path}/log").parquet(f"{table.path}/log")
    wanted = F.col(GENERATION).isin(sorted({str(g) for g, _ in writes})) & F.col(WRITE).isin(sorted({w for _, w in writes}))
    return rows.where(wanted).drop(GENERATION)


def start_changes(
    table: LakeTable,
    sink: str,
    checkpoint: str,
    trigger: str | None = "4 seconds",
    remembered: str = REMEMBERED,
    per_trigger: int = WRITES_PER_TRIGGER,
    query_name: str = "table-changes",
) -> StreamingQuery:
    """Copy the rows of every completed write, once, to Parquet folders by write id below
    ``sink``.  A tail follows the table over overwrites that succeed."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        writes = [(r["generation"], r["write_id"]) for r in batch.select("generation", "write_id").collect()]
        if writes:  # at most per_trigger ids
            rows = changes_of(table, writes)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WRITE).parquet(sink)

    writer = (
        completed_writes(table, remembered, per_trigger)
        .writeStream.outputMode("append")
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(emit)
    )
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def tail_log(table: LakeTable, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = table.spark.readStream.schema(table._read_schema(PART, GENERATION, COMMIT, WRITE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{table.path}/log").drop(GENERATION, WRITE)


def start_tail(
    table: LakeTable,
    sink: str,
    checkpoint: str,
    trigger: str | None = "4 seconds",
    max_files_per_trigger: int | None = None,
    query_name: str = "table-tail",
) -> StreamingQuery:
    """Copy every new log row to a Parquet sink (append mode)."""
    writer = (
        tail_log(table, max_files_per_trigger)
        .writeStream.outputMode("append")
        .queryName(query_name)
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    if trigger is None or trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
