"""A merge-on-read table whose reads need no shuffle.

The change log is a catalog table bucketed by record key and sorted by it inside
each bucket: all rows of an identity stand in one bucket, so the reduction to the
latest row per identity runs where a bucket is read.  The write pays the one
shuffle that deals rows to buckets, after the reduction within each commit has
left one row per identity and commit; a key that fills the feed is a row per
commit there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.lake import COMMIT, KEY, PART, WRITE, LakeTable

BUCKETS = 16


class BucketedTable(LakeTable):
    """A merge-on-read ``LakeTable`` with its log in the catalog table ``name`` (files
    under ``path``), in ``buckets`` buckets by record key; choose them so that one
    fits a task.  Reads are as of ``LakeTable``; a commit filter skips row groups
    instead of folders.  Every write has an id of its own; writing one again is
    refused, since appended rows can't be replaced."""

    def __init__(
        self, spark: SparkSession, name: str, path: str, key: str, precombine: str, partition: str,
        merge: str = "commit", tiebreak: Sequence[str] = (), buckets: int = BUCKETS,
    ):
        super().__init__(spark, path, key, precombine, partition, "mor", merge, tiebreak)
        self.name, self.buckets = name, buckets

    def _append(self, rows: DataFrame, write_id: str, one_commit: bool) -> None:
        if self.spark.catalog.tableExists(self.name):
            if self.spark.table(self.name).where(F.col(WRITE) == write_id).limit(1).count():
                raise ValueError(f"write {write_id} is in the log already")
        (
            rows.withColumn(WRITE, F.lit(write_id))
            .repartition(self.buckets, KEY)
            .write.mode("append").format("parquet")
            .bucketBy(self.buckets, KEY).sortBy(KEY, PART, COMMIT)
            .option("path", f"{self.path}/buckets")
            .saveAsTable(self.name)
        )

    def _forget(self, write_id: str) -> None:
        self._done(write_id)  # a failed append leaves no files

    def _log_rows(self) -> DataFrame:
        stored = self._read_schema(PART, COMMIT, WRITE).fieldNames()
        rows = self.spark.table(self.name).select(*stored)
        partial = [w for w, state in self._pending().items() if state == "log"]
        return rows.where(~F.col(WRITE).isin(partial)) if partial else rows

    def overwrite(self, df: DataFrame, commit: str | None = None, **options) -> str | None:
        raise NotImplementedError("a bucketed log is appended to; write a new table instead")

    def batch_writer(self, stream: str):
        raise NotImplementedError("a repeated batch would have to replace rows; stream into a LakeTable")
