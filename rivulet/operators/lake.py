"""Keyed lake table over a Parquet change log.

Data model
----------
A table is identified by ``(partition, record key)``.  Every write appends rows
to a change log under a *commit*, an instant of 17 digits such as
``20211225152016000``::

    <path>/_table.json                                          (generation, schema)
    <path>/log/_gen=<gen>/_commit_time=<c>/_write_id=<w>/part-*.parquet
    <path>/v<gen>/current/_partition_path=<p>/part-*.parquet    (copy-on-write state)
    <path>/v<gen>/pending/<w>                                   (writes under way)
    <path>/completed/<w>-<n>.json                               (a line for each finished write)

Log rows carry the data columns plus ``_partition_path``, ``_record_key`` and
``_op`` (``U`` upsert, ``D`` delete tombstone).  Each write has an id of its own
below the commit, so two writes of one commit add up; a stream's write id is
made of its stream and batch, so a replayed batch replaces itself and nothing
else.  The state of the table at any instant is the *latest row per identity*
among the commits up to that instant, with tombstones removed.  "Latest" is a
total order: the commit instant, then the precombine field, then tie-break
columns (``merge="commit"``); or the precombine field first
(``merge="precombine"``: late data never overwrites a newer record).  In that
mode a tombstone with a precombine value competes by it, and one without beats
every row of its own and earlier commits.

Interrupted writes
------------------
The log is the truth.  A write leaves a file in ``pending/`` until it is done.
While its rows are being appended readers leave its write id out; from then on
its rows count, and until ``current/`` is refreshed snapshots reduce the log
instead.  The next write refreshes what an interrupted one touched.  A write that
fails while its process lives takes its rows and its mark away with it.
``_table.json`` is replaced last, by a rename: an overwrite that fails leaves
readers on the old generation with the old schema.

Spark mapping
-------------
* latest-per-identity = ``row_number() over (partition by identity order by
  ...) = 1``.  Spark plans it with a partial top-1 per task before the
  shuffle, so a key holding a third of all rows still ships one row per task,
  never a whole group to one task; and the scan is pruned to the columns the
  caller selects.  Filters on ``partitions`` and ``keys`` reach the scan.
* As-of / incremental reads are filters on the ``_commit_time`` directory
  column -> partition pruning, only the needed commits are listed and read.
* Copy-on-write: the first write's log is the state as it stands; from the second
  on ``current/`` holds the reduced state, and a write rewrites only the
  partitions it touches.  Merge-on-read reduces the log at read time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.timefmt import instant_column, normalize_instant
from rivulet.session import delete_path, list_dirs, list_names, path_exists, read_text, replace_text

COMMIT = "_commit_time"
WRITE = "_write_id"
GENERATION = "_gen"
PART = "_partition_path"
KEY = "_record_key"
OP = "_op"
META = (COMMIT, PART, KEY, OP)
IDENTITY = (PART, KEY)

# Partition path of rows whose partition field is NULL or empty.
DEFAULT_PARTITION = "default"
# "Last commit in current/" where commits came from a column: above any instant.
_UNKNOWN_COMMIT = "~"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order`` tuple.

    ``order`` must be a total order on the rows of one key (add tie-break
    columns); NULLs sort lowest.  Written as ``row_number() = 1`` so that
    Catalyst (a) plans a partial top-1 per task before the shuffle
    (``WindowGroupLimit Partial``: a hot key ships one row per map task) and
    (b) prunes the scan to the columns used above it.
    """
    spec = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    w = Window.partitionBy(*keys).orderBy(*spec)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def now_instant() -> str:
    """Current UTC time as a 17-digit instant ``yyyyMMddHHmmssSSS``."""
    t = datetime.now(timezone.utc)
    return t.strftime("%Y%m%d%H%M%S") + f"{t.microsecond // 1000:03d}"


class LakeTable:
    """A keyed table: ``key`` record key, ``partition`` partition field,
    ``precombine`` field that picks the winner among rows of one key.

    kind   ``"cow"`` (copy-on-write: state materialised at write time) or
           ``"mor"`` (merge-on-read: state reduced at read time).
    merge  ``"commit"`` (latest commit wins) or ``"precombine"`` (greatest
           precombine value wins across commits).
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        precombine: str,
        partition: str,
        kind: str = "cow",
        merge: str = "commit",
        tiebreak: Sequence[str] = (),
    ):
        if kind not in ("cow", "mor"):
            raise ValueError("kind must be 'cow' or 'mor'")
        if merge not in ("commit", "precombine"):
            raise ValueError("merge must be 'commit' or 'precombine'")
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.precombine = precombine
        self.partition = partition
        self.kind = kind
        self.merge = merge
        self.tiebreak = tuple(tiebreak)
        # what an overwrite is building; readers see it once it is published
        self._building: dict | None = None

    # ------------------------------------------------------------------ layout
    def _table(self) -> dict | None:
        """Generation and schema, both from the one table file."""
        if self._building is not None:
            return self._building
        text = read_text(self.spark, f"{self.path}/_table.json")
        return json.loads(text) if text else None

    def _publish(self, table: dict) -> None:
        if self._building is not None:
            self._building = table
        else:
            replace_text(self.spark, f"{self.path}/_table.json", json.dumps(table))

    def _generation(self) -> int:
        table = self._table()
        return table["generation"] if table else 0

    def _root(self) -> str:
        return f"{self.path}/v{self._generation()}"

    def _log_dir(self) -> str:
        return f"{self.path}/log/{GENERATION}={self._generation()}"

    def _current_dir(self) -> str:
        return f"{self._root()}/current"

    def _pending(self) -> dict[str, str]:
        """Writes under way or interrupted: write id -> ``log`` or ``refresh``."""
        d = f"{self._root()}/pending"
        names = [w for w in list_names(self.spark, d) if not w.startswith(".")]
        return {w: read_text(self.spark, f"{d}/{w}") or "log" for w in names}

    def _mark(self, write_id: str, state: str) -> None:
        replace_text(self.spark, f"{self._root()}/pending/{write_id}", state)

    def _done(self, write_id: str) -> None:
        delete_path(self.spark, f"{self._root()}/pending/{write_id}")

    def _forget(self, write_id: str) -> None:
        """Take away the rows of a write that failed before they counted."""
        for commit in list_dirs(self.spark, self._log_dir()):
            delete_path(self.spark, f"{self._log_dir()}/{commit}/{WRITE}={write_id}")
        self._done(write_id)

    def _announce(self, write_id: str) -> None:
        """Tell the table's tails that a write is complete."""
        line = {"write_id": write_id, "generation": self._generation(), "completed_at": datetime.now(timezone.utc).isoformat()}
        replace_text(self.spark, f"{self.path}/completed/{write_id}-{uuid.uuid4().hex[:8]}.json", json.dumps(line))

    @property
    def data_schema(self) -> T.StructType | None:
        """Schema of the stored rows (data columns + ``_record_key``, ``_op``)."""
        table = self._table()
        return T.StructType.fromJson(table["schema"]) if table and table.get("schema") else None

    def _read_schema(self, *extra: str) -> T.StructType:
        schema = self.data_schema
        if schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in extra)])

    def _scan(self, folder: str, *extra: str) -> DataFrame:
        schema = self._read_schema(*extra)
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", folder).parquet(folder)

    # ------------------------------------------------------------------ reads
    def _log_rows(self) -> DataFrame:
        """The log with its write ids, without writes that were not completed."""
        rows = self._scan(self._log_dir(), PART, COMMIT, WRITE)
        partial = [w for w, state in self._pending().items() if state == "log"]
        return rows.where(~F.col(WRITE).isin(partial)) if partial else rows

    def log(self) -> DataFrame:
        """The raw change log (every row of every commit, tombstones included)."""
        return self._log_rows().drop(WRITE)

    def _tiebreak(self) -> list[str]:
        """Declared tie-break columns; by default every other sortable data
        column, so that equal (commit, precombine) pairs still give one
        deterministic winner."""
        if self.tiebreak:
            return list(self.tiebreak)
        sortable = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
                    T.TimestampNTZType, T.BinaryType)
        skip = {self.key, self.partition, self.precombine, KEY, OP}
        return [f.name for f in (self.data_schema or T.StructType()).fields
                if f.name not in skip and isinstance(f.dataType, sortable)]

    def _order(self) -> list[str]:
        if self.merge == "commit":
            return [COMMIT, self.precombine, *self._tiebreak()]
        return [self.precombine, COMMIT, *self._tiebreak()]

    def _latest(self, rows: DataFrame) -> DataFrame:
        """Latest row per identity, tombstones kept."""
        if self.merge == "precombine":
            rows = self._without_cut(rows)
        return latest_per_key(rows, list(IDENTITY), self._order())

    def _without_cut(self, rows: DataFrame) -> DataFrame:
        """Rows but those that a tombstone without a precombine value deletes: the
        ones of its commit and of commits before it."""
        undated = (F.col(OP) == "D") & F.col(self.precombine).isNull()
        cuts = rows.where(undated).groupBy(*IDENTITY).agg(F.max(COMMIT).alias("_cut"))
        cut = F.col("_cut")
        kept = cut.isNull() | (F.col(COMMIT) > cut) | (undated & (F.col(COMMIT) == cut))
        return rows.join(cuts, list(IDENTITY), "left").where(kept).select(*rows.columns)

    def _public(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(OP) != "D").drop(OP)

    def _restrict(self, df: DataFrame, partitions, keys) -> DataFrame:
        """Keep only the given table partitions and record keys; both filters
        reach the scan (folder pruning, row-group skipping)."""
        if partitions is not None:
            df = df.where(F.col(PART).isin([DEFAULT_PARTITION if p in (None, "") else str(p) for p in partitions]))
        if keys is not None:
            df = df.where(F.col(KEY).isin([str(k) for k in keys]))
        return df

    def snapshot(self, partitions=None, keys=None) -> DataFrame:
        """Current state of the table (of the given ``partitions`` and ``keys`` only).

        Copy-on-write: ``current/`` as it is; the log of the only write, or the log
        reduced while a refresh is outstanding.  Merge-on-read: the log reduced."""
        table = self._table() or {}
        if self.kind == "cow":
            pending = self._pending()
            if table.get("sole") and not pending:
                return self._public(self._restrict(self.log(), partitions, keys))
            if "refresh" not in pending.values() and path_exists(self.spark, self._current_dir()):
                return self._public(self._restrict(self._current(), partitions, keys))
        return self._public(self._latest(self._restrict(self.log(), partitions, keys)))

    def _current(self) -> DataFrame:
        """``current/``: one row per identity, tombstones included."""
        return self._scan(self._current_dir(), COMMIT, PART).select(*self._read_schema(PART, COMMIT).fieldNames())

    def as_of(self, instant: str, partitions=None, keys=None) -> DataFrame:
        """State as of ``instant`` (inclusive); any spelling of an instant."""
        log = self._restrict(self.log(), partitions, keys)
        return self._public(self._latest(log.where(F.col(COMMIT) <= F.lit(normalize_instant(instant)))))

    def incremental(self, begin: str, end: str | None = None, partitions=None, keys=None) -> DataFrame:
        """Latest row per identity among commits in ``(begin, end]``."""
        cond = F.col(COMMIT) > F.lit(normalize_instant(begin))
        if end is not None:
            cond = cond & (F.col(COMMIT) <= F.lit(normalize_instant(end)))
        return self._public(self._latest(self._restrict(self.log(), partitions, keys).where(cond)))

    def commits(self, limit: int = 50) -> DataFrame:
        """The newest ``limit`` commits that rows of the snapshot come from, newest
        first."""
        return (
            self.snapshot().select(F.col(COMMIT).alias("commit_time")).distinct()
            .orderBy(F.desc("commit_time")).limit(limit)
        )

    def begin_instant(self, newest: int = 50) -> str | None:
        """The oldest of the newest ``newest`` commits of the snapshot: the begin
        instant of an incremental read over them.  None for an empty table."""
        return self.commits(newest).agg(F.min("commit_time")).first()[0]

    def last_instant(self) -> str | None:
        """The newest commit of the log."""
        return self.log().agg(F.max(COMMIT)).first()[0]

    def count(self) -> int:
        """Rows of the snapshot; of a copy-on-write table that never had a delete from the
        footers of its files, without reading a row."""
        counted = self.footer_count()
        return self.snapshot().count() if counted is None else counted.first()[0]

    def footer_count(self) -> DataFrame | None:
        """``(n)`` from Parquet footers, or None where these can't tell: merge-on-read,
        tables that had a delete, an outstanding refresh."""
        table = self._table() or {}
        if self.kind != "cow" or table.get("deletes", True) or self._pending():
            return None
        folder = self._log_dir() if table.get("sole") else self._current_dir()
        if not path_exists(self.spark, folder):
            return None
        quick = self.spark.newSession()  # the settings are this count's alone
        quick.conf.set("spark.sql.sources.useV1SourceList", "")
        quick.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return quick.read.schema(self._read_schema()).parquet(folder).agg(F.count(F.lit(1)).alias("n"))

    # ------------------------------------------------------------------ writes
    def _stamp(
        self,
        df: DataFrame,
        instant: str | None,
        commit_col: str | None,
        delete_col: str | None,
        op: str = "U",
    ) -> DataFrame:
        commit_value: Column = F.lit(instant) if commit_col is None else instant_column(F.col(commit_col))
        op_value = F.when(F.col(delete_col), F.lit("D")).otherwise(F.lit("U")) if delete_col else F.lit(op)
        control = {c for c in (commit_col, delete_col) if c}
        key = F.col(self.key).cast("string")
        # a record without a key cannot be identified: fail the write instead
        # of silently merging all such rows into one identity
        key = F.when(key.isNotNull(), key).otherwise(
            F.raise_error(F.lit(f"NULL record key in column {self.key}"))
        )
        return df.select(
            *[c for c in df.columns if c not in control],
            key.alias(KEY),
            self._partition_value().alias(PART),
            commit_value.alias(COMMIT),
            op_value.alias(OP),
        )

    def _partition_value(self) -> Column:
        """Partition path as text; NULL or empty becomes ``default`` so that an
        identity never contains NULL (folder pruning and joins stay exact)."""
        p = F.col(self.partition).cast("string")
        return F.when(p.isNull() | (p == ""), F.lit(DEFAULT_PARTITION)).otherwise(p)

    def _conform(self, rows: DataFrame, schema: dict | None) -> tuple[DataFrame, dict]:
        """The rows in the stored schema; of a new table theirs becomes it."""
        stored = [c for c in rows.columns if c not in (PART, COMMIT)]
        schema = schema or rows.select(*stored).schema.jsonValue()
        fields = T.StructType.fromJson(schema).fields
        missing = {f.name for f in fields} - set(rows.columns)
        extra = set(stored) - {f.name for f in fields}
        if missing or extra:
            raise ValueError(f"schema mismatch: missing {sorted(missing)}, unexpected {sorted(extra)}")
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in fields], PART, COMMIT), schema

    def _append(self, rows: DataFrame, write_id: str, one_commit: bool) -> None:
        """Add a write to the log, sorted by identity inside each file so that
        Parquet statistics skip row groups on partition and key filters.  Rows of
        one commit stay where the reduction left them; rows of many are gathered
        by commit (a commit gets a few files; AQE splits a large one)."""
        rows = rows if one_commit else rows.hint("rebalance", COMMIT)
        (
            rows.withColumn(WRITE, F.lit(write_id))
            .sortWithinPartitions(COMMIT, PART, KEY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(COMMIT, WRITE)
            .parquet(self._log_dir())
        )

    def _applied(self) -> str | None:
        return read_text(self.spark, f"{self._root()}/applied")

    def _refresh_current(self, write_id: str, instant: str | None, interrupted: list[str]) -> None:
        """Copy-on-write: rewrite the partitions of ``current/`` that the write
        touches, and those of interrupted writes before it."""
        log, applied = self._log_rows(), self._applied()
        batch = log.where(F.col(WRITE) == write_id).drop(WRITE)
        if applied is None or not path_exists(self.spark, self._current_dir()):
            state = self._latest(log.drop(WRITE))
        elif interrupted or (self.merge == "precombine" and (instant is None or instant <= applied)):
            # what an interrupted write left is unknown, and current/ doesn't hold the
            # tombstones a late commit meets: reduce the log of the partitions
            touched = log.where(F.col(WRITE).isin([write_id, *interrupted])).select(PART).distinct()
            state = self._latest(log.drop(WRITE).join(touched, PART, "left_semi"))
        else:
            state = self._merged(batch, instant, applied)
        (
            state.hint("rebalance", PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PART)
            .parquet(self._current_dir())
        )
        last = _UNKNOWN_COMMIT if instant is None else max(instant, applied or instant)
        replace_text(self.spark, f"{self._root()}/applied", last)

    def _merged(self, batch: DataFrame, instant: str | None, applied: str) -> DataFrame:
        """The touched partitions of ``current/`` after ``batch``; one scan of them.
        The comparison with '' is always true: it lets Spark prune the folders of
        ``current/`` by the batch's partitions when it broadcasts those."""
        touched = batch.where(F.col(PART) >= "").select(PART).distinct()
        base = self._current().join(touched, PART, "left_semi").select(*batch.columns)
        if self.merge == "commit" and instant is not None and instant > applied:
            # newer than every row there: contested base rows lose, no reduction needed
            return base.join(batch.select(*IDENTITY), list(IDENTITY), "left_anti").unionByName(batch)
        return self._latest(base.unionByName(batch))

    def write(
        self,
        df: DataFrame,
        commit: str | None = None,
        commit_col: str | None = None,
        delete_col: str | None = None,
        op: str = "U",
        write_id: str | None = None,
    ) -> str | None:
        """Write one commit (``commit``, default now) or a change feed with a
        commit per row (``commit_col``; ``delete_col`` flags deletes).  Rows of
        one identity in one commit are first reduced to the greatest precombine
        value.  A second write to a commit adds to the first; the same
        ``write_id`` replaces its own rows there.  Returns the commit instant (None
        for a change feed)."""
        instant = None if commit_col else (normalize_instant(commit) if commit else now_instant())
        write_id = write_id or uuid.uuid4().hex
        table = dict(self._table() or {"generation": 0})
        rows, schema = self._conform(self._stamp(df, instant, commit_col, delete_col, op), table.get("schema"))
        first = not table.get("schema")
        # the state of a copy-on-write table whose only write is one commit is its log
        sole = write_id if self.kind == "cow" and instant is not None and (first or table.get("sole") == write_id) else None
        deletes = table.get("deletes", not first) or op == "D" or delete_col is not None
        if first or table.get("sole") != sole or table.get("deletes") != deletes:
            self._publish({**table, "schema": schema, "sole": sole, "deletes": deletes})
        interrupted = [w for w, state in self._pending().items() if state == "refresh" and w != write_id]
        self._mark(write_id, "log")
        combined = latest_per_key(rows, [PART, KEY, COMMIT], [self.precombine, *self._tiebreak()])
        try:
            self._append(combined.select(*rows.columns), write_id, commit_col is None)
        except Exception:
            self._forget(write_id)
            raise
        if self.kind == "cow" and not sole:
            self._mark(write_id, "refresh")
            self._refresh_current(write_id, instant, interrupted)
        for w in [*interrupted, write_id]:
            self._done(w)
            if self._building is None:  # an overwrite is complete once it is published
                self._announce(w)
        return instant

    insert = write
    upsert = write

    def delete(self, keys: DataFrame, commit: str | None = None) -> str | None:
        """Append tombstones for the identities in ``keys`` (key + partition
        columns; other columns, e.g. the precombine field, are kept if given)."""
        schema = self.data_schema
        if schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        cols = []
        for f in schema.fields:
            if f.name in (KEY, OP):
                continue
            cols.append(F.col(f.name) if f.name in keys.columns else F.lit(None).cast(f.dataType).alias(f.name))
        return self.write(keys.select(*cols), commit=commit, op="D")

    def overwrite(self, df: DataFrame, commit: str | None = None, **options) -> str | None:
        """Replace the table and its history with ``df`` (``options`` as of
        ``write``): the rows go to a new generation, and the table file, replaced
        last, makes it the table's.  Until then readers keep the old one."""
        before = self._table()
        building = LakeTable(
            self.spark, self.path, self.key, self.precombine, self.partition, self.kind, self.merge, self.tiebreak
        )
        names = list_names(self.spark, f"{self.path}/log")  # a failed overwrite leaves its generation
        taken = [int(n.split("=")[1]) for n in names if n.startswith(f"{GENERATION}=")]
        building._building = {"generation": max([*taken, before["generation"] if before else -1]) + 1}
        write_id = options.pop("write_id", None) or uuid.uuid4().hex
        c = building.write(df, commit=commit, write_id=write_id, **options)
        self._publish(building._building)
        self._announce(write_id)
        return c

    # ------------------------------------------------------------ streaming
    def batch_writer(self, stream: str):
        """``foreachBatch`` callback: each micro-batch is one write.  ``stream``
        names the stream for good (its checkpoint folder); stream and batch id make
        the write id, and the batch's commit is recorded, so a replayed batch
        goes to its old commit and replaces itself.  Streams do not meet."""
        name = uuid.uuid5(uuid.NAMESPACE_URL, stream).hex

        def _write(batch: DataFrame, batch_id: int) -> None:
            note = f"{self.path}/_streams/{name}"
            last = (read_text(self.spark, note) or "").split()
            commit = last[1] if last[:1] == [str(batch_id)] else now_instant()
            replace_text(self.spark, note, f"{batch_id} {commit}")
            self.write(batch, commit=commit, write_id=f"{name}-{batch_id}")

        return _write


def apply_changes_anti(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Copy-on-write merge written as ``left_anti`` + union: rows of ``base``
    whose key is not in ``changes``, plus the changes.  ``changes`` must hold
    one row per key (already precombined) and no deletes."""
    return base.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes)
