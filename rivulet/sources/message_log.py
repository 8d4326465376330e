"""A message log with offsets: stream source and sink for tests and backfills where
no broker is deployed, as a Python data source over Arrow batches.

Layout of a topic::

    <path>/<topic>/segments/<id>.parquet     key, value, timestamp in order of arrival
    <path>/<topic>/commits/<number>.json     segments made visible together

A commit lists ``[partition, first offset, messages, file]`` of its segments and is
put in place by one rename, so all messages of a write appear at once or not at
all, and offsets are dense in every topic partition.  A topic has one writer at a
time; readers may be many.

Source offsets are ``{"<topic>/<partition>": next offset}``.  Options:

``path``                the log (any file system that Arrow knows by URI)
``subscribe``           topics, separated by commas
``startingOffsets``     ``latest`` (default), ``earliest``, or JSON by topic and partition
``maxOffsetsPerTrigger``  messages of a micro-batch over all partitions (default: all)
``failOnDataLoss``      ``true`` (default): a lost segment fails the query; ``false``: it
                        is passed over
``progress``            folder for the plan's last end (needed with a cap: a restarted
                        query counts its cap from there)
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

# tasks get the source with the job: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "message_log"
SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
_STORED = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", "UTC"))])
_READ = pa.schema(
    [
        ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
        ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32()),
    ]
)
_ROWS = 10_000  # of a batch given to Spark


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):  # with one slash or three
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _names(fs: pafs.FileSystem, folder: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and not f.base_name.startswith((".", "_")))


def _put(fs: pafs.FileSystem, path: str, text: str) -> None:
    """A small file, seen whole or not at all."""
    folder, name = path.rsplit("/", 1)
    fs.create_dir(folder, recursive=True)
    fresh = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(fresh) as out:
        out.write(text.encode())
    fs.move(fresh, path)


@dataclass
class Segment(InputPartition):
    """Messages of one file: those of offsets ``start`` to ``end`` of a topic partition."""

    topic: str
    partition: int
    first: int  # offset of the file's first message
    file: str
    start: int
    end: int


class Topics:
    """The visible segments of topics; commits are read once each."""

    def __init__(self, path: str, topics: list[str]):
        self.fs, self.root = _open(path.rstrip("/"))
        self.topics, self.seen = topics, {t: set() for t in topics}
        self.segments: dict[str, list[Segment]] = {}

    def refresh(self) -> dict[str, int]:
        """Next offset of every topic partition."""
        for topic in self.topics:
            folder = f"{self.root}/{topic}/commits"
            for name in _names(self.fs, folder):
                if name not in self.seen[topic]:
                    self.seen[topic].add(name)
                    with self.fs.open_input_stream(f"{folder}/{name}") as f:
                        commit = json.loads(f.read())
                    for partition, first, n, file in commit["segments"]:
                        own = self.segments.setdefault(f"{topic}/{partition}", [])
                        own.append(Segment(topic, partition, first, file, first, first + n))
        return {k: max(s.end for s in own) for k, own in sorted(self.segments.items())}


# -------------------------------------------------------------------- source
def capped(start: dict[str, int], latest: dict[str, int], most: int | None) -> dict[str, int]:
    """The end of a micro-batch of at most ``most`` messages, shared out by what is left
    in every partition; what rounding leaves goes to those with the most left."""
    left = {k: max(end - start.get(k, 0), 0) for k, end in latest.items()}
    total = sum(left.values())
    if most is None or total <= most:
        take = left
    else:
        take = {k: n * most // total for k, n in left.items()}
        rest = most - sum(take.values())
        for k in sorted(left, key=lambda k: (take[k] - left[k], k))[:rest]:
            take[k] += 1
    return dict(sorted({**start, **{k: start.get(k, 0) + n for k, n in take.items()}}.items()))


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.topics = Topics(self.path, [t.strip() for t in options["subscribe"].split(",")])
        self.starting = options.get("startingoffsets", "latest")
        most = options.get("maxoffsetspertrigger")
        self.most = int(most) if most else None
        self.strict = options.get("failondataloss", "true").lower() != "false"
        self.progress = options.get("progress")
        if self.most is not None and not self.progress:
            raise ValueError("maxOffsetsPerTrigger needs the option progress (a folder beside the checkpoint)")
        self.first: dict[str, int] | None = None
        self.at = self._planned()

    def _planned(self) -> dict[str, int] | None:
        if not self.progress:
            return None
        fs, folder = _open(self.progress)
        if fs.get_file_info(f"{folder}/planned").type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(f"{folder}/planned") as f:
            return json.loads(f.read())

    def initialOffset(self) -> dict:
        if self.first is None:
            latest = self.topics.refresh()
            if self.starting == "latest":
                self.first = latest
            elif self.starting == "earliest":
                self.first = dict.fromkeys(latest, 0)
            else:
                asked = json.loads(self.starting)
                asked = {f"{t}/{p}": n for t, own in asked.items() for p, n in own.items()}
                self.first = {k: {-1: n, -2: 0}.get(asked.get(k, -1), asked.get(k, -1)) for k, n in latest.items()}
        return self.first

    def latestOffset(self) -> dict:
        start = self.at if self.at is not None else self.initialOffset()
        if self.most is None and self.at is None and not self.progress:
            return dict(sorted({**self.initialOffset(), **self.topics.refresh()}.items()))  # a restarted query knows its start itself
        return capped(start, self.topics.refresh(), self.most)

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        if self.at != end:
            self.at = end
            if self.progress:  # before the batch runs: a restart repeats it or goes on from here
                fs, folder = _open(self.progress)
                _put(fs, f"{folder}/planned", json.dumps(end))
        self.topics.refresh()
        out = []
        for k, last in sorted(end.items()):
            for s in self.topics.segments.get(k, ()):
                lo, hi = max(s.start, start.get(k, 0)), min(s.end, last)
                if lo < hi:
                    out.append(Segment(s.topic, s.partition, s.first, s.file, lo, hi))
        return out

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        fs, root = _open(self.path)
        try:
            source = fs.open_input_file(f"{root}/{partition.topic}/segments/{partition.file}")
        except FileNotFoundError:
            if self.strict:
                raise
            return
        with source:
            at = partition.first
            for b in pq.ParquetFile(source).iter_batches(_ROWS):
                lo, hi = max(partition.start - at, 0), min(partition.end - at, b.num_rows)  # of its rows
                if lo < hi:
                    n = hi - lo
                    own = b.slice(lo, n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own.column(0), own.column(1), pa.repeat(partition.topic, n),
                            pa.repeat(pa.scalar(partition.partition, pa.int32()), n), pa.array(range(at + lo, at + hi), pa.int64()),
                            own.column(2).cast(pa.timestamp("us", "UTC")), pa.repeat(pa.scalar(0, pa.int32()), n),
                        ],
                        schema=_READ,
                    )
                at += b.num_rows
                if at >= partition.end:
                    return


# ---------------------------------------------------------------------- sink
@dataclass
class Written(WriterCommitMessage):
    """Per topic partition the file a task wrote, and its messages."""

    segments: list[tuple[int, int, str]] = field(default_factory=list)


class _Writer:
    def __init__(self, options: dict[str, str]):
        if not options.get("topic"):
            raise ValueError("the option topic is required")
        self.path, self.topic = options["path"].rstrip("/"), options["topic"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """A file per topic partition of the task's messages, invisible until the commit."""
        fs, root = _open(self.path)
        folder = f"{root}/{self.topic}/segments"
        fs.create_dir(folder, recursive=True)
        open_: dict[int, tuple[str, pq.ParquetWriter]] = {}
        count: dict[int, int] = {}
        try:
            for b in iterator:
                part = b.column("partition").cast(pa.int32())
                rows = pa.Table.from_batches([b]).select(_STORED.names).cast(_STORED)
                for p in part.unique().to_pylist():
                    own = rows.filter(pc.equal(part, p))
                    if p not in open_:
                        name = f"{uuid.uuid4().hex}.parquet"
                        open_[p] = name, pq.ParquetWriter(f"{folder}/{name}", _STORED, filesystem=fs)
                    open_[p][1].write_table(own)
                    count[p] = count.get(p, 0) + own.num_rows
        except BaseException:
            for name, writer in open_.values():
                writer.close()
                fs.delete_file(f"{folder}/{name}")
            raise
        for _, writer in open_.values():
            writer.close()
        return Written([(p, count[p], name) for p, (name, _) in sorted(open_.items())])

    def _publish(self, messages: list[Written | None], note: str | None) -> None:
        fs, root = _open(self.path)
        folder = f"{root}/{self.topic}/commits"
        names = _names(fs, folder)
        if note and any(n.endswith(f"-{note}.json") for n in names):  # a repeated batch
            self._remove(messages)
            return
        ends = Topics(self.path, [self.topic]).refresh()
        segments = []
        for m in messages:
            for p, n, file in m.segments if m else ():
                first = ends.get(f"{self.topic}/{p}", 0)
                ends[f"{self.topic}/{p}"] = first + n
                segments.append([p, first, n, file])
        number = int(names[-1].split("-")[0]) + 1 if names else 0
        _put(fs, f"{folder}/{number:012d}-{note or 'batch'}.json", json.dumps({"segments": segments}))

    def _remove(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for _, _, file in m.segments if m else ():
                fs.delete_file(f"{root}/{self.topic}/segments/{file}")


class MessageLogWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self._publish(messages, None)

    def abort(self, messages: list[Written | None]) -> None:
        self._remove(messages)


class MessageLogStreamWriter(_Writer, DataSourceStreamArrowWriter):
    """Each micro-batch is one commit, named by the option ``stream`` and the batch."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        if not options.get("stream"):
            raise ValueError("the option stream (a name kept over restarts) is required")
        self.stream = uuid.uuid5(uuid.NAMESPACE_URL, options["stream"]).hex

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self._publish(messages, f"{self.stream}-{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._remove(messages)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def streamReader(self, schema) -> MessageLogReader:
        return MessageLogReader(self._options())

    def writer(self, schema, overwrite: bool) -> MessageLogWriter:
        if overwrite:
            raise ValueError("messages are appended only")
        return MessageLogWriter(self._options())

    def streamWriter(self, schema, overwrite: bool) -> MessageLogStreamWriter:
        return MessageLogStreamWriter(self._options())


# ------------------------------------------------------------------- helpers
def append_messages(messages: DataFrame, path: str, topic: str) -> str:
    """Append messages (``key``, ``value``, ``partition``, ``timestamp``) as one commit."""
    messages.sparkSession.dataSource.register(MessageLog)
    rows = messages.select("key", "value", "partition", "timestamp")
    rows.write.format(FORMAT).mode("append").option("topic", topic).save(path)
    return path


def read_message_log(spark: SparkSession, path: str, topics: str, **options) -> DataFrame:
    """Streaming read of the topics; ``options`` as in the module's list."""
    spark.dataSource.register(MessageLog)
    return spark.readStream.format(FORMAT).options(subscribe=topics, **options).load(path)
