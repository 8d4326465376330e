"""A table of what streams did: one row a micro-batch, and their starts and ends.

``BatchLog`` listens to the streams of a session while it is open (``with``) and
turns what it heard into DataFrames; it keeps a few numbers a micro-batch, on the
driver, where Spark delivers them.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

BATCHES = "query_id string, run_id string, name string, batch_id long, input_rows long, duration_ms long, timestamp string, sources int"
EVENTS = "query_id string, run_id string, name string, event string, error string"


class _Listener(StreamingQueryListener):
    def __init__(self):
        self.lock = threading.Condition()
        self.batches: list[tuple] = []
        self.events: list[tuple] = []
        self.names: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.names[str(event.runId)] = event.name
            self.events.append((str(event.id), str(event.runId), event.name, "started", None))
            self.lock.notify_all()

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        row = (
            p["id"], p["runId"], p.get("name"), p["batchId"], p.get("numInputRows", 0),
            p.get("batchDuration") or p.get("durationMs", {}).get("triggerExecution", 0), p["timestamp"], len(p.get("sources", [])),
        )
        with self.lock:
            self.batches.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.events.append((str(event.id), str(event.runId), self.names.get(str(event.runId)), "ended", event.exception))
            self.lock.notify_all()


class BatchLog:
    """``with BatchLog(spark) as log: ...`` hears all streams of the session."""

    def __init__(self, spark: SparkSession):
        self.spark, self._listener = spark, _Listener()

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self._listener)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self._listener)

    def wait_ended(self, run_ids: list[str], timeout_s: float = 60) -> bool:
        """Events come after the fact: wait until the ends of these runs were heard (a
        run's batches are heard before its end)."""
        until = time.monotonic() + timeout_s
        with self._listener.lock:
            while True:
                ended = {r[1] for r in self._listener.events if r[3] == "ended"}
                left = until - time.monotonic()
                if ended >= set(map(str, run_ids)) or left <= 0:
                    return ended >= set(map(str, run_ids))
                self._listener.lock.wait(left)

    def batches(self) -> DataFrame:
        """A row a micro-batch; a repeat of one (after a restart) is a row of its own run."""
        with self._listener.lock:
            return self.spark.createDataFrame(list(self._listener.batches), BATCHES)

    def events(self) -> DataFrame:
        """Starts and ends, an end with its error if it has one."""
        with self._listener.lock:
            return self.spark.createDataFrame(list(self._listener.events), EVENTS)
