"""Where jobs keep the tables they write.

Written tables (lake logs, stream sinks, checkpoints, catalog locations) go
below the shared folder named by ``spark.checkpoint.dir``.  On a cluster that
setting names a shared file system (HDFS, object store), so the files survive
the loss of any executor.  Only when it is unset -- a laptop or a unit test --
do we choose a folder of our own and register it with the session.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"
_LOCAL = re.compile(r"local(\[[^\]]*\])?$")  # one process; not local-cluster
# Folders chosen for applications whose session names none (by application id).
_OWN_ROOTS: dict[str, str] = {}


def ensure_work_dir(spark: SparkSession) -> str:
    """Return the shared work folder.

    ``spark.checkpoint.dir`` when the session sets it; else the context's
    checkpoint folder when one was set in code; else (tests, a laptop) a
    folder of our own, chosen once per application and registered as the
    checkpoint folder.  ``spark.checkpoint.dir`` itself cannot be changed on
    a running session, so it is only ever read.
    """
    root = spark.conf.get(_CONF_KEY, None)
    sc = spark.sparkContext
    if not root:
        app = sc.applicationId
        if not (_LOCAL.match(sc.master) or app in _OWN_ROOTS or sc.getCheckpointDir()):
            raise ValueError(f"{_CONF_KEY} must name a folder that driver and executors share")
        root = _OWN_ROOTS.get(app) or sc.getCheckpointDir() or tempfile.mkdtemp(prefix="rivulet-")
        _OWN_ROOTS[app] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root.rstrip("/") + "/rdd")
    return root.rstrip("/")


# Folders handed out by ``work_path`` in this process (newest last).
_HANDED_OUT: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared work folder."""
    path = f"{ensure_work_dir(spark)}/rivulet/{name}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.append(path)
    return path


def take_handed_out() -> list[str]:
    """The folders ``work_path`` handed out since the last call (then forgets
    them); lets a caller remove exactly what its own jobs wrote."""
    out = list(_HANDED_OUT)
    _HANDED_OUT.clear()
    return out


def handed_out() -> int:
    """How many folders were handed out so far: a mark for ``remove_since``."""
    return len(_HANDED_OUT)


def last_handed_out() -> str | None:
    return _HANDED_OUT[-1] if _HANDED_OUT else None


def remove_since(spark: SparkSession, mark: int, keep: str | None = None) -> None:
    """Delete the folders handed out after ``mark``, but not ``keep``.  For a job that has
    written its result and reads nothing else of its own any more."""
    for path in [p for p in _HANDED_OUT[mark:] if p != keep]:
        _HANDED_OUT.remove(path)
        delete_path(spark, path)


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` through the JVM's Hadoop client."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder ``path`` (metadata only); none if it doesn't exist."""
    fs, p = hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata only, no data read)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The one line of a small metadata file, or None."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small metadata file under a temporary name and rename it over
    ``path``: readers see the old line or the new one, never a part."""
    fs, p = hadoop_fs(spark, path)
    _, fresh = hadoop_fs(spark, f"{p.getParent()}/.{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    over = getattr(hadoop, "Options$Rename")
    options = sc._gateway.new_array(over, 1)
    options[0] = over.OVERWRITE
    hadoop.FileContext.getFileContext(p.toUri(), sc._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(fresh), fs.makeQualified(p), options
    )


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)
