"""Substring dedup: repeated word windows by a compacted de Bruijn graph.

The windows of ``WINDOW`` words are the edges of a de Bruijn graph over words.
Only edges that several documents may share are built: each window is put under
its minimizer (the smallest hash of the 5-word pieces inside it, equal in equal
windows), and minimizers seen once are left out, which is exact.  Each repeated
edge gets the coordinate where it first stands (smallest doc_id, then position).
In every other document, consecutive edges whose first stands are
consecutive too, a path on which neither document branches off, are compacted
into one span with one source coordinate.  Joins bring candidates and spans to
the texts, and a span counts only if its words are those at its source.
Documents whose whole word sequence stands in a smaller doc_id are settled
before by their digest, so groups of copies never enter the graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import row_key, saved, table

WINDOW = 13
_PIECE = 5
_PER_WINDOW = WINDOW - _PIECE + 1

_ODD = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        _POWERS[:] = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for many ranges, by sums of powers."""
    up, down = _powers(len(values) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)))
    return _mixed((total[end] - total[start]) * down[start])


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in order."""
    b = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([False], ~((b == 32) | ((b >= 9) & (b <= 13))), [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return _sums(_BYTES[b], edge[::2], edge[1::2])


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    at = np.arange(max(len(h) - size + 1, 0))
    return _sums(h, at, at + size)


def minimizers(h: np.ndarray) -> np.ndarray:
    """Of every window the smallest hash of its pieces."""
    pieces = _runs(h, _PIECE)
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    low = pieces[:n].copy()
    for i in range(1, _PER_WINDOW):
        np.minimum(low, pieces[i : i + n], out=low)
    return low


class _Out:
    """Columns gathered as arrays and given out as record batches."""

    def __init__(self, **kinds: pa.DataType):
        self.kinds, self.parts, self.n = kinds, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])

    def batch(self) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.parts)] or [[] for _ in self.kinds]
        self.parts, self.n = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, self.kinds.values())], list(self.kinds))


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, digest of the words) of texts with a window."""
    for b in batches:
        k1, k2, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
        for i, t in enumerate(b.column(2).cast(pa.binary())):
            words = t.as_py().split()
            if len(words) >= WINDOW:
                out.append((k1[i], k2[i], _digest(words)))
        a, c, d = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.binary())], ["k1", "k2", "d"]
        )


def _is_copy(k2, copies) -> bool:
    return copies.is_valid and k2.as_py() in copies.as_py()


_TOGETHER = 1_000_000  # rows that a task looks at together before it sends any


def _salt(k1: np.ndarray) -> np.ndarray:
    return ((k1.view(np.uint64) * np.uint64(_ODD)) >> np.uint64(33)).astype(np.int32) | 1


def _minimizer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their copies -> (m, salt, k1), each minimizer of a text once.
    Of a minimizer that several documents of the task share, one row without
    document goes to its group (salt 0); the documents' own rows, settled, go
    elsewhere (salt not 0).  So no group gets more than a row for each
    ``_TOGETHER`` rows, however common its minimizer."""

    def settled(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        m, k1 = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(m, kind="stable")
        new = np.concatenate(([True], np.diff(m[order]) != 0))
        holders = np.diff(np.append(np.flatnonzero(new), len(m)))
        many = np.zeros(len(m), bool)
        many[order] = np.repeat(holders > 1, holders)
        common = m[order[new]][holders > 1]
        # in the documents' order, in which rows compress
        columns = (
            (m[~many], np.zeros(int((~many).sum()), np.int32), pa.array(k1[~many])),
            (common, np.zeros(len(common), np.int32), pa.nulls(len(common), pa.int64())),
            (m[many], _salt(k1[many]), pa.array(k1[many])),
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([c[0] for c in columns])),
                pa.array(np.concatenate([c[1] for c in columns])),
                pa.concat_arrays([c[2] for c in columns]),
            ],
            ["m", "salt", "k1"],
        )

    parts, n = [], 0
    for b in batches:
        for doc_id, k1, k2, t, copies in zip(*b.columns[:3], b.column(3).cast(pa.binary()), b.column(4)):
            if doc_id.is_valid and not _is_copy(k2, copies):
                m = np.unique(minimizers(word_hashes(t.as_py())).view(np.int64))
                parts.append((m, np.full(len(m), k1.as_py())))
                n += len(m)
                if n > _TOGETHER:
                    yield settled(parts)
                    parts, n = [], 0
    if n:
        yield settled(parts)


_EDGE = "h long, salt int, k1 long, k2 long, pos int, source struct<k1: long, k2: long, pos: int>"


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their shared minimizers -> the windows under these.  Of the
    stands of a window in the task only those of the smallest document go to the
    window's group (salt 0, no source); the others have their source in it."""

    def settled(parts: list[tuple]) -> pa.RecordBatch:
        h, k1, k2, pos = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((pos, k2, k1, h))
        first = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0)))
        at = np.empty(len(h), np.int64)
        at[order] = np.repeat(order[first], np.diff(np.append(first, len(h))))
        later = k1 > k1[at]
        at = at[later]
        sources = pa.StructArray.from_arrays([pa.array(x[at]) for x in (k1, k2, pos)], ["k1", "k2", "pos"])
        place = np.where(later, np.cumsum(later) - 1, 0)
        sources = sources.take(pa.array(place, mask=~later))
        columns = [pa.array(c) for c in (h, np.where(later, _salt(k1), np.int32(0)), k1, k2, pos)]
        return pa.RecordBatch.from_arrays([*columns, sources], ["h", "salt", "k1", "k2", "pos", "source"])

    parts, n = [], 0
    for b in batches:
        for doc_id, k1, k2, t, shared in zip(*b.columns[:3], b.column(3).cast(pa.binary()), b.column(4)):
            if doc_id.is_valid:
                h = word_hashes(t.as_py())
                under = minimizers(h).view(np.int64)
                (pos,) = np.nonzero(np.isin(under, shared.values.to_numpy(zero_copy_only=False)))
                at = (np.full(len(pos), k1.as_py()), np.full(len(pos), k2.as_py()), pos.astype(np.int32))
                parts.append((_runs(h, WINDOW)[pos].view(np.int64), *at))
                n += len(pos)
                if n > _TOGETHER:
                    yield settled(parts)
                    parts, n = [], 0
    if n:
        yield settled(parts)


_SPAN = "k1 long, k2 long, start int, n int, s1 long, s2 long, s_start int"


def _path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one document (k1; k2, pos and source in lists) -> spans of words."""
    for b in batches:
        out = _Out(k1=pa.int64(), k2=pa.int64(), start=pa.int32(), n=pa.int32(), s1=pa.int64(), s2=pa.int64(), s_start=pa.int32())
        for k1, edges in zip(b.column(0), b.column(1)):
            k2, pos, s1, s2, at = (c.to_numpy(zero_copy_only=False) for c in edges.values.flatten())
            order = np.lexsort((pos, k2))
            k2, pos, s1, s2, at = (c[order] for c in (k2, pos, s1, s2, at))
            new = np.ones(len(pos), bool)  # a run has one text at either side
            new[1:] = (np.diff(pos) != 1) | (np.diff(at) != 1) | (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1]) | (k2[1:] != k2[:-1])
            (first,) = np.nonzero(new)
            n = np.diff(np.append(first, len(pos))) + WINDOW - 1
            out.add(np.full(len(first), k1.as_py()), k2[first], pos[first], n, s1[first], s2[first], at[first])
            if out.n > 100_000:
                yield out.batch()
        yield out.batch()


def _source_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with spans wanted (k2, start, n) -> the digest of the words at each in the
    text of that key."""
    for b in batches:
        rows = []
        for k1, k2, t, wanted in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).cast(pa.binary()), b.column(4)):
            words = t.as_py().split()
            for w in wanted.as_py():
                at, n = w["start"], w["n"]
                if w["k2"] == k2:
                    rows.append((k1, k2, at, n, _digest(words[at : at + n])))
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["s1", "s2", "s_start", "n", "d"]
        )


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with copies and spans -> what is left of the text."""
    for b in batches:
        n_words, n_removed, kept = [], [], []
        for k2, t, copies, spans in zip(b.column(2), b.column(3).cast(pa.binary()), b.column(4), b.column(5)):
            words = t.as_py().split()
            gone = np.full(len(words), _is_copy(k2, copies))
            for s in spans.as_py() or ():
                part = slice(s["start"], s["start"] + s["n"])
                if s["k2"] == k2.as_py() and _digest(words[part]) == s["d"]:
                    gone[part] = True
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "text"],
        )


def drop_repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, text)``, a row per document row: the words left,
    joined by one space.  A word goes if it lies in a window of 13 words of its
    document that also starts in a document with a smaller doc_id, judged on the
    input.  Null texts and texts without words come back empty; under 13 words
    nothing goes; rows under one doc_id do not remove each other; a null id
    neither loses words nor takes any.  Other columns are ignored."""
    k1, k2 = row_key()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.coalesce("text", F.lit("")).alias("text")
    )
    named = F.col("doc_id").isNotNull()
    whole = saved(
        rows.where(named).select("k1", "k2", "text").mapInArrow(_whole, "k1 long, k2 long, d binary"), "whole-texts"
    )
    firsts = whole.groupBy("d").agg(F.min("k1").alias("first"), F.max("k1").alias("last")).where("first < last")
    firsts = saved(firsts.select("d", "first"), "first-copies")
    copies = saved(whole.join(firsts, "d").where("k1 > first").groupBy("k1").agg(F.collect_set("k2").alias("copies")), "copies")

    # One plan from here on, so that one shuffle of the texts by k1 serves the
    # joins with edges, sources and results.
    under = rows.join(copies, "k1", "left").select(*rows.columns, "copies")
    under = under.mapInArrow(_minimizer_rows, "m long, salt int, k1 long")
    under = under.withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("m", "salt")))
    on_shared = under.where("k1 is not null and (salt <> 0 or holders > 1)")
    on_shared = on_shared.groupBy("k1").agg(F.collect_list("m").alias("shared"))  # of one document
    edges = rows.join(on_shared, "k1").select(*rows.columns, "shared").mapInArrow(_edge_rows, _EDGE)
    first = F.min(F.struct("k1", "k2", "pos")).over(Window.partitionBy("h", "salt"))
    later = edges.withColumn("s", F.coalesce("source", first)).where("k1 > s.k1")
    stands = F.struct("k2", "pos", F.col("s.k1").alias("s1"), F.col("s.k2").alias("s2"), F.col("s.pos").alias("at"))
    # of one document, so no longer than its words
    spans = later.groupBy("k1").agg(F.collect_list(stands).alias("edges")).mapInArrow(_path_rows, _SPAN)
    at = ["s1", "s2", "s_start", "n"]
    wanted = spans.select(*at).distinct().groupBy(F.col("s1").alias("k1")).agg(
        F.collect_list(F.struct(F.col("s2").alias("k2"), F.col("s_start").alias("start"), "n")).alias("wanted")
    )
    sources = rows.join(wanted, "k1").select(*rows.columns, "wanted").mapInArrow(
        _source_rows, "s1 long, s2 long, s_start int, n int, d binary"
    )
    checked = spans.join(sources, at).groupBy("k1").agg(F.collect_list(F.struct("k2", "start", "n", "d")).alias("spans"))
    result = rows.join(checked, "k1", "left").join(copies, "k1", "left").select(*rows.columns, "copies", "spans")
    return result.mapInArrow(_kept_rows, "doc_id long, n_words long, n_removed long, text string")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = drop_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS pos,
         unnest([array_to_string(ws[i:i + 12], ' ') for i in range(1, len(ws) - 11)]) AS w FROM words),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM windows JOIN firsts USING (w) WHERE doc_id > first),
lost AS (SELECT doc_id, list(pos) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string([ws[i] for i in range(1, len(ws) + 1) if NOT coalesce(list_contains(ps, i), false)], ' ')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id)
"""
