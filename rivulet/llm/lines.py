"""Line dedup: explode normalised lines, hash them, find the hashes that several
documents hold, drop those lines everywhere but in the first holder, and put
the rest together again by position."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import fresh, row_key, saved, table

MIN_CHARS = 10
MIN_DOCS = 2
_BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z lowered (UTF-8 in and out)."""
    return line.strip(_BLANKS).lower()


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            k1, k2, ids = (b.column(i).to_pylist() for i in range(3))
            texts = b.column(3).cast(pa.binary())
            out: list[list] = [[], [], [], [], []]
            for i, t in enumerate(texts):
                at: dict[bytes, list[int]] = {}
                for pos, line in enumerate((t.as_py() or b"").split(b"\n")):
                    key = line_key(line)
                    # four bytes a code point at most: long keys need no count
                    if len(key) >= 4 * min_chars or (len(key) >= min_chars and len(key.decode()) >= min_chars):
                        at.setdefault(digest(key), []).append(pos)
                for column, values in zip(out, (at, [k1[i]] * len(at), [k2[i]] * len(at), [ids[i]] * len(at), at.values())):
                    column.extend(values)
                if len(out[0]) >= 50_000:
                    yield _batch(out)
                    out = [[], [], [], [], []]
            yield _batch(out)

    return run


def _batch(out: list[list]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(out, kinds)], ["h", "k1", "k2", "doc_id", "pos"]
    )


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(k1, k2, drop)``: per document row, the positions (from 0) of the lines
    to drop; rows without any are absent."""
    rows = docs.select(
        *(c.alias(n) for c, n in zip(row_key(), ("k1", "k2"))), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    held = rows.mapInArrow(_keys(min_chars), "h binary, k1 long, k2 long, doc_id long, pos array<int>")
    if min_docs == 2:  # two holders: the smallest and the largest id differ
        shared = held.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    else:
        shared = held.groupBy("h").agg(F.min("doc_id").alias("first"), F.count_distinct("doc_id").alias("n")).where(
            F.col("n") >= min_docs
        )
    # written: of a plain scan Spark knows the size, and can split a hot line over tasks
    again = held.join(saved(shared.select("h", "first"), "shared-lines"), "h").where("doc_id > first")
    # of one document row: at most its own lines.  Equal rows give equal lists, which meet
    # in a set, in every task before the shuffle.
    return again.groupBy("k1", "k2").agg(F.array_distinct(F.flatten(F.collect_set("pos"))).alias("drop"))


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines that stay, and the columns ``counts``
    added: lines before, and dropped (an own column of such a name is replaced).  A text is
    split at newlines; null and empty texts are one empty line and come back
    empty.  Keys under ``min_chars`` code points never count.  Several rows under
    one doc_id are one holder; a null id holds nothing and loses nothing."""
    n_lines, n_dropped = counts
    names = fresh([*docs.columns, *counts], "k1", "k2", "drop", "lines", "keep")
    k1, k2, drop, lines, keep = names
    cut = repeated_lines(docs, min_chars, min_docs).toDF(k1, k2, drop)
    rows = docs.drop(*counts).withColumns(dict(zip((k1, k2), row_key()))).join(cut, [k1, k2], "left")
    all_but = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(drop, F.array().cast("array<int>")))
    kept = F.array_join(F.expr(_at(lines, keep)), "\n")  # linear in the lines, like array_except
    return (
        rows.withColumn(lines, F.split(F.coalesce("text", F.lit("")), "\n", -1))
        .withColumn(keep, all_but)
        .withColumn(n_lines, F.size(lines).cast("long"))
        .withColumn(n_dropped, (F.size(lines) - F.size(keep)).cast("long"))
        .withColumn("text", F.when(F.col(n_dropped) == 0, F.coalesce("text", F.lit(""))).otherwise(kept))
        .drop(*names)
    )


def _at(lines: str, keep: str) -> str:
    return f"transform(array(`{lines}`), l -> transform(`{keep}`, i -> l[i]))[0]"


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, pos, line, coalesce(keyed.doc_id > first, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
