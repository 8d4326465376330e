"""Benchmark decontamination: size-partitioned MinHash containment search.
DataFrame functions only.

Benchmark items are dealt into partitions by their number of different shingles
q (powers of two).  If a document holds 0.8 of an item's shingles, at most 0.2 q
are missing, so of any floor(0.2 q) + 1 of them one is in the document: each
partition keeps that many of the smallest shingle hashes of its items, taken for
the partition's largest q.  These MinHashes find every item that a document of
any length can contain (a document too short for a partition's smallest item
does not probe it); exact shingles then settle each pair found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import fresh, let, row_key, saved, table

SHINGLE_WORDS = 5
CONTAINMENT = 0.8

# Between words: ASCII blanks and punctuation, the same in Java and RE2.
_BETWEEN = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def words(text: Column) -> Column:
    """Lower-cased words without ASCII punctuation; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN, -1), lambda w: w != F.lit(""))


def shingles(ws: Column, width: int) -> Column:
    """All runs of ``width`` words, space-joined, repeats included."""

    def of(w: Column) -> Column:
        last = F.size(w) - width
        runs = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.concat_ws(" ", *(F.get(w, i + j) for j in range(width))),
        )
        return F.when(last < 0, F.array().cast("array<string>")).otherwise(runs)

    return let(ws, of)


def shingle_hashes(ws: Column, width: int) -> Column:
    def of(w: Column) -> Column:
        last = F.size(w) - width
        runs = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width))),
        )
        return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(runs)

    return let(ws, of)


def items(benchmark: DataFrame) -> DataFrame:
    """``(item_id, width, q, shingles)`` per different (item_id, text).  An item under
    five words is one shingle of all its words; one without words is left out."""
    rows = benchmark.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0).distinct()
    width = F.least(F.size("ws"), F.lit(SHINGLE_WORDS))
    found = F.lit(None).cast("array<string>")
    for n in range(1, SHINGLE_WORDS + 1):
        found = F.when(width == n, shingles(F.col("ws"), n)).otherwise(found)
    return rows.select("item_id", width.alias("width"), F.array_distinct(found).alias("shingles")).withColumn(
        "q", F.size("shingles")
    )


def _minhashes(known: DataFrame) -> DataFrame:
    """``(h, item_id, width, least)``: the partition's share of smallest hashes of
    each item, with the fewest shingles a document needs to probe it."""
    part = F.floor(F.log2("q")).cast("int")
    ratio = round((1 - CONTAINMENT) * 100)
    hashed = known.withColumn("part", part).withColumn(
        # the words of a shingle again, so that the hash is the one of shingle_hashes
        "hs",
        F.transform("shingles", lambda s: _hash_of(F.split(s, " "))),
    )
    most = F.pow(2.0, F.col("part") + 1) - 1
    keep = F.floor(most * ratio / 100).cast("int") + 1
    least = F.ceil(F.pow(2.0, F.col("part")) * (100 - ratio) / 100).cast("int")
    return hashed.select(
        "item_id", "width", least.alias("least"), F.explode(F.slice(F.sort_array("hs"), 1, keep)).alias("h")
    )


def _hash_of(ws: Column) -> Column:
    out = F.lit(None).cast("bigint")
    for n in range(1, SHINGLE_WORDS + 1):
        out = F.when(F.size(ws) == n, F.xxhash64(*(F.get(ws, F.lit(j)) for j in range(n)))).otherwise(out)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(k1, k2, doc_id, item_id, n_item, n_shared)``: every document and item with at
    least 0.8 of the item's different shingles in the document.  Null texts hold
    nothing; equal document rows give equal pairs once; no items give no rows."""
    known = saved(items(benchmark), "benchmark-items")
    probes = saved(_minhashes(known), "benchmark-minhashes")
    widths = [r[0] for r in known.select("width").distinct().collect()]  # 1 to 5
    rows = docs.select(
        *(c.alias(n) for c, n in zip(row_key(), ("k1", "k2"))), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    hashed = rows.select("k1", "k2", words(F.col("text")).alias("ws"))
    found = None
    for width in widths:
        held = hashed.select("k1", "k2", shingle_hashes(F.col("ws"), width).alias("hs"))
        held = held.select("k1", "k2", F.size("hs").alias("n"), F.explode("hs").alias("h"))
        near = probes.where(F.col("width") == width).select("h", "item_id", "least")
        hit = held.join(near, "h").where("n >= least").select("k1", "k2", "item_id")
        found = hit if found is None else found.unionAll(hit)
    if found is None:
        found = rows.join(known, F.lit(False)).select("k1", "k2", "item_id")
    candidates = saved(found.distinct(), "contamination-candidates")
    pairs = rows.join(candidates.withColumnRenamed("item_id", "found"), ["k1", "k2"])
    pairs = pairs.join(known, F.col("found").eqNullSafe(F.col("item_id")))  # an item may have no id
    in_doc = F.lit(None).cast("array<string>")
    for n in widths:
        in_doc = F.when(F.col("width") == n, shingles(words(F.col("text")), n)).otherwise(in_doc)
    shared = F.size(F.array_intersect("shingles", in_doc))
    checked = pairs.select("k1", "k2", "doc_id", "item_id", F.col("q").alias("n_item"), shared.alias("n_shared"))
    ratio = round(CONTAINMENT * 100)
    return checked.where(F.col("n_shared") * 100 >= F.col("n_item") * ratio).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item; columns stay as they are."""
    k1, k2 = fresh(docs.columns, "k1", "k2")
    gone = contaminated(docs, benchmark).select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    rows = docs.withColumns(dict(zip((k1, k2), row_key())))
    return rows.join(gone, [k1, k2], "left_anti").drop(k1, k2)


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contaminated(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )
    return found.select(
        "doc_id",
        "item_id",
        F.col("n_item").cast("long").alias("n_item"),
        F.col("n_shared").cast("long").alias("n_shared"),
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


OP7_SQL = r"""
WITH item_words AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+'),
    lambda w: w <> '') AS ws FROM benchmark WHERE text IS NOT NULL),
item_shingles AS (
  SELECT item_id, ws, least(len(ws), 5) AS width, unnest(list_distinct([array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ')
    for i in range(1, len(ws) - least(len(ws), 5) + 2)])) AS s FROM item_words WHERE len(ws) > 0),
sizes AS (SELECT item_id, ws, count(*) AS n_item FROM item_shingles GROUP BY item_id, ws),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+'),
    lambda w: w <> '') AS ws FROM documents WHERE text IS NOT NULL),
doc_shingles AS (
  SELECT DISTINCT doc_id, width, unnest([array_to_string(ws[i:i + width - 1], ' ') for i in range(1, len(ws) - width + 2)]) AS s
  FROM doc_words, (SELECT DISTINCT width FROM item_shingles)),
shared AS (
  SELECT doc_id, item_id, i.ws, count(*) AS n_shared FROM doc_shingles d JOIN item_shingles i USING (width, s) GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM shared JOIN sizes USING (item_id, ws) WHERE n_shared * 100 >= n_item * 80
"""
