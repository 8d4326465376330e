"""Document fingerprints from closed syncmers.  DataFrame functions only.

A k-mer of K words is an anchor if the smallest hash of its inner S-word pieces
is that of its first or last piece.  The choice looks at nothing outside the
k-mer, so a passage keeps its anchors wherever it stands.  A fingerprint is the
``SIZE`` smallest anchor hashes of the text, each with the word at which it
first stands; likeness compares hashes, equal positions show unmoved passages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import let, saved, table, words_of

K = 5
S = 2
SIZE = 64
_BITS = 8  # documents are dealt in blocks of 2^8 neighbouring ids


def anchor_hashes(text: Column) -> Column:
    """Hashes of the anchors of a text in order, repeats included.  A text with
    words but without an anchor (as under K words) has one, the hash of its whole
    word sequence; without words it has none."""

    def of(words: Column) -> Column:
        def with_words(h: Column) -> Column:
            pieces = F.transform(_upto(F.size(h) - S), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))
            return let(pieces, lambda m: closed(h, m))

        whole = F.array(F.xxhash64(F.array_join(words, " ")))
        found = F.when(F.size(words) >= K, let(F.transform(words, lambda w: F.xxhash64(w)), with_words))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(
            let(found, lambda a: F.when(F.size(a) > 0, a).otherwise(whole))
        )

    def closed(h: Column, m: Column) -> Column:
        last = K - S
        at_edge = F.filter(
            _upto(F.size(h) - K),
            lambda i: F.least(*(F.get(m, i + j) for j in range(last + 1)))
            == F.least(F.get(m, i), F.get(m, i + last)),
        )
        return F.transform(at_edge, lambda i: F.xxhash64(F.get(m, i), F.get(m, i + 2), F.get(h, i + 4)))

    return let(words_of(F.lower(text)), of)


def _upto(last: Column) -> Column:
    return F.sequence(F.lit(0), last)


def sketch(anchors: Column) -> Column:
    """The ``SIZE`` smallest different hashes, rising, with the (anchor) index of
    the first stand of each: array of (hash, at)."""
    low = F.slice(F.sort_array(F.array_distinct(anchors)), 1, SIZE)
    return F.transform(low, lambda h: F.struct(h.alias("hash"), (F.array_position(anchors, h) - 1).alias("at")))


def as_text(sketched: Column) -> Column:
    """``hash:position`` of every anchor (hash as 16 hex digits), space-joined."""
    return F.array_join(
        F.transform(sketched, lambda a: F.concat(F.lower(F.lpad(F.hex(a.hash), 16, "0")), F.lit(":"), a.at.cast("string"))),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard of two sketches' anchor sets, 0 to 1: of the smallest
    hashes of both together, the share that both hold.  Two empty ones: 1."""

    def of(x: Column, y: Column, low: Column) -> Column:
        both = F.array_intersect(F.array_intersect(x, y), low)
        return F.when(F.size(low) == 0, 1.0).otherwise(F.size(both) / F.size(low))

    def with_hashes(x: Column, y: Column) -> Column:
        return let(F.slice(F.sort_array(F.array_union(x, y)), 1, SIZE), lambda low: of(x, y, low))

    return let(a["hash"], lambda x: let(b["hash"], lambda y: with_hashes(x, y)))


def aligned(a: Column, b: Column) -> Column:
    """How many anchors two sketches share at the same position."""
    return F.size(F.array_intersect(a, b)).cast("long")


def _followers(blocks: DataFrame, low: int, high: int) -> DataFrame:
    """``blocks(b, head)`` -> ``(b, follows)``: the head of the next lower block,
    null for the lowest.  Blocks are compared within groups of 2^_BITS and the
    groups the same way one level up, so no window holds more than that."""
    group = F.shiftright("b", _BITS)
    near = blocks.withColumn("g", group).withColumn(
        "near", F.lead("head").over(Window.partitionBy("g").orderBy(F.desc("b")))
    )
    if low >> _BITS == high >> _BITS:
        return near.select("b", F.col("near").alias("follows"))
    groups = blocks.groupBy(group.alias("b")).agg(F.max("head").alias("head"))
    above = _followers(groups, low >> _BITS, high >> _BITS).select(F.col("b").alias("g"), F.col("follows").alias("far"))
    return near.join(above, "g", "left").select("b", F.coalesce("near", "far").alias("follows"))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(b, own, at, doc_id, text, next_text)`` with own
    true, and of each block the document after its last once more (own false).
    Descending doc_id, then text; the last is followed by the first; a null id
    counts as the smallest; a single document follows itself.  The text is
    shuffled once, in blocks of neighbouring ids; what follows a block is found
    on ids alone.  One doc_id should not repeat without bound: its rows are
    sorted in one task."""
    lowest = F.lit(-(2**63))
    at = F.coalesce(F.col("doc_id").cast("long"), lowest)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), at.alias("at"))
    # the sign bit turned, ids of either sign are in order as unsigned numbers
    rows = rows.withColumn("b", F.shiftrightunsigned(F.col("at").bitwiseXOR(lowest), _BITS))
    blocks = rows.groupBy("b").agg(F.max("at").alias("head"))
    low, high, first = blocks.agg(F.min("b"), F.max("b"), F.max("head")).first()
    if first is None:
        low = high = first = 0
    follows = _followers(blocks, low, high).select(
        F.col("b").alias("to"), F.coalesce("follows", F.lit(first).cast("long")).alias("at")
    )
    # written, so its size is known when Spark chooses how to join
    carried = rows.join(saved(follows, "block-followers"), "at")
    both = rows.select("b", F.lit(True).alias("own"), "at", "doc_id", "text").unionAll(
        carried.select("to", F.lit(False), "at", "doc_id", "text")
    )
    return both.withColumn("next_text", F.lead("text").over(_order()))


def _order():
    return Window.partitionBy("b").orderBy(F.desc("own"), F.desc("at"), F.desc("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per document row: its fingerprint, that of its edited text (the second
    half replaced by the start of the next document), and the likeness to both
    the edited text and the next document.  Null texts are empty; equal texts
    have equal fingerprints; other columns are ignored; no rows give none."""
    rows = with_next(docs)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.char_length("text") - half),
        F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    rows = rows.withColumn("edited", F.when(F.col("own"), edited)).withColumn("n_chars", F.char_length("text").cast("long"))
    sketched = rows.select(
        "b", "own", "at", "doc_id", "text", "n_chars", "edited",
        let(anchor_hashes(F.col("text")), sketch).alias("print"),
        F.when(F.col("own"), let(anchor_hashes(F.col("edited")), sketch)).alias("edited_print"),
    )
    placed = sketched.withColumn("next_print", F.lead("print").over(_order())).where("own")
    return placed.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
        aligned(F.col("print"), F.col("edited_print")).alias("aligned_edited"),
    )


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
