"""Periodic runs of words: a passage said three times or more in a row.

A run is a stretch of words with smallest period q and a length of at least
``max(min_words, min_power * q)`` that no neighbouring word extends.  Every run
ends in one branching square: two equal blocks of q words followed by different
words (or the end).  Such a square is a pair of suffixes q apart whose longest
common prefix is exactly q, so both stand in one LCP interval of depth q and in
different children of it.  An enhanced suffix array (suffix array, its inverse
ISA, LCP) of the word numbers finds them without a tree: every LCP position
splits an interval, the suffixes p of its smaller side look up ISA[p + depth]
and ISA[p - depth] in the other side (n log n look-ups in all), squares are
rotated to the left as far as their words allow, and stretches found under a
multiple of their period merge into the run with the smallest one.

Texts are independent, so Spark deals them out and nothing is shuffled.  Within
a task many short texts share one array; a text whose windows of half a run
are all different has no run and needs no array.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import let, table, words_of

MIN_WORDS = 24
MIN_POWER = 3
_GROUP_WORDS = 1 << 18  # words of the texts that are worked on at once
_LOOKUPS = 1 << 20  # suffixes of smaller sides that are looked up at once
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

RUNS_SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "strongest struct<start: long, length: long, period: long>, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


# --------------------------------------------------------------- suffix array
def _heads(new: np.ndarray) -> np.ndarray:
    """Index of the last True up to each place."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def suffix_ranks(codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of the blocks of 1, 2, 4, ... words at every place (cut at the text's
    end) until all differ; the last is the inverse suffix array.  No code stands
    in two texts.  Blocks of equal rank are whole and equal."""
    n = len(codes)
    at = np.argsort(codes, kind="stable")
    key = codes[at]
    rank = np.zeros(n, np.int64)
    new = np.r_[True, key[1:] != key[:-1]]
    rank[at] = _heads(new)
    levels, width = [rank.astype(np.int32)], 1
    single = new & np.r_[new[1:], True]
    at = at[~single]  # places that share their rank, in order of it
    while len(at):
        follow = at + width
        second = np.where(follow < ends[at], rank[np.minimum(follow, n - 1)] + 1, 0)
        at = at[np.argsort(rank[at] * np.int64(n + 1) + second, kind="stable")]
        follow = at + width
        second = np.where(follow < ends[at], rank[np.minimum(follow, n - 1)] + 1, 0)
        old = rank[at]
        group = np.r_[True, old[1:] != old[:-1]]
        new = group | np.r_[True, second[1:] != second[:-1]]
        rank[at] = old + _heads(new) - _heads(group)
        levels.append(rank.astype(np.int32))
        at = at[~(new & np.r_[new[1:], True])]
        width *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
    """Words that the texts at a and b share, onwards or (``back``) before them;
    ``limit`` is the text's end or start."""
    a, b = a.copy(), b.copy()
    begun = a.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        x, y = (a - step, b - step) if back else (a, b)
        fits = np.minimum(x, y) >= limit if back else np.maximum(x, y) + step <= limit
        fits &= levels[k][np.where(fits, x, 0)] == levels[k][np.where(fits, y, 0)]
        move = np.where(fits, -step if back else step, 0)
        a += move
        b += move
    return np.abs(a - begun)


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place of the LCP array the nearest smaller one before it, and the nearest
    not larger one behind it; the first and last entry are -1."""
    before, behind = [0] * len(lcp), [len(lcp) - 1] * len(lcp)
    values, stack = lcp.tolist(), []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] >= v:
            behind[stack.pop()] = i
        before[i] = stack[-1] if stack else 0
        stack.append(i)
    return np.array(before, np.int64), np.array(behind, np.int64)


def squares(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Branching squares of the texts laid end to end: first word, half length and
    how far each can be rotated to the left.  ``starts``/``ends``: per word, of its text."""
    levels = suffix_ranks(codes, ends)
    n, isa = len(codes), levels[-1].astype(np.int64)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    lcp = np.full(n + 1, -1, np.int64)
    a, b = sa[:-1], sa[1:]
    same = ends[a] == ends[b]
    lcp[1:n] = np.where(same, _common(levels, a, b, np.minimum(ends[a], ends[b]), back=False), 0)
    before, behind = _sides(lcp)
    at = np.nonzero(lcp > 0)[0]
    left_smaller = at - before[at] <= behind[at] - at
    low = np.where(left_smaller, before[at], at)
    size = np.where(left_smaller, at, behind[at]) - low
    other_low = np.where(left_smaller, at, before[at])
    other_high = np.where(left_smaller, behind[at], at)
    depth = lcp[at]
    total = np.cumsum(size)
    cut = 0
    while cut < len(at):
        upto = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + _LOOKUPS, side="right")))
        part = slice(cut, upto)
        node = np.repeat(np.arange(cut, upto), size[part])
        inner = np.arange(len(node)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
        p, d = sa[low[node] + inner], depth[node]
        found, half = [], []
        for q, first in ((p + d, p), (p - d, p - d)):
            there = isa[np.clip(q, 0, n - 1)]
            hit = (q >= 0) & (q < n) & (there >= other_low[node]) & (there < other_high[node])
            found.append(first[hit])
            half.append(d[hit])
        first, d = np.concatenate(found), np.concatenate(half)
        if len(first):
            yield first, d, _common(levels, first, first + d, starts[first], back=True)
        cut = upto


def find_runs(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_words: int, min_power: int) -> np.ndarray:
    """``(first word, length, period)`` of every run, by first word, then period."""
    kept = [np.zeros((0, 3), np.int64)]
    for first, d, back in squares(codes, starts, ends):
        length = 2 * d + back
        good = length >= np.maximum(min_words, min_power * d)
        kept.append(np.stack([(first - back)[good], length[good], d[good]], axis=1))
    rows = np.concatenate(kept)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # one stretch under several periods: they are multiples of the smallest
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


# ---------------------------------------------------------------------- texts
@lru_cache
def _window(min_words: int, min_power: int) -> int:
    """Words that stand twice in every text with a run (a run of period q holds a
    block of its length less q twice), as a power of two."""
    least = min(max(min_words - q, (min_power - 1) * q) for q in range(1, min_words + 1))
    return 1 << (max(least, 1).bit_length() - 1)


def _suspects(texts: list[list[bytes]], window: int) -> list[int]:
    """The texts in which some window of words stands twice (by hash: a few others too)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, int(size.sum())).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)
    fits = (np.arange(len(h)) + window) <= np.cumsum(size)[owner]
    width, level = 1, 0
    while width < window:
        h = h ^ (h >> np.uint64(29))
        h = h[:-width] * _ODD[level % 4] + h[width:]
        width, level = width * 2, level + 1
    fits = np.nonzero(fits[: len(h)])[0]
    h = (h[fits] ^ (h[fits] >> np.uint64(31))) * _ODD[0] + owner[fits].astype(np.uint64) * _ODD[1]
    order = np.argsort(h)
    twice = order[1:][h[order[1:]] == h[order[:-1]]]
    return np.unique(owner[fits[twice]]).tolist()


def text_runs(texts: list[list[bytes]], min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> dict[int, np.ndarray]:
    """Per text (a list of words) that has any, its runs ``(start, length, period)``."""
    some = _suspects(texts, _window(min_words, min_power))
    out: dict[int, np.ndarray] = {}
    if not some:
        return out
    numbers: dict[bytes, int] = {}
    codes, sizes = [], []
    for i in some:
        numbers.clear()  # words are numbered anew, behind those of the texts before
        base = codes[-1].max(initial=-1) + 1 if codes else 0
        codes.append(base + np.fromiter((numbers.setdefault(w, len(numbers)) for w in texts[i]), np.int64, len(texts[i])))
        sizes.append(len(texts[i]))
    end = np.cumsum(sizes)
    start = end - sizes
    rows = find_runs(np.concatenate(codes), np.repeat(start, sizes), np.repeat(end, sizes), min_words, min_power)
    owner = np.searchsorted(end, rows[:, 0], side="right")
    rows[:, 0] -= start[owner]
    for k in np.unique(owner):
        out[some[k]] = rows[owner == k]
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words outside of all runs and in the first period of some, without those
    behind the first period of any."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _rows(min_words: int, min_power: int):
    def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = text_runs(texts, min_words, min_power)
        runs = [list(map(tuple, found[i].tolist())) if i in found else [] for i in range(len(texts))]
        left = [b" ".join(collapse(w, found[i]) if i in found else w) for i, w in enumerate(texts)]
        named = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
        best = [_strongest(own) for own in runs]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(named, pa.list_(_RUN)),
                pa.array([r and dict(zip(("start", "length", "period"), r)) for r in best], _RUN),
                pa.array(left, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "runs", "strongest", "collapsed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                ids.append(i.as_py())
                texts.append((t.as_py() or "").encode().split())
                held += len(texts[-1])
                if held >= _GROUP_WORDS or len(texts) >= 10_000:
                    yield done(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield done(ids, texts)

    return run


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> DataFrame:
    """Per document row ``(doc_id, n_words, runs, strongest, collapsed)``: its runs by start,
    then period; the run with the greatest length per period (ties: smallest start,
    then period); and the text without what runs repeat, its words joined by one
    space.  Words stand between ``[\\x20\\x09-\\x0D]``.

    A null or blank text has no words, no runs, a null ``strongest`` and an empty
    ``collapsed``; null and repeated ids stay rows of their own; other columns of
    ``docs`` are not read; an empty table gives no rows.  A text is worked on whole:
    memory grows with the longest one (about 200 bytes a word).  ``min_power`` is
    2 at least."""
    if min_power < 2 or min_words < 2:
        raise ValueError("a run has two periods and two words at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_rows(min_words, min_power), RUNS_SCHEMA)


# ---------------------------------------------------------------------- query
def with_planted_run(doc_id: Column, text: Column) -> Column:
    """The text as the query wants it: of every tenth id (by crc32) the words from a
    place on are overwritten by repeats of the p words at that place."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def edited(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = let((g % n).cast("int"), lambda a: F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p")))
        return let(
            a,
            lambda s: F.array_join(
                F.concat(
                    F.slice(w, F.lit(1), s["a"]),
                    F.transform(F.sequence(F.lit(0), (n - s["a"] - 1).cast("int")), lambda i: F.get(w, s["a"] + i % s["p"])),
                ),
                " ",
            ),
        )

    blank = F.coalesce(text, F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
    return F.when((h % 10 == 0) & ~blank, let(words_of(text), edited)).otherwise(text)


def op11_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", with_planted_run(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
