"""Periodic runs against brute force."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rivulet.llm import common, queries, runs
from tests.llm.conftest import rows


def brute(words: list, min_words: int = 24, min_power: int = 3) -> list[tuple[int, int, int]]:
    n, out = len(words), []
    for q in range(1, n // min_power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, length = i, j - i + q
            if j > i and length >= max(min_words, min_power * q):
                if not any(all(words[x] == words[x + r] for x in range(s, s + length - r)) for r in range(1, q)):
                    out.append((s, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def edit(doc_id, words: list) -> list:
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(words: list, found: list) -> tuple:
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (
        len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


@pytest.mark.parametrize("least,power", [(24, 3), (4, 2), (2, 2), (9, 4)])
def test_runs_match_brute_force(least, power):
    r = random.Random(least)
    texts = [b"", b"a", b"a a", b"a " * 23, b"a " * 24, b"a b " * 12, b"a b " * 11 + b"a", b"a b c d e f g h " * 3 + b"a"]
    for _ in range(120):
        t: list[str] = []
        while len(t) < r.randrange(1, 120):
            block = [r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randrange(1, 12))]
            times = r.choice((1, 1, 3, 5))
            t += (block * times)[: len(block) * times - r.randrange(0, len(block))]
        texts.append(" ".join(t).encode())
    split = [t.split() for t in texts]
    got = runs.text_runs(split, least, power)
    for i, words in enumerate(split):
        assert ([tuple(x) for x in got[i].tolist()] if i in got else []) == brute(words, least, power), texts[i]


def test_long_texts():
    """Linear nestings (one word over and over) and deep blocks stay near-linear."""
    began = time.time()
    ones = [b"w"] * 1_000_000
    block = [b"%d" % i for i in range(50_000)]
    got = runs.text_runs([ones, block * 4, block])
    assert got[0].tolist() == [[0, 1_000_000, 1]] and got[1].tolist() == [[0, 200_000, 50_000]] and 2 not in got
    assert time.time() - began < 60


def test_edge_rows(spark, docs, clashing, empty):
    tandem = " ".join(["x y z"] * 9)
    extra = spark.createDataFrame([(70, tandem), (70, tandem), (71, "é b " * 30)], "doc_id long, text string")
    got = runs.periodic_runs(docs.select("doc_id", "text").unionAll(extra)).collect()
    assert len(got) == len(rows()) + 3
    assert [r.runs for r in got if r.doc_id == 70] == [[(0, 27, 3)]] * 2
    assert {r.collapsed for r in got if r.doc_id == 70} == {"x y z"}
    assert [r.runs for r in got if r.doc_id == 71] == [[(0, 30, 1)]]  # a no-break space is no separator
    for r in got:
        if r.doc_id in (8, 10, 20):
            assert (r.n_words, r.runs, r.strongest, r.collapsed) == (0, [], None, "")
    assert runs.periodic_runs(clashing).count() == len(rows()) and runs.periodic_runs(empty).count() == 0


def test_query_matches_brute_force(spark, sf_small):
    docs = common.table(spark, sf_small, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_runs"](spark, sf_small).collect()}
    assert len(got) == len(docs)
    seen = 0
    for r in docs:
        words = edit(r.doc_id, (r.text or "").encode().split())
        if len(words) <= 900:  # brute force takes a while
            assert got[r.doc_id] == expected(words, brute(words)), r.doc_id
            seen += got[r.doc_id][0]
    assert seen >= 10


def test_query_edge_ids(spark):
    frame = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60))) for i in [None, *range(40)]] + [(9, None), (9, " \n")], "doc_id long, text string")
    edited = frame.select("doc_id", "text", runs.with_planted_run(F.col("doc_id"), F.col("text")).alias("e")).collect()
    for r in edited:
        assert (r.e or "").split() == [w for w in edit(r.doc_id, (r.text or "").split())]
