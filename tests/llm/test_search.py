"""Ranked lexical search against its SQL and plain scoring."""

import math
import random
import re
from collections import Counter

import numpy as np

from rivulet.llm import queries, search
from tests.llm.conftest import prose
from tests.oracle_check import compare

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs: list[tuple], items: list[tuple], k: int = 10) -> set:
    vectors = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, v) for i, v in vectors if v]
    n, total = len(held), sum(sum(v.values()) for _, v in held)
    df = Counter(w for _, v in held for w in v)
    out = set()
    for item_id, text in set(items):
        found = []
        for doc_id, v in held:
            m = 25 + 75 * sum(v.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * v[w] // (1000 * v[w] + 8 * m)) for w in plain_terms(text) if v[w])
            if s > 0:
                found.append((-s, doc_id is None, doc_id))
        found.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out |= {(item_id, text, rank, r[2], -r[0]) for rank, r in enumerate(found[:k], 1)}
    return out


def test_query_matches_sql(spark, sf_small, sf_oracle):
    for sf in (sf_small, sf_oracle):
        ok, msg = compare(spark, sf, "op12_ranked_search", queries.QUERIES["op12_ranked_search"], search.OP12_SQL)
        assert ok, msg


def test_terms():
    for text in ("A-b_c1 É.é x 你好!!", "", None, "\x00a\x7fB~c`d{e", "\U0001f600 Ünï 3.14"):
        assert [w.decode() for w in search.terms(text)] == plain_terms(text)


def test_ranked_matches_plain_scoring(spark, docs, clashing, empty):
    items = [(1, prose(1, 12)), (2, prose(2, 5) + " " + prose(2, 5)), (2, prose(3, 8)), (None, "kara LOdu"), (3, None), (4, " !! "), (5, "zzz"), (1, prose(1, 12)), (6, "x" * 5000)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    own = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((i, rank, d, s) for i, _, rank, d, s in plain(own, items)), key=str)
    for block in (search.BLOCK_CHARS, 40):
        got = sorted((tuple(r) for r in search.ranked(docs, asked, block_chars=block).collect()), key=str)
        assert got == want
    assert search.ranked(clashing, asked).count() == len(want)
    assert search.ranked(empty, asked).count() == 0
    assert search.ranked(docs, asked.limit(0)).count() == 0
    assert search.ranked(docs, asked, k=2).where("rank > 2").count() == 0


def _walk(node):
    yield node
    for child, _ in node.children:
        yield from _walk(child)


def test_bounds_and_pruning():
    """Every node's maxima and minima cover the vectors below it, nothing that could win
    is left out, and branch and bound enters a part of the tree only."""
    r = random.Random(5)
    words = 60
    rows = []
    for doc in range(800):
        path = sorted(r.sample(range(words), r.randrange(1, 9)), key=lambda x: x)
        rows.append((np.array(path), np.array([r.randrange(1, 5) for _ in path]), r.randrange(30, 300), (False, doc)))
    rows += [(*rows[0][:3], (False, 10_000 + i)) for i in range(50)]  # a group of copies
    paths, tfs, m, ids = search.distinct_vectors(rows, 3)
    assert max(map(len, ids)) == 3
    root = search.tree(paths, tfs, m)
    assert sorted(i for node in _walk(root) for i in node.rows) == list(range(len(paths)))
    weight = np.array([r.randrange(1, 5000) for _ in range(words)])[::-1].copy()
    asked = [{int(p): r.randrange(1, 3) for p in r.sample(range(words), 6)} for _ in range(20)]
    items, best = search.Items(asked, weight), search.Best(20, 3)
    entered = search.search(root, paths, tfs, m, ids, items, best)
    assert entered < sum(1 for _ in _walk(root))
    for i, item in enumerate(asked):
        scores = []
        for path, tf, norm, key in rows:
            s = sum(int(weight[p]) * item[int(p)] * int(search.part(int(c), norm)) for p, c in zip(path, tf) if int(p) in item)
            scores += [(-s, key)] if s else []
        assert best.rows[i] == sorted(scores)[:3]
