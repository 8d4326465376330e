"""Attention-based quality scores: gradients, plain evaluation, held-out accuracy, edge rows."""

import zlib
from dataclasses import asdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import common, quality, queries
from tests.llm.conftest import prose, rows


def plain_score(model: quality.Model, text) -> float:
    """One text, passage by passage, from the formulas."""
    words = (text or "").split() or [""]
    h, e = [], []
    for at in range(0, len(words), quality.PASSAGE):
        part = words[at : at + quality.PASSAGE]
        x = sum(model.vectors[r] for w in part for r in quality.word_rows(w)) / len(part)
        h.append(np.tanh(x @ model.enter + model.enter_bias))
        gate = np.tanh(h[-1] @ model.tanh_gate) / (1 + np.exp(-(h[-1] @ model.sigmoid_gate)))
        e.append(gate @ model.attend)
    a = np.exp(np.array(e) - max(e))
    z = sum(w * x for w, x in zip(a / a.sum(), h))
    return float(1 / (1 + np.exp(-(z @ model.out + model.out_bias[0]))))


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    model = quality.fresh_model(1)
    words = quality.Words()
    texts = [prose(1, 150), "One, two! THREE", "", prose(2, 70)]
    codes = [words.of(t) for t in texts]
    table_rows = np.array(words.rows)[np.concatenate(codes)]
    bags = quality.Bags.of(np.array([len(c) for c in codes]))
    truth = np.array([1.0, 0, 0, 1])
    _, grad = quality.gradients(model, table_rows, bags, truth)
    for name, g in grad.items():
        value = getattr(model, name)
        for _ in range(6):
            at = tuple(rng.integers(s) for s in value.shape)
            if name == "vectors":
                at = (int(table_rows[rng.integers(len(table_rows)), 0]), at[1])
            kept = value[at]
            value[at] = kept + 1e-5
            more = quality.gradients(model, table_rows, bags, truth)[0]
            value[at] = kept - 1e-5
            less = quality.gradients(model, table_rows, bags, truth)[0]
            value[at] = kept
            assert (more - less) / 2e-5 == pytest.approx(g[at], rel=1e-3, abs=1e-7)


def test_held_out_accuracy(spark, sf_oracle):
    got = queries.QUERIES["op13_quality"](spark, sf_oracle).cache()
    labels = common.table(spark, sf_oracle, "labels")
    docs = common.table(spark, sf_oracle, "documents")
    assert got.count() == docs.count()
    assert got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    assert not [r.doc_id for r in got.collect() if r.held_out != (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)]
    held = got.where("held_out").join(labels, "doc_id")
    assert held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95
    low, high = (held.where(f"quality = {q}").agg(F.avg("score")).first()[0] for q in (0, 1))
    assert low < 0.2 and high > 0.9


def test_one_bad_passage_is_found():
    """Labels are of documents; attention finds the passage that decides."""
    bad = " ".join(f"{w}%%%" for w in prose(50, 64).split())
    texts = []
    for i in range(240):
        passages = [prose(1000 + 10 * i + j, 64) for j in range(5)]
        if i % 2:
            passages[i % 5] = bad if i % 4 == 1 else " ".join(f"{w}%%%" for w in prose(3000 + i, 64).split())
        texts.append((" ".join(passages), 1 - i % 2))
    model = quality.train(texts[:200])
    words = quality.Words()
    hits = 0
    for i, (text, label) in enumerate(texts[200:], 200):
        codes = words.of(text)
        bags = quality.Bags.of(np.array([len(codes)]))
        means = np.add.reduceat(model.vectors[np.array(words.rows)[codes]].sum(axis=1), bags.word) / bags.size[:, None]
        p, a = model.scores(means, bags)
        assert (p[0] > 0.5) == bool(label)
        assert p[0] == pytest.approx(plain_score(model, text))
        hits += label == 0 and int(a.argmax()) == i % 5
    assert hits >= 18  # of 20


def test_scores_match_plain_evaluation(spark, docs):
    model = quality.train([(prose(i, 90) if i % 2 else f"{prose(i, 90).upper()}!!", i % 2) for i in range(60)] + [(None, 0)] * 4)
    want = sorted(plain_score(model, r.text) for r in docs.select("text").collect())
    got = quality.score(docs, model).collect()
    assert sorted(r.score for r in got) == pytest.approx(want, abs=1e-6)
    long = next(r for r in got if r.doc_id == 13 and r.n_passages > 1)
    assert long.n_passages == -(-4000 // quality.PASSAGE) and 0 <= long.top_passage < long.n_passages


def test_edge_rows(spark, docs, clashing, empty):
    labels = spark.createDataFrame(
        [(1, 1), (3, 1), (4, 1), (5, 1), (9, 0), (9, 0), (10, 0), (17, 0), (6, 0), (6, 1), (None, 1), (7, None), (8, 5), (99, 1), (15, 1)],
        "doc_id long, quality int",
    )
    picked = {(r.text, r.label) for r in quality.sample(docs, labels).collect()}
    assert len(picked) == 8 and (None, 0) in picked and ("12 34 !! ##", 0) in picked
    for frame in (docs, clashing):
        got = quality.score(frame, quality.learn(frame, labels)).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (8, 9, 10, 20)}) == 1
        assert len({r.score for r in got if r.doc_id == 15}) == 1
    nothing = quality.learn(docs, labels.limit(0))
    assert nothing.vectors is None and {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(empty, nothing).count() == 0 and quality.learn(empty, labels).vectors is None


def test_same_rows_same_model():
    texts = [(prose(i, 30), i % 2) for i in range(40)]
    a, b = quality.train(texts), quality.train(texts[::-1])
    assert all(np.array_equal(x, y) for x, y in zip(asdict(a).values(), asdict(b).values()))
