"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages; its label says nothing about any one of them.
Every passage is encoded (the mean of its words' learned vectors through a tanh
layer), gated attention ``w . (tanh(V h) * sigmoid(U h))`` gives it a weight
within its document, and the score is the logistic of the weighted mean of the
encodings.  All parameters are learned together from document labels by Adam
steps in numpy, on a bounded sample of labelled rows; scoring runs in tasks over
every passage of every text and shuffles nothing.

A word's vector is the sum of three hashed rows: the lower-cased word, its shape
(runs of capitals, small letters, digits, other marks) and the marks in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import hash_share, saved, table

# Bounds of the training sample (about nine tenths of it are drawn): labelled rows,
# and code points of their texts.
TRAIN_ROWS = 4_000
TRAIN_CHARS = 16_000_000
PASSAGE = 64  # words
LIKELY = 0.3  # least score of a document that is predicted to have label 1

_ROWS = 1 << 14  # of the table of vectors
_WIDTH, _HIDDEN, _GATE = 24, 24, 12
_EPOCHS, _BAGS, _RATE, _DECAY = 6, 32, 0.01, 1e-5
_GROUP_WORDS = 1 << 18  # words of the texts that are scored at once
_KNOWN_WORDS = 400_000  # words whose vectors a task remembers

_END_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_RUN = re.compile(r"[0-9]+|[^\W\d_]+")


def _letters(run: str) -> str:
    return "a" if run.islower() else "A" if run.isupper() else "Aa" if run[0].isupper() else "aA"


def _hashed(kind: str, text: str) -> int:
    return crc32((kind + text).encode("utf-8", "surrogatepass")) % _ROWS


@lru_cache(1 << 16)
def _look(shape: str, marks: str) -> tuple[int, int]:
    return _hashed("s", shape), _hashed("m", marks)


def word_rows(word: str) -> tuple[int, int, int]:
    core = word.rstrip(_END_MARKS)
    if core.isalpha():  # most words: letters and perhaps marks behind them
        marks = word[len(core) :]
        return (_hashed("w", word.lower()), *_look(_letters(core) + marks, marks))
    shape = _RUN.sub(lambda m: "0" if m[0][0].isdigit() else _letters(m[0]), word)
    return (_hashed("w", word.lower()), *_look(shape, "".join(c for c in word if not (c.isalnum() or c == "_"))))


class Words(dict):
    """Numbers of words, in order of their first use, and their table rows."""

    def __init__(self):
        self.rows: list[tuple[int, int, int]] = []

    def __missing__(self, word: str) -> int:
        self[word] = len(self.rows)
        self.rows.append(word_rows(word))
        return self[word]

    def of(self, text: str | None) -> np.ndarray:
        """Of a text's words; a text without any has one empty word."""
        words = (text or "").split() or [""]
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass
class Bags:
    """Texts end to end: the first word of each passage and the first passage of each text."""

    size: np.ndarray  # words of each passage
    word: np.ndarray
    passage: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray) -> Bags:
        count = -(-sizes // PASSAGE)
        first = np.cumsum(count) - count
        inner = np.arange(int(count.sum())) - np.repeat(first, count)
        word = np.repeat(np.cumsum(sizes) - sizes, count) + inner * PASSAGE
        return Bags(np.minimum(PASSAGE, np.repeat(sizes, count) - inner * PASSAGE), word, first)

    def bag_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.passage)), np.diff(np.append(self.passage, len(self.word))))


@dataclass
class Model:
    vectors: np.ndarray | None  # None: nothing learned
    enter: np.ndarray
    enter_bias: np.ndarray
    tanh_gate: np.ndarray
    sigmoid_gate: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def encode(self, means: np.ndarray) -> np.ndarray:
        return np.tanh(means @ self.enter + self.enter_bias)

    def attention(self, h: np.ndarray, bags: Bags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of the passages within their texts, and both halves of the gate."""
        t, s = np.tanh(h @ self.tanh_gate), _logistic(h @ self.sigmoid_gate)
        e = (t * s) @ self.attend
        bag = bags.bag_of()
        e = np.exp(e - np.maximum.reduceat(e, bags.passage)[bag])
        return e / np.add.reduceat(e, bags.passage)[bag], t, s

    def scores(self, means: np.ndarray, bags: Bags) -> tuple[np.ndarray, np.ndarray]:
        """Score of each text and weight of each passage."""
        h = self.encode(means)
        a = self.attention(h, bags)[0]
        z = np.add.reduceat(a[:, None] * h, bags.passage)
        return _logistic(z @ self.out + self.out_bias[0]), a


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def gradients(model: Model, rows: np.ndarray, bags: Bags, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of the texts and its gradient; ``rows``: table rows of every word."""
    x = np.add.reduceat(model.vectors[rows].sum(axis=1), bags.word) / bags.size[:, None]
    h = model.encode(x)
    a, t, s = model.attention(h, bags)
    z = np.add.reduceat(a[:, None] * h, bags.passage)
    p = _logistic(z @ model.out + model.out_bias[0])
    n, bag = len(truth), bags.bag_of()
    loss = -np.mean(np.log(np.where(truth == 1, p, 1 - p) + 1e-12))
    d_logit = (p - truth) / n
    d_z = d_logit[:, None] * model.out
    d_a = (h * d_z[bag]).sum(axis=1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, bags.passage)[bag])
    d_ts = d_e[:, None] * model.attend
    d_t, d_s = d_ts * s * (1 - t * t), d_ts * t * s * (1 - s)
    d_h = a[:, None] * d_z[bag] + d_t @ model.tanh_gate.T + d_s @ model.sigmoid_gate.T
    d_in = d_h * (1 - h * h)
    d_x = (d_in @ model.enter.T) / bags.size[:, None]
    d_word = np.repeat(d_x, bags.size, axis=0)
    flat = rows.ravel()
    vectors = np.stack(
        [np.bincount(flat, weights=np.repeat(d_word[:, j], rows.shape[1]), minlength=_ROWS) for j in range(d_word.shape[1])], axis=1
    )
    return loss, {
        "vectors": vectors, "enter": x.T @ d_in, "enter_bias": d_in.sum(axis=0),
        "tanh_gate": h.T @ d_t, "sigmoid_gate": h.T @ d_s, "attend": (d_e[:, None] * t * s).sum(axis=0),
        "out": z.T @ d_logit, "out_bias": np.array([d_logit.sum()]),
    }


def fresh_model(seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    return Model(
        rng.normal(0, 0.1, (_ROWS, _WIDTH)), draw(_WIDTH, _HIDDEN), np.zeros(_HIDDEN), draw(_HIDDEN, _GATE),
        draw(_HIDDEN, _GATE), draw(_GATE), draw(_HIDDEN), np.zeros(1),
    )


def train(texts: list[tuple[str | None, int]], seed: int = 0) -> Model:
    """From (text, label); the same rows give the same model."""
    model = fresh_model(seed)
    if not texts:
        model.vectors = None
        return model
    rng = np.random.default_rng(seed)
    texts = sorted(texts, key=lambda r: (r[0] or "", r[1]))
    words = Words()
    codes = [words.of(t) for t, _ in texts]
    truth = np.array([y for _, y in texts], float)
    table_rows = np.array(words.rows, np.int32)
    first = {k: np.zeros_like(v) for k, v in asdict(model).items()}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    step = 0
    for epoch in range(_EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), _BAGS):
            own = order[at : at + _BAGS]
            bags = Bags.of(np.array([len(codes[i]) for i in own], np.int64))
            grad = gradients(model, table_rows[np.concatenate([codes[i] for i in own])], bags, truth[own])[1]
            step += 1
            rate = _RATE * (1 - epoch / _EPOCHS)
            for name, g in grad.items():
                value = getattr(model, name)
                g = g + _DECAY * value
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                value -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return model


# -------------------------------------------------------------------- scoring
def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        vectors = None if model.vectors is None else model.vectors.astype(np.float32)
        words, known, filled = Words(), np.zeros((1 << 16, _WIDTH), np.float32), 0

        def done(ids: list, codes: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal words, known, filled
            n = len(ids)
            if model.vectors is None:
                score, top, weight = np.full(n, 0.5), np.zeros(n, np.int64), np.ones(n)
                count = np.array([-(-len(c) // PASSAGE) for c in codes], np.int64)
            else:
                new = np.array(words.rows[filled:], np.int32).reshape(-1, 3)
                while filled + len(new) > len(known):
                    known = np.concatenate([known, np.zeros_like(known)])
                known[filled : filled + len(new)] = vectors[new[:, 0]] + vectors[new[:, 1]] + vectors[new[:, 2]]
                filled += len(new)
                bags = Bags.of(np.array([len(c) for c in codes], np.int64))
                means = np.add.reduceat(known[np.concatenate(codes)], bags.word) / bags.size[:, None]
                score, a = model.scores(means, bags)
                count = np.diff(np.append(bags.passage, len(a)))
                order = np.lexsort((np.arange(len(a)), -a, bags.bag_of()))[bags.passage]
                top, weight = order - bags.passage, a[order]
                if filled > _KNOWN_WORDS:
                    words, filled = Words(), 0
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(count), pa.array(top), pa.array(weight), pa.array(score)],
                ["doc_id", "n_passages", "top_passage", "top_weight", "score"],
            )

        ids, codes, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                ids.append(i.as_py())
                codes.append(words.of(t.as_py()))
                held += len(codes[-1])
                if held >= _GROUP_WORDS or len(ids) >= 10_000:
                    yield done(ids, codes)
                    ids, codes, held = [], [], 0
        if ids:
            yield done(ids, codes)

    return run


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, label)`` of a bounded part of the labelled documents: ids with a small hash.
    Labels that are null, of no document or contradict each other count for nothing;
    of several texts under one id the smallest is read."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")
    )
    known = saved(known.where("label = other").drop("other"), "quality-labels")
    share = hash_share(F.xxhash64("doc_id", F.lit("quality")))
    some = known.where(share < 0.9 * TRAIN_ROWS / max(known.count(), 1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # about TRAIN_ROWS short rows
    own = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    own = saved(own, "quality-train")
    chars = own.agg(F.sum(F.char_length("text"))).first()[0] or 0
    if chars > TRAIN_CHARS:  # fewer rows, whole texts
        own = own.where(hash_share(F.xxhash64("doc_id", F.lit("chars"))) < 0.9 * TRAIN_CHARS / chars)
    return own.select("text", "label")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents (see ``sample``); none: one that scores 0.5."""
    return train([(r["text"], r["label"]) for r in sample(docs, labels).collect()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_passages, top_passage, top_weight, score)`` per document row: its passages
    of ``PASSAGE`` words, which of them (from 0; ties: the first) has the greatest
    attention and how much, and the score from 0 to 1 (higher: label 1 likelier), from
    the text alone.  A null or blank text is one empty passage with the score learned for
    those; null and repeated ids stay rows of their own; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(asdict(model))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(shared), "doc_id long, n_passages long, top_passage long, top_weight double, score double")


def _is_held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op13_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    found = score(docs, learn(docs, labels.where(~_is_held_out())))
    return found.select(
        "doc_id", _is_held_out().alias("held_out"), "score", (F.col("score") >= LIKELY).cast("int").alias("predicted"), "n_passages"
    )
