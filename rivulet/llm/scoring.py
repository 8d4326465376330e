"""Language-model scores of whole texts: a log-bilinear neural model over a real
vocabulary, trained with noise-contrastive estimation, and exact counts of the words
beyond it.

Tokens are words (A-Z lowered) and one end per text.  The ``VOCABULARY`` most frequent
words of the training texts have vectors of their own, and so have the end and
``BUCKETS`` kinds of rarer words, told by how they begin.  The model predicts a vector for
the next token: the shared vectors of the ``CONTEXT`` tokens before it, each through the
matrix of its position, are summed; the product with a token's vector plus its bias
is the token's score.  Tokens are grouped into classes by frequency, which have
vectors too: ``p(token) = p(class) * p(token in its class)``, two softmaxes by batched
matrix products, normalised exactly.

Training reads every training text, a share of them in each of ``ROUNDS`` rounds.  Each
task trains a copy of the model on its own texts (a target against noise words drawn
from the unigram distribution, for tokens and for classes), copies are averaged by
Spark in proportion to their tokens, and the average starts the next round.  Every token
of every text is a target, several times in a corpus of fewer than ``LEAST_TRAINED``
tokens.  A minibatch is made of short stretches of texts, so that a token's vector is
read, and its gradients as target and as context are summed, once in a stretch.  Counts
cover every token, too.

A rarer word's probability within its kind is c / (n + v), for its count c, the kind's n
tokens and v different words; an unseen word is one event of its kind, with v / (n + v)
(Witten and Bell's estimate).  So the known words and an unseen one of each kind sum to
one, as in the add-one unigram the known words and one unseen word do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import row_key, saved, table
from rivulet.llm.language import held_out

VOCABULARY = 10_000  # words with a vector of their own
BUCKETS = 64  # kinds of rarer words
CONTEXT = 4  # tokens before the predicted one
COMMON = 300_000  # most frequent words, counted on the map side instead of shuffled
ROUNDS = 3
LEAST_TRAINED = 2_000_000  # tokens
_DIM = 24
_CLASSES = 64
_NOISE, _CLASS_NOISE = 256, 32  # noise tokens and classes that a minibatch shares
_BATCH = 1024
_SMALL = 1_000_000  # multiplications in one matrix product: larger ones are packed first, at a cost
_STRETCH = 64  # tokens in a row of a minibatch
_RATE = 0.1
_REMEMBERED = 500_000  # words that a task keeps the id of
_SHUFFLED = 400_000  # tokens whose stretches are mixed before they make minibatches
_PIECE = 3_000_000  # bytes of texts that are split into words together
_END_TOKEN = b"\n"  # no word holds a newline


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


class Ids(dict):
    """Word -> id: the vocabulary by rank, then the kinds of rarer words, then the end."""

    def __init__(self, vocabulary: list[bytes]):
        self.own = {w: i for i, w in enumerate(vocabulary)}
        super().__init__(self.own)
        self.n = len(vocabulary)
        self.end = self.n + BUCKETS
        self.size = self.end + 1

    def __missing__(self, word: bytes) -> int:
        i = self.n + bucket(word)
        if len(self) < _REMEMBERED:
            self[word] = i
        return i

    def text(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def of(self, words: pa.Array) -> np.ndarray:
        """Ids of many words."""
        own = pc.index_in(words, value_set=pa.array(list(self.own), pa.binary())).fill_null(-1).to_numpy()
        return np.where(own < 0, self.n + buckets(words), own).astype(np.int32)

    def stream(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All texts in one row, each with its end and ``CONTEXT`` ends before it, and
        whether a place is a target (a token or the end of a text)."""
        pad, end = np.full(CONTEXT, self.end, np.int32), np.array([self.end], np.int32)
        full = np.concatenate([x for t in texts for x in (pad, t, end)])
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + CONTEXT + 1
        return full, np.arange(len(full)) - np.repeat(np.cumsum(size) - size, size) >= CONTEXT

    def contexts(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Targets (every token and the end of each text), and the ``CONTEXT`` ids before
        each, nearest first; before a text stand ends."""
        full, is_target = self.stream(texts)
        (at,) = np.nonzero(is_target)
        return full[at], np.stack([full[at - k] for k in range(1, CONTEXT + 1)])


def bucket(word: bytes) -> int:
    """A rarer word's kind, by its first two bytes (a single byte counts as followed by 0)."""
    return (word[0] * 0x9E3 + (word[1] if len(word) > 1 else 0) * 0x6A7 + 0x51) % 8191 % BUCKETS


def buckets(words: pa.Array) -> np.ndarray:
    """``bucket`` of many words."""
    if not len(words):
        return np.zeros(0, np.int64)
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    letters = np.append(np.frombuffer(words.buffers()[2], np.uint8), np.uint8(0)).astype(np.int64)
    first, second = letters[at[:-1]], np.where(np.diff(at) > 1, letters[at[:-1] + 1], 0)
    return (first * 0x9E3 + second * 0x6A7 + 0x51) % 8191 % BUCKETS


def _pieces_of(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts (last column) have about ``_PIECE`` bytes."""
    upto = np.cumsum(pc.binary_length(b.column(b.num_columns - 1)).fill_null(0).to_numpy().astype(np.int64))
    cut = [0, *(np.flatnonzero(np.diff(upto // _PIECE)) + 1), b.num_rows]
    for at, end in zip(cut, cut[1:]):
        if end > at:
            yield b.slice(at, end - at)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, the place among them of each word of the texts in
    turn, and the number of words of each text; as ``tokens``, a null has none."""
    lowered = pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string()).fill_null("")))
    some = pc.binary_length(lowered).to_numpy() > 0
    lists = pc.ascii_split_whitespace(lowered.filter(pa.array(some)))
    size = np.zeros(len(texts), np.int64)
    size[some] = lists.value_lengths().to_numpy()
    found = lists.flatten().dictionary_encode()
    return found.dictionary.view(pa.binary()), found.indices.to_numpy(), size


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows, ends = [], 0, 0

    def added() -> pa.RecordBatch:
        end = _pairs(pa.array([_END_TOKEN], pa.binary()), np.array([ends], np.int64))
        parts = pa.Table.from_batches([*held, end])
        sums = parts.group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])
        return sums.combine_chunks().to_batches()[0]

    for b in chain.from_iterable(map(_pieces_of, batches)):
        words, codes, _ = words_of(b.column(b.num_columns - 1))
        held.append(_pairs(words, np.bincount(codes, minlength=len(words))))
        rows, ends = rows + len(words), ends + b.num_rows
        if rows > 1_000_000:  # bounded memory; Spark adds up the parts
            yield added()
            held, rows, ends = [], 0, 0
    yield added()


def _pairs(words: pa.Array, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words, pa.array(c, pa.int64())], ["word", "c"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, c)`` over every text, the end among them; exact, any vocabulary."""
    parts = texts.select("text").mapInArrow(_counts, "word binary, c long")
    return saved(parts.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")

# ----------------------------------------------------------- log-bilinear model
def classes_of(counts: np.ndarray) -> np.ndarray:
    """Class of every id: ids by falling frequency, cut where the sum of the square roots
    of their frequencies passes equal shares."""
    weight = np.sqrt(counts + 1.0)
    order = np.lexsort((np.arange(len(counts)), -counts))
    share = np.cumsum(weight[order]) / weight.sum()
    out = np.empty(len(counts), np.int32)
    out[order] = np.minimum((share * _CLASSES).astype(np.int32), _CLASSES - 1)
    _, dense = np.unique(out, return_inverse=True)
    return dense.astype(np.int32)


@dataclass
class Neural:
    vectors: np.ndarray  # (ids, _DIM), as context and as target
    bias: np.ndarray
    position: np.ndarray  # (CONTEXT, _DIM, _DIM)
    class_vectors: np.ndarray
    class_bias: np.ndarray

    @staticmethod
    def fresh(counts: np.ndarray, kind: np.ndarray) -> Neural:
        rng = np.random.default_rng(0)
        p = (counts + 1.0) / (counts + 1.0).sum()
        q = np.bincount(kind, weights=p)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        position = np.stack([np.eye(_DIM, dtype=np.float32) / (k + 1) for k in range(CONTEXT)])
        return Neural(draw(len(p), _DIM), np.log(p).astype(np.float32), position, draw(len(q), _DIM), np.log(q).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.bias, self.position, self.class_vectors, self.class_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def like(self, flat: np.ndarray) -> Neural:
        cut = np.cumsum([x.size for x in self.parts()])[:-1]
        return Neural(*(x.astype(np.float32).reshape(y.shape) for x, y in zip(np.split(flat, cut), self.parts())))


def _contrast(q, vectors, bias, target, noise, log_noise, times=None):
    """Noise-contrastive step of one layer: gradients of the log-likelihood by the predicted
    vectors, and by the scores of the targets and of the shared noise (one draw of it; the
    vectors get ``times`` draws of each)."""
    own_vectors, noise_vectors = vectors.take(target, axis=0), vectors.take(noise, axis=0)
    own = np.einsum("nd,nd->n", q, own_vectors) + bias.take(target) - log_noise.take(target)
    g = 0.5 - 0.5 * np.tanh(0.5 * own)
    by_q = g[:, None] * own_vectors
    # less the logistic function is half of (the hyperbolic tangent of less the half) less one
    less = np.empty((q.shape[1] + 1, len(noise)), q.dtype)
    less[:-1], less[-1] = noise_vectors.T, bias.take(noise) - log_noise.take(noise)
    less *= -0.5
    wide = np.ones((len(q), len(less)), q.dtype)
    wide[:, :-1] = q
    if times is not None:
        noise_vectors *= times[:, None]
    h = np.empty((len(q), len(noise)), q.dtype)
    rows = _at_once(less)
    for at in range(0, len(q), rows):
        part = h[at : at + rows]
        np.matmul(wide[at : at + rows], less, out=part)
        np.tanh(part, out=part)
        part -= 1
        part *= 0.5
        by_q[at : at + rows] += part @ noise_vectors
    return by_q, g, h


def _product(q: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``q.T @ h`` by small products."""
    rows = max(1, _SMALL // (q.shape[1] * h.shape[1]))
    return sum(q[at : at + rows].T @ h[at : at + rows] for at in range(0, len(q), rows))


def _adagrad(values: np.ndarray, scale: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    s = scale.take(rows, axis=0)
    s += gradient * gradient
    scale[rows] = s
    s += 1
    np.sqrt(s, out=s)
    np.divide(gradient, s, out=s)
    s *= _RATE
    s += values.take(rows, axis=0)
    values[rows] = s


def _by_row(at: np.ndarray, most: int, *gradients: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different rows of ``at`` (below ``most``), and the sums of their gradients."""
    at = at.astype(np.uint16 if most <= 1 << 16 else np.int64)  # short numbers sort by digits
    order = np.argsort(at, kind="stable")
    at = at.take(order)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at.take(first), [np.add.reduceat(x.take(order, axis=0), first, axis=0) for x in gradients]


def _distinct(noise: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The different ids of some noise, and how often each was drawn."""
    times = np.bincount(noise, minlength=most)
    (noise,) = np.nonzero(times)
    return noise, times[noise].astype(np.float32)


def step(model: Neural, scale: Neural, ids, is_target, kind, noise, log_noise, class_noise, log_class) -> None:
    """One minibatch: gradients of both layers, steps by Adagrad.  A row of ``ids`` is a
    stretch of text after the ``CONTEXT`` ids before it; ``is_target`` tells its targets.
    Other places go along with gradients of zero, and equal noise is scored once."""
    (some, n), classes = ids.shape, len(model.class_bias)
    noise, times = _distinct(noise, len(model.bias))
    class_noise, class_times = _distinct(class_noise, classes)
    before = [slice(CONTEXT - k, n - k) for k in range(1, CONTEXT + 1)]
    x, target = model.vectors.take(ids, axis=0), ids[:, CONTEXT:].ravel()
    own = kind.take(target)
    q = sum(x[:, at] @ m for at, m in zip(before, model.position)).reshape(-1, _DIM)
    by_q, g, h = _contrast(q, model.vectors, model.bias, target, noise, log_noise, times)
    more, class_g, class_h = _contrast(q, model.class_vectors, model.class_bias, own, class_noise, log_class, class_times)
    by_q += more
    wide = np.ones((len(q), _DIM + 1), np.float32)  # the last column is the biases'
    wide[:, :-1] = q
    (none,) = np.nonzero(~is_target.ravel())
    by_q[none] = wide[none] = g[none] = class_g[none] = 0
    rows_by_q = by_q.reshape(some, -1, _DIM)
    by_position = np.stack([(x[:, at].swapaxes(1, 2) @ rows_by_q).sum(axis=0) for at in before])
    by_noise = _product(wide, h).T * times[:, None]
    by_vectors, by_bias = np.zeros((some * n + len(noise), _DIM), np.float32), np.zeros(some * n + len(noise), np.float32)
    by_vectors[some * n :], by_bias[some * n :] = by_noise[:, :-1], by_noise[:, -1]
    by_x = by_vectors[: some * n].reshape(some, n, _DIM)
    by_x[:, CONTEXT:] = (g[:, None] * q).reshape(some, -1, _DIM)
    by_bias[: some * n].reshape(some, n)[:, CONTEXT:] = g.reshape(some, -1)
    for at, m in zip(before, model.position):
        by_x[:, at] += (by_q @ m.T).reshape(some, -1, _DIM)
    rows, (by_vectors, by_bias) = _by_row(np.concatenate([ids.ravel(), noise]), len(model.vectors), by_vectors, by_bias)
    _adagrad(model.vectors, scale.vectors, rows, by_vectors)
    _adagrad(model.bias, scale.bias, rows, by_bias)
    by_score = np.zeros((len(q), classes), np.float32)
    by_score[:, class_noise] = class_h * class_times
    by_score[np.arange(len(q)), own] += class_g
    by_class, every = _product(wide, by_score).T, np.arange(classes)
    _adagrad(model.class_vectors, scale.class_vectors, every, by_class[:, :-1])
    _adagrad(model.class_bias, scale.class_bias, every, by_class[:, -1])
    scale.position += by_position * by_position
    model.position += _RATE * by_position / np.sqrt(scale.position + 1)


def _stretches(full: np.ndarray, is_target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stream cut into rows of ``_STRETCH`` places after the ``CONTEXT`` places before
    them; the first ``CONTEXT`` places of a stream are no targets."""
    rows = -(-(len(full) - CONTEXT) // _STRETCH)
    more = CONTEXT + rows * _STRETCH - len(full)
    full, is_target = np.append(full, np.repeat(full[-1:], more)), np.append(is_target, np.zeros(more, bool))
    ids = np.lib.stride_tricks.sliding_window_view(full, CONTEXT + _STRETCH)[::_STRETCH]
    return ids, is_target[CONTEXT:].reshape(rows, _STRETCH)


def train_part(model: Neural, counts: np.ndarray, kind: np.ndarray, streams: Iterator[tuple[np.ndarray, np.ndarray]], seed: int) -> int:
    """Train on streams of texts, in place; returns the tokens seen."""
    rng = np.random.default_rng(seed)
    p = (counts + 1.0) / (counts + 1.0).sum()
    q = np.bincount(kind, weights=p)
    log_noise, log_class = np.log(_NOISE * p).astype(np.float32), np.log(_CLASS_NOISE * q).astype(np.float32)
    upto, class_upto = np.cumsum(p), np.cumsum(q)
    scale, seen = Neural(*(np.zeros_like(x) for x in model.parts())), 0
    for full, inner in streams:
        ids, is_target = _stretches(full, inner)
        order = rng.permutation(len(ids))
        for at in range(0, len(order), _BATCH // _STRETCH):
            own = order[at : at + _BATCH // _STRETCH]
            noise = np.minimum(np.searchsorted(upto, rng.random(_NOISE)), len(p) - 1).astype(np.int32)
            class_noise = np.minimum(np.searchsorted(class_upto, rng.random(_CLASS_NOISE)), len(q) - 1)
            step(model, scale, ids[own], is_target[own], kind, noise, log_noise, class_noise, log_class)
        seen += int(inner.sum())
    return seen


def _pieces(batches: Iterator[pa.RecordBatch], ids: Ids) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Streams of all texts, whole texts of about ``_SHUFFLED`` tokens each."""
    held, n = [], 0
    for b in chain.from_iterable(map(_pieces_of, batches)):
        words, codes, size = words_of(b.column(b.num_columns - 1))
        for text in np.split(ids.of(words)[codes], np.cumsum(size)[:-1]):
            held.append(text)
            n += len(text)
            if n >= _SHUFFLED:
                yield ids.stream(held)
                held, n = [], 0
    if held:
        yield ids.stream(held)


_FLAT = 1024  # parameters of a row


def _trained(shared, epochs: int, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts, kind, flat = shared.value
        ids = Ids(vocabulary)
        model = Neural.fresh(counts, kind).like(flat)
        pieces: Iterator = _pieces(batches, ids)
        if epochs > 1:  # a small corpus: its tokens are kept
            kept = list(pieces)
            pieces = (x for _ in range(epochs) for x in kept)
        seen = train_part(model, counts, kind, pieces, number)
        if seen:
            out = model.flat()
            rows = np.append(out, np.zeros(-len(out) % _FLAT, np.float32)).reshape(-1, _FLAT) * np.float64(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(np.full(len(rows), float(seen))),
                    pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), _FLAT).cast(pa.list_(pa.float64())),
                ],
                ["row", "tokens", "sums"],
            )

    return run


def _mean(copies: pa.Table) -> pa.Table:
    """A row of parameters, averaged over the copies in proportion to their tokens."""
    sums = copies.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, _FLAT).sum(axis=0)
    mean = sums / copies.column("tokens").to_numpy().sum()
    return pa.table({"row": copies.column("row").slice(0, 1), "means": pa.array([mean], pa.list_(pa.float64()))})


def train(texts: DataFrame, vocabulary: list[bytes], counts: np.ndarray, kind: np.ndarray) -> Neural:
    """The model of all of ``texts`` (text, k: a hash of the row): in each round every task
    trains on its texts of the round, and the copies' weighted sums meet in one
    aggregation by row of parameters."""
    model = Neural.fresh(counts, kind)
    if not counts.sum():
        return model
    epochs = max(1, round(LEAST_TRAINED / float(counts.sum())))
    for r in range(ROUNDS):
        some = texts.where(F.pmod("k", F.lit(ROUNDS)) == r)
        shared = texts.sparkSession.sparkContext.broadcast((vocabulary, counts, kind, model.flat()))
        copies = some.select("text").mapInArrow(_trained(shared, epochs, r), "row int, tokens double, sums array<double>")
        means = copies.groupBy("row").applyInArrow(_mean, "row int, means array<double>").toArrow().sort_by("row")
        if means.num_rows:
            flat = means.column("means").combine_chunks().flatten().to_numpy().astype(np.float32)
            model = model.like(flat[: model.flat().size])
        shared.unpersist()
    return model


class Scorer:
    """Natural-log probabilities of tokens in context."""

    def __init__(self, model: Neural, kind: np.ndarray):
        self.kind = kind
        # vectors through the matrices, and (last column) a one for the biases
        self.placed = [np.column_stack([model.vectors @ m, np.full(len(kind), k == 0, np.float32)]) for k, m in enumerate(model.position)]
        self.classes = np.ascontiguousarray(np.column_stack([model.class_vectors, model.class_bias]).T)
        order = np.argsort(kind, kind="stable")
        cut = np.cumsum(np.bincount(kind))[:-1]
        self.members = [np.ascontiguousarray(x.T) for x in np.split(np.column_stack([model.vectors, model.bias])[order], cut)]
        self.place = np.empty(len(kind), np.int64)  # within its class
        for own in np.split(order, cut):
            self.place[own] = np.arange(len(own))

    def of(self, target: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        own, n = self.kind.take(target), len(target)
        q, out = np.empty((n, _DIM + 1), np.float32), np.empty(n)
        for at in range(0, n, size := _at_once(self.classes)):
            part = slice(at, at + size)
            x = self.placed[0].take(contexts[0, part], axis=0)
            for p, c in zip(self.placed[1:], contexts[1:, part]):
                x += p.take(c, axis=0)
            q[part] = x
            out[part] = _picked(x @ self.classes, own[part])
        order = np.argsort(own.astype(np.int16), kind="stable")
        cut = np.searchsorted(own[order], np.arange(len(self.members) + 1))
        place = self.place.take(target)
        for c, members in enumerate(self.members):
            if members.shape[1] > 1:
                for at in range(cut[c], cut[c + 1], size := _at_once(members)):
                    some = order[at : min(at + size, cut[c + 1])]
                    out[some] += _picked(q.take(some, axis=0) @ members, place[some])
        return out


def _at_once(weights: np.ndarray) -> int:
    """Rows of a small product with ``weights``."""
    return max(1, _SMALL // weights.size)


def _picked(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at one place."""
    mine = scores[np.arange(len(at)), at].astype(np.float64)
    one = np.ones(scores.shape[1], np.float32)
    with np.errstate(over="ignore"):
        total = np.exp(scores) @ one
    if 1e-30 < total.min() and total.max() < 1e30:
        return mine - np.log(total, dtype=np.float64)
    top = scores.max(axis=1, keepdims=True)  # scores beyond the exponential's range
    return mine - top[:, 0] - np.log(np.exp(scores - top) @ one, dtype=np.float64)


# ------------------------------------------------------------------- all of it
@dataclass
class Model:
    vocabulary: list[bytes]
    kind: np.ndarray  # class of every id
    neural: Neural
    common: dict[bytes, int]  # the most frequent words' counts
    tokens: np.ndarray  # of each kind of rarer words, and its different words
    words: np.ndarray
    train_tokens: int
    different: int


def learn(texts: DataFrame, counts: DataFrame) -> Model:
    """The model of all of ``texts``; ``counts`` are their words'.  Only bounded data
    reach the driver: the ``COMMON`` most frequent words, the totals of the kinds and
    the model's parameters."""
    size = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    words = counts.where(F.col("word") != F.lit(_END_TOKEN))
    top = sorted(((bytes(r[0]), r[1]) for r in _most_frequent(words).collect()), key=lambda r: (-r[1], r[0]))
    ids = Ids([w for w, _ in top[:VOCABULARY]])
    total, kinds = np.zeros(ids.size), np.zeros(BUCKETS)
    total[: ids.n] = [c for _, c in top[: ids.n]]
    per_kind = words.mapInArrow(_kind_totals(list(ids.own)), "kind int, n long, v long").groupBy("kind")
    for r in per_kind.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        total[ids.n + r["kind"]], kinds[r["kind"]] = r["n"], r["v"]
    end = counts.where(F.col("word") == F.lit(_END_TOKEN)).agg(F.sum("c")).first()[0]
    total[ids.end] = end or 0
    kind = classes_of(total)
    neural = train(texts, list(ids.own), total, kind)
    return Model(
        list(ids.own), kind, neural, dict(top), total[ids.n : ids.end], kinds, int(size[0] or 0), int(size[1])
    )


def _most_frequent(words: DataFrame) -> DataFrame:
    """The most frequent words, at most ``COMMON``: those from the lowest step of
    frequency (16 to a doubling) down to which there are no more.  Only the steps'
    counts come to the driver; a top k would send k words from each partition."""
    step = F.floor(F.log2("c") * 16)
    held, least = 0, 1 << 30
    for r in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += r["count"]
        if held > COMMON:
            break
        least = r["step"]
    return words.where(step >= least)


def _kind_totals(vocabulary: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, v = pa.array(vocabulary, pa.binary()), np.zeros(BUCKETS), np.zeros(BUCKETS)
        for b in batches:
            rare = pc.invert(pc.is_in(b.column(0).cast(pa.binary()), value_set=known))
            at = buckets(b.column(0).cast(pa.binary()).filter(rare))
            n += np.bincount(at, weights=b.column(1).filter(rare).to_numpy(), minlength=BUCKETS)
            v += np.bincount(at, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BUCKETS), pa.int32()), pa.array(n.astype(np.int64)), pa.array(v.astype(np.int64))], ["kind", "n", "v"]
        )

    return run


_PARTS = "k1 long, k2 long, doc_id long, word binary, tf long, worth double, seen double, model double, n_tokens long, n_known long"


def _score(shared):
    """Per text one row (word null) with what the model and its common words give, and
    one row per different word that is not common: its frequency, and log10 of the
    count that an unseen word of its kind is worth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        ids, scorer = Ids(m.vocabulary), Scorer(m.neural, m.kind)
        common, count = pa.array(list(m.common), pa.binary()), np.array([*m.common.values(), 0], np.int64)
        # of each kind: log of an unseen word's share, and log10 of the count it is worth
        v = np.where(m.words > 0, m.words, 1.0)
        unseen, worth_of = np.log(v / np.where(m.words > 0, m.tokens + m.words, 1.0)), np.log10(v)

        def done(b: pa.RecordBatch) -> pa.RecordBatch:
            words, codes, size = words_of(b.column(3))
            # of every word: its id, count if it is known here, kind (none: -1), its tail's log
            own, n = ids.of(words), b.num_rows
            c = count[pc.index_in(words, value_set=common).fill_null(-1).to_numpy()]
            kind = np.where(own < ids.n, -1, own - ids.n)
            seen = np.where(c > 0, np.log(np.maximum(c, 1)) - worth_of[kind] * math.log(10), 0.0)
            extra = np.where(kind < 0, 0.0, unseen[kind] + seen)
            owner = np.repeat(np.arange(n), size)
            target, contexts = ids.contexts(np.split(own[codes], np.cumsum(size)[:-1]))
            model = np.bincount(np.repeat(np.arange(n), size + 1), weights=scorer.of(target, contexts), minlength=n)
            total = lambda x: np.bincount(owner, weights=x[codes], minlength=n)
            (rare,) = np.nonzero((c == 0)[codes])
            pair, tf = np.unique(owner[rare] * np.int64(1 << 32) + codes[rare], return_counts=True)
            of, code = pair >> 32, pair & 0xFFFFFFFF
            r = len(pair)
            column = lambda own, more: pa.concat_arrays([own.take(pa.array(of)), more])
            half = lambda rows, own: pa.concat_arrays([rows, own])
            none = lambda size, kind: pa.nulls(size, kind)
            return pa.RecordBatch.from_arrays(
                [
                    *(column(b.column(i), b.column(i)) for i in range(3)),
                    half(words.take(pa.array(code)), none(n, pa.binary())), half(pa.array(tf.astype(np.int64)), none(n, pa.int64())),
                    half(pa.array(worth_of[kind[code]]), none(n, pa.float64())), half(none(r, pa.float64()), pa.array(total(np.log10(c + 1.0)))),
                    half(none(r, pa.float64()), pa.array((model + total(extra)) / math.log(10))),
                    half(none(r, pa.int64()), pa.array(size + 1)),
                    half(none(r, pa.int64()), pa.array(total(c > 0).astype(np.int64))),
                ],
                [x.split()[0] for x in _PARTS.split(", ")],
            )

        yield from map(done, chain.from_iterable(map(_pieces_of, batches)))

    return run


def score(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``(k1, k2, doc_id, n_tokens, n_known, train_tokens, base_score, score)``, a row
    per row of ``docs``, after learning from every text of ``training``.  base_score:
    add-one unigram; score: the log-bilinear model.  Both are log10 of a probability over
    all words seen in training plus one unseen word (the model: one of each kind).
    Null texts are empty and have one token, the end.  Without training texts every
    token is unseen."""
    counts = word_counts(training)
    model = learn(training.select("text", row_key()[1].alias("k")), counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        *(c.alias(n) for c, n in zip(row_key(), ("k1", "k2"))), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    parts = saved(rows.mapInArrow(_score(shared), _PARTS), "score-parts")
    end = counts.where(F.col("word") == F.lit(_END_TOKEN)).agg(F.sum("c")).first()[0] or 0
    end_seen = math.log10(end + 1)
    # common words never get here, so no word is hot; unseen ones find no partner
    rare = parts.where("word is not null").select("k1", "k2", "word", "tf", "worth").join(counts, "word")
    tf = F.col("tf")
    rare = rare.groupBy("k1", "k2").agg(
        F.sum(tf * F.log10(F.col("c") + 1)).alias("seen"), F.sum(tf).alias("known"),
        F.sum(tf * (F.log10("c") - F.col("worth"))).alias("worth"),
    )
    # equal rows share a key: the sums of their rare words are divided by their number
    texts = parts.where("word is null").drop("word", "tf", "worth").withColumnRenamed("seen", "common_seen")
    copies = texts.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    joined = texts.join(rare, ["k1", "k2"], "left").join(copies, ["k1", "k2"], "left")
    each = F.coalesce("copies", F.lit(1))
    more = {name: F.coalesce(name, F.lit(0.0)) / each for name in ("seen", "known", "worth")}
    norm = math.log10(model.train_tokens + model.different + 1)
    return joined.select(
        "k1",
        "k2",
        "doc_id",
        "n_tokens",
        (F.col("n_known") + more["known"] + (1 if end else 0)).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("common_seen") + more["seen"] + end_seen - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("model") + more["worth"]).alias("score"),
    )


def op10_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, docs.where(~held_out(7, 2))).select(
        "doc_id", held_out(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
