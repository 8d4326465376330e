"""Language identification of words by a linear-chain conditional random field.

Every word with letters gets a label; a word's features are its affixes and
inner n-grams (2 to 4 characters, the word's edges marked) and the word itself
(the lexicon), hashed into tables of weights per language.  Transitions between
neighbouring words are learned from code-switched chains put together from the
training texts.  Forward-backward over all words of a text gives each word's
marginals; a document's language is the one with the largest share of them.

What a word's features add up to depends on the word alone, so a task computes it
once for each different word.  A text's chain is worked on in blocks of ``BLOCK``
words side by side: a block's transfer matrix brings the forward and backward
weights from one end of it to the other, so no transition is lost between blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import fresh, hash_share, row_key, table

UNKNOWN = "und"
# Bounds of the training sample (labelled rows only; every language is kept):
# documents of a language, code points of a document (a longer one gives PASSAGES
# from all its length), words shared by the languages, and least words of each.
DOCS_PER_LANGUAGE = 300
MAX_TRAIN_CHARS = 20_000
PASSAGES = 16
TRAIN_WORDS = 120_000
LEAST_WORDS = 2_000

# Least share of the words for a language to be that of the document: a text half
# in one language and half in another has one, a jumble of many has none.
MIN_SCORE = 0.35

BLOCK = 64  # words of a chain that are worked on side by side with other blocks
MAX_WORD = 256  # code points; a longer word is labelled in pieces
_TABLE = 1 << 16  # rows of a table
_ORDERS = (2, 3, 4)
_STEPS = 60
_CELLS = 1 << 20  # marginals (words by languages) held at once
_KNOWN_WORDS = 200_000  # different words whose weights a task remembers

_LETTER: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _LETTER


def split_words(text: str) -> list[str]:
    """Lower-cased words; overlong ones in pieces."""
    words = text.lower().split()
    if max(map(len, words), default=0) > MAX_WORD:
        words = [w[i : i + MAX_WORD] for w in words for i in range(0, len(w), MAX_WORD)]
    return words


@dataclass
class Features:
    """Hashed features of words: per order the table row of the n-gram at each
    position, and per word its range of positions; per word its lexicon row."""

    grams: list[np.ndarray]
    first: np.ndarray
    last: list[np.ndarray]
    lexicon: np.ndarray
    letters: np.ndarray


def features(words: list[str]) -> Features:
    joined = " " + " ".join(words) + " "
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size
    grams, last, h = [], [], cp * np.uint32(0x01000193)
    shift = np.uint32(33 - _TABLE.bit_length())
    for n in range(2, max(_ORDERS) + 1):
        h = (h[:-1] ^ cp[n - 1 :]) * np.uint32(0x01000193)
        grams.append(((h + np.uint32(n)) * np.uint32(0x9E3779B1)) >> shift)
        # n-grams from the mark before the word to the mark behind it
        last.append(np.maximum(np.minimum(start + size + 2 - n, len(grams[-1])), start - 1))
    word = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint32, len(words))
    lexicon = (word * np.uint32(0x9E3779B1)) >> shift
    seen = np.concatenate(([0], np.cumsum(_is_letter()[cp])))
    return Features(grams, start - 1, last, lexicon, seen[start + size] - seen[start] > 0)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (len(_ORDERS) + 1, _TABLE, languages)
    moves: np.ndarray  # log weights from label to label
    begin: np.ndarray

    def emissions(self, f: Features) -> np.ndarray:
        out = self.weights[len(_ORDERS)][f.lexicon].astype(np.float64)
        for k, (g, last) in enumerate(zip(f.grams, f.last)):
            total = np.concatenate((np.zeros((1, out.shape[1])), np.cumsum(self.weights[k][g], axis=0, dtype=np.float64)))
            out += total[last] - total[f.first]
        return out


def marginals(
    model: Model, scores: np.ndarray, sizes: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once.  scores (chains, steps, labels),
    sizes (chains); ``first`` and ``last`` (chains, labels): weights that come in from
    before and behind (default: the beginning, nothing).  -> marginals, summed pair
    expectations, start expectations."""
    n, steps, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(model.moves - model.moves.max())
    inside = np.arange(steps)[None, :] < sizes[:, None]
    ahead, back = np.empty_like(e), np.empty_like(e)
    a = e[:, 0] * (np.exp(model.begin - model.begin.max()) if first is None else first)
    ahead[:, 0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        a = (ahead[:, t - 1] @ move) * e[:, t]
        ahead[:, t] = np.where(inside[:, t, None], a / a.sum(axis=1, keepdims=True), ahead[:, t - 1])
    end = np.full((n, k), 1.0 / k) if last is None else last
    back[:, -1] = end
    for t in range(steps - 2, -1, -1):
        b = (back[:, t + 1] * e[:, t + 1]) @ move.T
        back[:, t] = np.where(inside[:, t + 1, None], b / b.sum(axis=1, keepdims=True), end)
    p = ahead * back
    p /= p.sum(axis=2, keepdims=True)
    p *= inside[:, :, None]
    left = ahead[:, :-1]
    right = back[:, 1:] * e[:, 1:]
    norm = np.einsum("ntk,kl,ntl->nt", left, move, right, optimize=True)
    weight = np.where(inside[:, 1:], 1 / np.maximum(norm, 1e-300), 0.0)
    pairs = np.einsum("ntk,ntl->kl", left * weight[:, :, None], right, optimize=True) * move
    return p, pairs, p[:, 0].sum(axis=0)


def chained(model: Model, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Marginals of the words of whole texts, laid end to end (words, labels); ``sizes``:
    words of each text, none empty."""
    k = scores.shape[1]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(scores)) - (np.cumsum(sizes) - sizes)[owner]
    blocks = -(-sizes // BLOCK)
    of_text = np.cumsum(blocks) - blocks  # first block of each text
    block = of_text[owner] + at // BLOCK
    n, steps = int(blocks.sum()), min(BLOCK, int(sizes.max()))
    grid = np.zeros((n, steps, k))
    grid[block, at % BLOCK] = scores
    filled = np.bincount(block, minlength=n)
    first = np.tile(np.exp(model.begin - model.begin.max()), (n, 1))
    last = np.full((n, k), 1.0 / k)
    if n > len(sizes):
        # from the weights of the word before a block to those of its last word
        move = np.exp(model.moves - model.moves.max())
        e = np.exp(grid - grid.max(axis=2, keepdims=True))
        through = move * e[:, 0, None, :]
        through[of_text] = np.eye(k) * e[of_text, 0, None, :]
        for t in range(1, steps):
            m = (through @ move) * e[:, t, None, :]
            through = np.where((t < filled)[:, None, None], m / m.max(axis=(1, 2), keepdims=True), through)
        ahead = np.einsum("nk,nkl->nl", first[of_text], through[of_text])
        for i in range(1, int(blocks.max())):
            more = blocks > i
            here = of_text[more] + i
            before = ahead[more] / ahead[more].sum(axis=1, keepdims=True)
            first[here] = before @ move
            ahead[more] = np.einsum("nk,nkl->nl", before, through[here])
        for i in range(int(blocks.max()) - 1, 0, -1):
            here = of_text[blocks > i] + i
            w = np.einsum("nkl,nl->nk", through[here], last[here])
            last[here - 1] = w / w.sum(axis=1, keepdims=True)
    return marginals(model, grid, filled, first, last)[0][block, at % BLOCK]


def train(texts: list[tuple[str, str]], seed: int = 0) -> Model:
    """From (text, language): chains of 32 words from runs of 1 to 24 words of
    random texts, log-likelihood raised by Adam steps over all of them."""
    languages = sorted({lang for _, lang in texts})
    k, size = len(languages), 32
    rng = np.random.default_rng(seed)
    by_text = [(split_words(t), languages.index(lang)) for t, lang in sorted(texts)]
    by_text = [(w, y) for w, y in by_text if w]
    words: list[str] = []
    label: list[int] = []
    own = [[i for i, (_, y) in enumerate(by_text) if y == c] for c in range(k)]
    most = max(TRAIN_WORDS // max(k, 1), LEAST_WORDS)
    left = np.array([min(most, 4 * sum(len(by_text[i][0]) for i in o)) for o in own], np.int64)
    at = [int(rng.integers(len(w))) for w, _ in by_text]
    while left.any():
        y = int(np.searchsorted(np.cumsum(left), rng.integers(left.sum()), side="right"))
        i = own[y][int(rng.integers(len(own[y])))]
        w = by_text[i][0]
        run = w[at[i] : at[i] + min(int(rng.integers(1, 25)), int(left[y]))]
        at[i] = (at[i] + len(run)) % len(w)
        left[y] -= len(run)
        words += run
        label += [y] * len(run)
    rows = _TABLE
    model = Model(languages, np.zeros((len(_ORDERS) + 1, rows, max(k, 1)), np.float32), np.zeros((k, k)), np.zeros(k))
    if not words or k < 2:
        return model
    f = features(words)
    keep = f.letters
    if not keep.any():
        return model
    y = np.array(label)[keep]
    chains = len(y) // size or 1
    size = min(size, len(y))
    y = y[: chains * size].reshape(chains, size)
    number = np.where(keep, np.cumsum(keep) - 1, -1)
    number[number >= y.size] = -1
    # flat (table row, word) pairs of each table, in order of the words
    flat = []
    for g, last in zip(f.grams, f.last):
        count = np.maximum(last - f.first, 0)
        owner = np.repeat(number, count)
        pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(f.first, count)
        flat.append((g[pos][owner >= 0].astype(np.int64), owner[owner >= 0]))
    flat.append((f.lexicon[number >= 0].astype(np.int64), number[number >= 0]))
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    started = np.bincount(y[:, 0], minlength=k)
    # some chains at a time: (chains, truth, per table the rows and words of its pairs)
    step_chains = max(1, _CELLS // (size * k))
    parts = []
    for c in range(0, chains, step_chains):
        d = min(c + step_chains, chains)
        pairs_of = []
        for at_row, owner in flat:
            lo, hi = np.searchsorted(owner, (c * size, d * size))
            pairs_of.append((at_row[lo:hi], owner[lo:hi] - c * size))
        parts.append((d - c, y[c:d].ravel(), pairs_of))
    params = [model.weights, model.moves, model.begin]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    grad = np.empty_like(params[0])
    for step in range(1, _STEPS + 1):
        grad[:], pairs, begun = 0, np.zeros((k, k)), np.zeros(k)
        for n, truth, pairs_of in parts:
            scores = np.zeros((n * size, k))
            for (at_row, owner), w in zip(pairs_of, params[0]):
                for c in range(k):
                    scores[:, c] += np.bincount(owner, weights=w[at_row, c], minlength=n * size)
            p, some_pairs, some_begun = marginals(model, scores.reshape(n, size, k), np.full(n, size))
            pairs += some_pairs
            begun += some_begun
            error = -p.reshape(-1, k)
            error[np.arange(n * size), truth] += 1
            for j, (at_row, owner) in enumerate(pairs_of):
                for c in range(k):
                    grad[j, :, c] += np.bincount(at_row, weights=error[owner, c], minlength=rows)
        grad -= 0.1 * params[0]
        for i, g in enumerate([grad, seen - pairs - 0.1 * params[1], started - begun - 0.1 * params[2]]):
            for j in range(len(g)):  # a table at a time
                first[i][j] = 0.9 * first[i][j] + 0.1 * g[j]
                second[i][j] = 0.99 * second[i][j] + 0.01 * g[j] * g[j]
                params[i][j] += 0.1 * (first[i][j] / (1 - 0.9**step)) / (np.sqrt(second[i][j] / (1 - 0.99**step)) + 1e-8)
        model.moves, model.begin = params[1], params[2]
    return model


class Lexicon(dict):
    """Numbers of different words, and what their features add up to."""

    def __init__(self, model: Model):
        self.model, self.new = model, []
        self.scores = np.zeros((1 << 12, len(model.languages)), np.float32)
        self.letters = np.zeros(1 << 12, bool)
        self.known = 0

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        self.new.append(word)
        return self[word]

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Emissions and whether there are letters, word by word."""
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            f = features(self.new)
            upto = self.known + len(self.new)
            while upto > len(self.letters):
                self.scores, self.letters = (np.concatenate([x, np.zeros_like(x)]) for x in (self.scores, self.letters))
            self.scores[self.known : upto], self.letters[self.known : upto] = self.model.emissions(f), f.letters
            self.known, self.new = upto, []
        return self.scores[at], self.letters[at]


def label_words(model: Model, texts: list[list[str]], lexicon: Lexicon | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text (its words): indices of the words with letters, and their marginals."""
    flat = [w for t in texts for w in t]
    scores, letters = (lexicon if lexicon is not None else Lexicon(model)).of(flat)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[letters]
    counts = np.bincount(owner, minlength=len(texts))
    p = np.zeros((0, len(model.languages)))
    if len(owner):
        p = chained(model, scores[letters].astype(np.float64), counts[counts > 0])
    inner = np.nonzero(letters)[0] - (np.cumsum([len(t) for t in texts]) - [len(t) for t in texts])[owner]
    cut = np.cumsum(counts)[:-1]
    return list(zip(np.split(inner, cut), np.split(p, cut)))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        lexicon = Lexicon(model)
        most = max(_CELLS // max(len(model.languages), 1), 1)  # words held at once; a longer text is held alone
        for b in batches:
            mass = np.zeros((b.num_rows, max(len(model.languages), 1)))
            held: list[tuple[int, list[str]]] = []
            n = 0

            def settle() -> None:
                for (i, _), (_, p) in zip(held, label_words(model, [w for _, w in held], lexicon)):
                    mass[i] = p.sum(axis=0)

            for i, t in enumerate(b.column(b.num_columns - 1)):
                words = split_words(t.as_py() or "") if model.languages else []
                held.append((i, words))
                n += len(words)
                if n >= most:
                    settle()
                    held, n = [], 0
                    if lexicon.known > _KNOWN_WORDS:
                        lexicon = Lexicon(model)
            if held and model.languages:
                settle()
            total = mass.sum(axis=1)
            best = mass.argmax(axis=1)
            names = [model.languages[j] if s > 0 else UNKNOWN for j, s in zip(best, total)]
            share = np.where(total > 0, mass.max(axis=1) / np.maximum(total, 1e-9), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(names, pa.string()), pa.array(np.clip(share, 0, 1))],
                [*b.schema.names[:-1], "lang_pred", "score"],
            )

    return run


def _passages(text: Column, seed: Column) -> Column:
    """A text of over ``MAX_TRAIN_CHARS`` code points cut to as many: ``PASSAGES`` passages
    of whole words, one from a hashed place in each of as many equal stretches."""
    flat = F.regexp_replace(text, r"(?U)\s+", " ")
    stretch, size = F.floor(F.char_length(flat) / PASSAGES).cast("int"), MAX_TRAIN_CHARS // PASSAGES

    def passage(i: Column) -> Column:
        place = F.pmod(F.xxhash64(seed, i), F.greatest(stretch - size, F.lit(0)) + 1).cast("int")
        return F.regexp_replace(F.substring(flat, i * stretch + place + 1, F.lit(size)), r"^\S*\s|\s\S*$", "")

    some = F.array_join(F.array(*(passage(F.lit(i)) for i in range(PASSAGES))), " ")
    return F.when(F.char_length(text) <= MAX_TRAIN_CHARS, text).otherwise(some)


def learn(docs: DataFrame) -> Model:
    """A model from the rows with lang and a letter in the text: of every language about
    ``DOCS_PER_LANGUAGE`` rows (all of fewer, and one at least), those with a small hash
    of id and text; equal rows count once, and of a text of over ``MAX_TRAIN_CHARS``
    code points passages from all its length are read.  Without such rows the model
    knows no language."""
    rows = docs.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), "text", row_key()[1].alias("k")
    )
    share = hash_share(F.col("k"))
    each = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(share).alias("least"))
    small = (share < DOCS_PER_LANGUAGE / F.col("count")) | (share == F.col("least"))
    picked = rows.join(F.broadcast(each), "lang").where(small).groupBy("lang", "k").agg(F.first("text").alias("text"))
    texts = picked.select("lang", _passages(F.col("text"), F.col("k")).alias("text"))
    return train([(r["text"], r["lang"]) for r in texts.collect()])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``'s id (k1, k2, doc_id) with ``lang_pred`` and ``score`` (the share of the
    words' marginals, 0 to 1), a row per document row, from the text alone.  ``und``
    with score 0 if the text is null or has no letters, or nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(
        *(c.alias(n) for c, n in zip(row_key(), ("k1", "k2"))), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return rows.mapInArrow(
        _predict(shared), "k1 long, k2 long, doc_id long, lang_pred string, score double"
    )


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is known with at least ``min_score``; columns stay.
    The rejected ones are joined away by key (equal rows share their fate)."""
    found = identify(docs, learn(docs))
    k1, k2 = fresh(docs.columns, "k1", "k2")
    gone = found.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score))
    gone = gone.select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    rows = docs.withColumns(dict(zip((k1, k2), row_key())))
    return rows.join(gone, [k1, k2], "left_anti").drop(k1, k2)


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(4, 2)))
    return identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
