"""Trained operators, chat formatting, mixing, the pipeline and the queries."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import chat, common, language, mixing, queries, scoring
from tests.llm.conftest import prose, rows
from tests.oracle_check import compare


# ------------------------------------------------------------------ language ID
def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    k, steps = 3, 4
    model = language.Model(["a", "b", "c"], np.zeros((1, 1, k)), rng.normal(size=(k, k)), rng.normal(size=k))
    scores, sizes = rng.normal(size=(2, steps, k)), np.array([4, 2])
    p, pairs, begun = language.marginals(model, scores, sizes)
    want_p, want_pairs, want_begun = np.zeros_like(p), np.zeros((k, k)), np.zeros(k)
    for c, n in enumerate(sizes):
        paths = list(np.ndindex(*[k] * n))
        w = np.array([
            math.exp(model.begin[y[0]] + sum(scores[c, t, y[t]] for t in range(n)) + sum(model.moves[y[t], y[t + 1]] for t in range(n - 1)))
            for y in paths
        ])
        for y, q in zip(paths, w / w.sum()):
            want_begun[y[0]] += q
            for t in range(n):
                want_p[c, t, y[t]] += q
            for t in range(n - 1):
                want_pairs[y[t], y[t + 1]] += q
    assert np.allclose(p, want_p) and np.allclose(pairs, want_pairs) and np.allclose(begun, want_begun)


def test_language_held_out_accuracy(spark, sf_oracle):
    docs = common.table(spark, sf_oracle, "documents").select("doc_id", "lang")
    got = queries.QUERIES["op3_language"](spark, sf_oracle).join(docs, "doc_id").cache()
    assert got.count() == docs.count()
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert got.where("score < 0 or score > 1").count() == 0
    wrong = [r.doc_id for r in got.collect() if r.held_out != (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)]
    assert not wrong


def test_language_labels_switched_words(spark, sf_small):
    docs = common.table(spark, sf_small, "documents")
    model = language.learn(docs)
    texts = {r.lang: r.text.split()[:12] for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    words = [w.lower() for w in texts["en"] + texts["de"]]
    ((at, p),) = language.label_words(model, [words])
    said = [model.languages[j] for j in p.argmax(axis=1)]
    assert said[:10].count("en") >= 8 and said[-10:].count("de") >= 8


def test_language_edge_rows(docs, clashing, empty):
    model = language.learn(docs)
    found = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert {i for i, lang, s in found if lang == "und"} == {8, 9, 10, 17, 20, None}
    assert all((s == 0) == (lang == "und") for _, lang, s in found)
    kept = language.keep_identified(clashing, 0.0)
    assert kept.columns == clashing.columns and kept.count() == len(rows()) - 6
    nothing = language.learn(empty)
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def _tongue(k: int, seed: int, n: int) -> str:
    """Words of a language of its own: syllables drawn by the language's number."""
    own = random.Random(k)
    lexicon = ["".join(own.choice("bdfgklmnprstvz") + own.choice("aeiou") for _ in range(3)) for _ in range(30)]
    r = random.Random(seed)
    return " ".join(r.choice(lexicon) for _ in range(n))


def test_language_learns_from_long_texts_only(spark):
    data = [(10 * k + i, _tongue(k, i, 4000), f"l{k}") for k in range(2) for i in range(3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert min(len(t) for _, t, _ in data) > language.MAX_TRAIN_CHARS
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, language.learn(docs)).collect()}
    assert found == {i: lang for i, _, lang in data}
    assert language.keep_identified(docs).count() == len(data)


def test_language_passages_of_long_texts(spark):
    text = " ".join(f"w{i:05d}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "x" * 50_000), (3, "a b")], "k long, text string")
    cut = {r.k: r.t for r in docs.select("k", language._passages(F.col("text"), F.col("k")).alias("t")).collect()}
    said = cut[1].split()
    assert len(cut[1]) <= language.MAX_TRAIN_CHARS and set(said) <= set(text.split())
    assert {int(w[1:]) * language.PASSAGES // 20_000 for w in said} == set(range(language.PASSAGES))
    assert set(cut[2].split()) == {"x" * (language.MAX_TRAIN_CHARS // language.PASSAGES)} and cut[3] == "a b"


def test_language_keeps_every_language(spark, monkeypatch):
    monkeypatch.setattr(language, "_STEPS", 20)
    monkeypatch.setattr(language, "LEAST_WORDS", 200)
    monkeypatch.setattr(language, "TRAIN_WORDS", 1000)
    data = [(100 * k + i, _tongue(k, i, 60), f"l{k:02d}") for k in range(70) for i in range(2 if k == 69 else 3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert model.languages == sorted({lang for *_, lang in data})
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert sum(found[i] == lang for i, _, lang in data) > 0.9 * len(data)
    assert found[6900] == "l69"


# ------------------------------------------------------------------- LM scoring
def test_scoring(docs, clashing, empty):
    train = docs.where("source is not null")
    held = [(r[0], r[1]) for r in rows()]
    counts = Counter()
    for _, t, _, source, _ in rows():
        if source is not None:
            counts.update((t or "").encode().lower().split() + ["end"])
    n, v = sum(counts.values()), len(counts)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scoring.score(docs, train).collect()))
    expected = []
    for i, t in held:
        ws = (t or "").encode().lower().split() + ["end"]
        expected.append((i is None, i or 0, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)))
    assert got == sorted(expected)
    assert scoring.score(clashing, empty).where("score is null or n_known > 0").count() == 0
    assert scoring.score(empty, train).count() == 0


def _random_neural(ids, counts, seed=1):
    kind = scoring.classes_of(counts)
    model = scoring.Neural.fresh(counts, kind)
    rng = np.random.default_rng(seed)
    return kind, model.like(model.flat() + rng.normal(0, 0.3, model.flat().size).astype(np.float32))


def _plain_log_p(model, kind, target, context):
    """One token from the formulas, in double precision."""
    q = sum(model.vectors[c].astype(float) @ model.position[k].astype(float) for k, c in enumerate(context))
    classes = model.class_vectors.astype(float) @ q + model.class_bias
    own = np.flatnonzero(kind == kind[target])
    inner = model.vectors[own].astype(float) @ q + model.bias[own]
    pick = lambda x, i: x[i] - x.max() - np.log(np.exp(x - x.max()).sum())
    return pick(classes, kind[target]) + pick(inner, int(np.flatnonzero(own == target)[0]))


def test_scoring_contexts():
    ids = scoring.Ids([b"a", b"b"])
    texts = [[b"a", b"b", b"zz"], [], [b"b"]]
    target, contexts = ids.contexts([ids.text(t) for t in texts])
    want = []
    for t in texts:
        full = [ids.end] * scoring.CONTEXT + [ids[w] for w in t] + [ids.end]
        want += [(full[i], *(full[i - k] for k in range(1, scoring.CONTEXT + 1))) for i in range(scoring.CONTEXT, len(full))]
    assert list(zip(target.tolist(), *contexts.tolist())) == want
    assert ids[b"zz"] == ids.n + scoring.bucket(b"zz") and ids[b"z"] >= ids.n


def test_scoring_is_a_distribution():
    """All tokens in any context sum to one, and each is what the formulas say."""
    ids = scoring.Ids([b"w%d" % i for i in range(300)])
    counts = np.random.default_rng(0).integers(0, 1000, ids.size).astype(float)
    kind, model = _random_neural(ids, counts)
    scorer = scoring.Scorer(model, kind)
    every = np.arange(ids.size, dtype=np.int32)
    for context in ([5, 7, 9], [ids.end] * 3, [ids.n, 0, 1]):
        p = scorer.of(every, np.repeat(np.array(context, np.int32)[:, None], ids.size, axis=1))
        assert np.exp(p).sum() == pytest.approx(1, abs=1e-5)
        for t in (0, 17, 299, ids.n + 3, ids.end):
            assert p[t] == pytest.approx(_plain_log_p(model, kind, t, context), abs=1e-4)


def test_scoring_noise_contrast_gradients():
    rng = np.random.default_rng(4)
    q, vectors, bias = rng.normal(size=(6, 5)), rng.normal(size=(9, 5)), rng.normal(size=9)
    target, noise, log_noise = rng.integers(0, 9, 6), rng.integers(0, 9, 4), rng.normal(size=9)

    def objective():
        own = (q * vectors[target]).sum(axis=1) + bias[target] - log_noise[target]
        other = q @ vectors[noise].T + bias[noise] - log_noise[noise]
        return -np.log1p(np.exp(-own)).sum() - np.log1p(np.exp(other)).sum()

    by_q, g, h = scoring._contrast(q, vectors, bias, target, noise, log_noise)
    by_vectors, by_bias = np.zeros_like(vectors), np.zeros_like(bias)
    np.add.at(by_vectors, np.concatenate([target, noise]), np.concatenate([g[:, None] * q, h.T @ q]))
    np.add.at(by_bias, np.concatenate([target, noise]), np.concatenate([g, h.sum(axis=0)]))
    for value, gradient in ((q, by_q), (vectors, by_vectors), (bias, by_bias)):
        for _ in range(8):
            at = tuple(rng.integers(n) for n in value.shape)
            kept = value[at]
            value[at] = kept + 1e-6
            more = objective()
            value[at] = kept - 1e-6
            less = objective()
            value[at] = kept
            assert (more - less) / 2e-6 == pytest.approx(gradient[at], rel=1e-4, abs=1e-6)


def test_scoring_learns_what_follows(spark, monkeypatch):
    monkeypatch.setattr(scoring, "LEAST_TRAINED", 300_000)
    r = random.Random(2)
    texts = []
    for i in range(120):  # after "a" comes "b", two words after "x" comes "y"
        words = []
        while len(words) < 60:
            words += r.choice((["a", "b"], ["x", r.choice("pqrs"), "y"], ["c"]))
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    counts = scoring.word_counts(docs)
    model = scoring.learn(docs.select("text", common.row_key()[1].alias("k")), counts)
    ids, scorer = scoring.Ids(model.vocabulary), scoring.Scorer(model.neural, model.kind)
    p = lambda w, *before: math.exp(scorer.of(np.array([ids[w]]), np.array([[ids[x]] for x in before]))[0])
    assert p(b"b", b"a", b"c", b"c") > 0.9 and p(b"y", b"q", b"x", b"c") > 0.9 and p(b"b", b"c", b"a", b"b") < 0.1


def test_scoring_trains_on_every_token(spark, monkeypatch):
    """What follows "a" and "x" stands only beyond the first 256 tokens of every 4096."""
    monkeypatch.setattr(scoring, "LEAST_TRAINED", 1)
    r = random.Random(3)
    texts = []
    for i in range(15):
        words = []
        while len(words) < 32768:
            words += ["c"] * 256
            while len(words) % 4096:
                words += r.choice((["a", "b"], ["x", "y"], ["c", "c"]))
        texts.append((i, " ".join(words[:32767])))
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    model = scoring.learn(docs.select("text", common.row_key()[1].alias("k")), scoring.word_counts(docs))
    ids, scorer = scoring.Ids(model.vocabulary), scoring.Scorer(model.neural, model.kind)
    p = lambda w, *before: math.exp(scorer.of(np.array([ids[w]]), np.array([[ids[x]] for x in before]))[0])
    assert p(b"b", b"a", b"c", b"c", b"c") > 0.9 and p(b"y", b"x", b"c", b"c", b"c") > 0.9


def test_scoring_cuts_streams_into_stretches():
    """Every token and end is a target once, after the tokens before it."""
    ids = scoring.Ids([b"w%d" % i for i in range(50)])
    r = random.Random(5)
    texts = [[b"w%d" % r.randrange(70) for _ in range(n)] for n in (0, 1, 200, 0, 63, 64, 65, 1000)]
    target, contexts = ids.contexts([ids.text(t) for t in texts])
    found = list(scoring._pieces(iter([pa.RecordBatch.from_arrays([pa.array([b" ".join(t) for t in texts])], ["text"])]), ids))
    stretches, is_target = scoring._stretches(*found[0])
    assert len(found) == 1 and stretches.shape[1] == scoring.CONTEXT + scoring._STRETCH and is_target.shape == (len(stretches), scoring._STRETCH)
    at = np.argwhere(is_target)
    got = [tuple(stretches[i, j : j + scoring.CONTEXT + 1][::-1].tolist()) for i, j in at]
    assert got == list(zip(target.tolist(), *contexts.tolist()))


def test_scoring_step_is_plain_adagrad():
    ids = scoring.Ids([b"w%d" % i for i in range(20)])
    rng = np.random.default_rng(6)
    kind, model = _random_neural(ids, rng.integers(1, 1000, ids.size).astype(float))
    want = model.like(model.flat())
    scale, plain_scale = (scoring.Neural(*(np.zeros_like(x) for x in model.parts())) for _ in range(2))
    log_noise, log_class = rng.normal(size=ids.size).astype(np.float32), rng.normal(size=kind.max() + 1).astype(np.float32)
    for _ in range(2):
        rows, is_target = rng.integers(0, 6, (3, scoring.CONTEXT + 8)).astype(np.int32), rng.random((3, 8)) < 0.8
        noise, class_noise = rng.integers(0, ids.size, 10).astype(np.int32), rng.integers(0, kind.max() + 1, 5)
        at = np.argwhere(is_target)
        target = np.array([rows[i, j + scoring.CONTEXT] for i, j in at])
        contexts = np.array([[rows[i, j + scoring.CONTEXT - k] for i, j in at] for k in range(1, scoring.CONTEXT + 1)])
        q = sum(want.vectors[c] @ m for c, m in zip(contexts, want.position))
        by = scoring.Neural(*(np.zeros(x.shape) for x in model.parts()))
        by_q = 0
        for vectors, bias, d_vectors, d_bias, t, n, log_n in (
            (want.vectors, want.bias, by.vectors, by.bias, target, noise, log_noise),
            (want.class_vectors, want.class_bias, by.class_vectors, by.class_bias, kind[target], class_noise, log_class),
        ):
            more, g, h = scoring._contrast(q, vectors, bias, t, n, log_n)
            by_q = by_q + more
            np.add.at(d_vectors, t, g[:, None] * q)
            np.add.at(d_vectors, n, h.T @ q)
            np.add.at(d_bias, t, g)
            np.add.at(d_bias, n, h.sum(axis=0))
        for k, (c, m) in enumerate(zip(contexts, want.position)):
            np.add.at(by.vectors, c, by_q @ m.T)
            by.position[k] = want.vectors[c].T @ by_q
        scoring.step(model, scale, rows, is_target, kind, noise, log_noise, class_noise, log_class)
        for value, s, d in zip(want.parts(), plain_scale.parts(), by.parts()):
            s += d * d
            value += scoring._RATE * d / np.sqrt(s + 1)
        for found, value in zip(model.parts(), want.parts()):
            assert found == pytest.approx(value, rel=1e-3, abs=1e-4)


def test_scoring_scores_equal_noise_once(monkeypatch):
    """Noise drawn several times costs one column of scores (the step is the same: above)."""
    ids = scoring.Ids([b"w%d" % i for i in range(20)])
    kind, model = _random_neural(ids, np.ones(ids.size))
    scale = scoring.Neural(*(np.zeros_like(x) for x in model.parts()))
    log_noise, log_class = np.zeros(ids.size, np.float32), np.zeros(kind.max() + 1, np.float32)
    widths, contrast = [], scoring._contrast

    def seen(*x):
        widths.append(contrast(*x)[2].shape[1])
        return contrast(*x)

    monkeypatch.setattr(scoring, "_contrast", seen)
    rows, noise, class_noise = np.zeros((2, scoring.CONTEXT + 8), np.int32), np.array([7, 3, 7, 7, 3]), np.array([0, 1, 0])
    scoring.step(model, scale, rows, np.ones((2, 8), bool), kind, noise, log_noise, class_noise, log_class)
    assert widths == [2, 2]


def test_scoring_splits_words_together(monkeypatch):
    """Words of many texts at once are those of ``tokens``, whatever the pieces; their ids,
    kinds and counts are those of single words."""
    monkeypatch.setattr(scoring, "_PIECE", 40)
    texts = [None, "", " ", "A b\ta", "\x0bx\x0c\r\ny  \x1c\u00a0Z \x00", "\u00c4\u00d6 \u2003 \u00e4", "e" * 90, "b b b", *(prose(i, 30) for i in range(9))]
    want = [scoring.tokens((t or "").encode()) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    pieces = list(scoring._pieces_of(batch))
    assert not list(scoring._pieces_of(batch.slice(0, 0))) and not list(scoring._pieces(iter([batch.slice(0, 0)]), scoring.Ids([b"a"])))
    assert len(pieces) > 5 and pa.Table.from_batches(pieces).to_pydict() == batch.to_pydict()
    got = []
    for b in pieces:
        words, codes, size = scoring.words_of(b.column(1))
        words = words.to_pylist()
        assert len(set(words)) == len(words)
        got += [[words[c] for c in x] for x in np.split(codes, np.cumsum(size)[:-1])]
    assert got == want
    words, ids = pa.array(sorted({w for t in want for w in t}), pa.binary()), scoring.Ids([b"a", b"b"])
    assert ids.of(words).tolist() == [ids[w] for w in words.to_pylist()]
    assert scoring.buckets(words.slice(2)).tolist() == [scoring.bucket(w) for w in words.to_pylist()[2:]]
    counts = Counter(w for t in want for w in t) + Counter({b"\n": len(texts)})
    assert len({len(b.column("word")) for b in scoring._counts(iter([batch.select(["text"])]))}) == 1
    assert {w: c for b in scoring._counts(iter([batch.select(["text"])])) for w, c in zip(*b.to_pydict().values())} == counts


def test_scoring_softmax_beyond_the_exponentials_range():
    scores = np.array([[300.0, 301.0, 299.0], [-300.0, -301.0, -299.0], [1.0, 2.0, 0.0]], np.float32)
    want = [1 / (1 + math.e + 1 / math.e), 1 / (1 + 1 / math.e + math.e), 1 / (1 + math.e + 1 / math.e)]
    assert np.exp(scoring._picked(scores, np.zeros(3, int))) == pytest.approx(want, rel=1e-5)


def test_scoring_matches_plain_evaluation(spark, docs, monkeypatch):
    """The score column, text by text, from the trained model and exact counts."""
    monkeypatch.setattr(scoring, "VOCABULARY", 30)
    monkeypatch.setattr(scoring, "COMMON", 45)
    monkeypatch.setattr(scoring, "LEAST_TRAINED", 20_000)
    models = []
    learn = scoring.learn
    monkeypatch.setattr(scoring, "learn", lambda *x: models.append(learn(*x)) or models[0])
    train = docs.where("source is not null")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in scoring.score(docs, train).collect())
    (model,) = models
    ids = scoring.Ids(model.vocabulary)
    counts = Counter()
    for _, t, _, source, _ in rows():
        if source is not None:
            counts.update((t or "").encode().lower().split())
    assert ids.n == 30 and len(model.common) <= 45 and set(model.vocabulary) == {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:30]}
    kinds = {}
    for w, c in counts.items():
        if w not in ids.own:
            n, v = kinds.get(scoring.bucket(w), (0, 0))
            kinds[scoring.bucket(w)] = n + c, v + 1
    want = []
    for i, t, *_ in rows():
        words = (t or "").encode().lower().split()
        full = [ids.end] * scoring.CONTEXT + [ids[w] for w in words] + [ids.end]
        total = 0.0
        for at in range(scoring.CONTEXT, len(full)):
            total += _plain_log_p(model.neural, model.kind, full[at], [full[at - k] for k in range(1, scoring.CONTEXT + 1)])
        for w in words:
            if w not in ids.own:
                n, v = kinds.get(scoring.bucket(w), (0, 1))
                total += math.log((counts[w] or v) / (n + v))
        want.append((i is None, i or 0, total / math.log(10)))
    for (a, b, x), (c, d, y) in zip(got, sorted(want)):
        assert (a, b) == (c, d) and x == pytest.approx(y, rel=1e-4, abs=1e-3)


def test_scoring_beats_an_interpolated_bigram_on_held_out_texts(spark, sf_oracle):
    """Bigrams interpolated with unigrams and one unseen word, both by Witten and Bell.  They
    know copies of training texts by heart, so the comparison is on texts of which
    one in fifty five-word sequences at most stands in a training text."""
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in common.table(spark, sf_oracle, "documents").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op10_scoring"](spark, sf_oracle).collect()}
    training = [texts[i] for i, r in got.items() if not r.held_out]
    one, two, before, follow = Counter(), Counter(), Counter(), Counter()
    fives = set()
    for t in training:
        fives |= set(zip(t, t[1:], t[2:], t[3:], t[4:]))
        for p, w in zip([b"\n", *t], t):
            one[w] += 1
            before[p] += 1
            two[p, w] += 1
            follow[p] += two[p, w] == 1
    n, v = sum(one.values()), len(one)
    ours = bigram = base = 0.0
    for i, r in got.items():
        t = texts[i]
        own = list(zip(t, t[1:], t[2:], t[3:], t[4:]))
        if r.held_out and sum(x in fives for x in own) <= len(own) / 50:
            ours, base = ours + r.score, base + r.base_score
            for p, w in zip([b"\n", *t], t):
                back = (one[w] or v) / (n + v)
                bigram += math.log10((two[p, w] + follow[p] * back) / (before[p] + follow[p]) if before[p] else back)
    assert ours > bigram > base, (ours, bigram, base)


# ---------------------------------------------------------------------- mixing
def test_mixing_meets_its_targets(spark, sf_oracle):
    docs, labels = common.table(spark, sf_oracle, "documents"), common.table(spark, sf_oracle, "labels")
    found = mixing.mix(docs, labels).toPandas()
    assert len(found) == docs.count() and (found.rate >= 0).all()
    n = found.n_tokens.sum()
    total = {d: (found.n_tokens * found.rate * found[f"p_{d}"]).sum() / n for d in mixing.DOMAINS}
    assert abs(total["high"] - 0.9) < 0.01 and abs(total["low"] - 0.1) < 0.01 and total["toxic"] < 0.01
    merged = labels.toPandas().merge(found, on="doc_id")
    assert merged[merged.toxic == 1].p_toxic.mean() > 0.7 and merged[(merged.toxic == 0) & (merged.quality == 1)].p_toxic.mean() < 0.05
    assert ((found.copies - found.rate).abs() < 1).all()


def test_mixing_tells_domains_of_any_size_apart(spark):
    r = random.Random(1)
    texts, labels = [], []
    for i in range(300):
        domain = 2 if i % 20 == 0 else i % 2
        text = prose(i, r.randint(20, 120)).split()
        text[r.randrange(len(text))] = ("good", "bad", "foul")[domain]
        texts.append((i, " ".join(text)))
        labels.append((i, int(domain == 0), int(domain == 2)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = mixing.mix(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).toPandas()
    found = found.sort_values("doc_id").reset_index(drop=True)
    own = np.array([2 if t else 1 - q for _, q, t in labels])
    weight = (found.n_tokens * found.rate).groupby(own).sum() / found.n_tokens.sum()
    assert np.allclose([weight[0], weight[1], weight[2]], [0.9, 0.1, 0.0], atol=0.03)
    p = found[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy()
    assert p[np.arange(300), own].min() > 0.8


def test_mixing_classifier_matches_plain_naive_bayes(spark, sf_small):
    """Posteriors of every document by counting in Python, with all features that pass."""
    import re

    docs, labels = common.table(spark, sf_small, "documents"), common.table(spark, sf_small, "labels")
    domain: dict = {}
    for r in labels.collect():
        if r.toxic == 1 or r.quality in (0, 1):
            domain[r.doc_id] = max(domain.get(r.doc_id, -1), 2 if r.toxic == 1 else 1 if r.quality == 0 else 0)
    mark = r"\s!-/:-@\[-`{-~"

    def seen(text):
        text = (text or "").lower()
        return {x for x in re.split(f"[{mark}]+", text, flags=re.A) + re.split(f"[^{mark.replace(chr(92) + 's', '')}]+", text, flags=re.A) if x}

    texts = {r.doc_id: r.text for r in docs.collect()}
    training = {(d, frozenset(seen(texts[i]))) for i, d in domain.items() if i in texts}
    size = [sum(d == k for d, _ in training) for k in range(3)]
    total = sum(size)
    held = Counter((f, d) for d, fs in training for f in fs)
    best = []
    for f in {f for f, _ in held}:
        n = [held[f, k] for k in range(3)]
        mean = sum(n) / total
        share = [(n[k] + 2 * mean) / (size[k] + 2) for k in range(3)]
        others = [(sum(n) - n[k] + 2 * mean) / (total - size[k] + 2) for k in range(3)]
        stray = sum(size[k] * (share[k] - mean) ** 2 / (mean * (1 - mean) + 1e-9) for k in range(3))
        if stray >= 0.01 * total and max(a / b for a, b in zip(share, others)) >= 3 and sum(n) >= 2:
            best.append((-stray, f, [min(x, 0.999) for x in share]))
    best.sort()
    assert len(best) > 8
    model, priors = mixing.classifier(docs, labels, max_features=8)
    assert {r.feature for r in model.collect()} <= {f for s, f, _ in best if s <= best[7][0] + 1e-9}
    model, priors = mixing.classifier(docs, labels, max_features=100_000)
    plan = mixing.posteriors(docs, mixing.classifier(docs, labels, 200)[0], priors)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
    got = {r.doc_id: (r.p0, r.p1, r.p2) for r in mixing.posteriors(docs, model, priors).collect()}
    for i, text in texts.items():
        own = seen(text)
        w = [math.log(size[k] / total) + sum(math.log(s[k] if f in own else 1 - s[k]) for _, f, s in best) for k in range(3)]
        e = [math.exp(x - max(w)) for x in w]
        assert np.allclose(got[i], [x / sum(e) for x in e], atol=1e-6), i


def test_mixing_reports_a_missed_target(spark):
    texts = [(i, f"{prose(i, 40)} {'good' if i % 2 else 'bad'}") for i in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    assert mixing.mix(docs, labels).first()["miss"] < 0.01
    assert mixing.mix(docs, labels, {"high": 0.5, "toxic": 0.5}).first()["miss"] > 0.3  # no document is toxic


def test_mixing_matches_plain_projected_gradient(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    n = rng.integers(1, 400, 300)
    members = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p)], "n_tokens long, p0 double, p1 double, p2 double")
    steps, _ = mixing.fit_rates(members, mixing.TARGET)
    got = np.array([r[0] for r in members.select(mixing._rate(steps)).collect()])
    goal, gram = np.array([0.9, 0.1, 0.0]), (p * n[:, None]).T @ p / n.sum()
    rate, inverse = np.ones(300), np.linalg.inv(gram + 1e-6 * np.eye(3))
    for _ in steps:
        rate = np.maximum(0, rate - p @ (inverse @ ((n * rate) @ p / n.sum() - goal)))
    assert np.allclose(np.sort(got), np.sort(rate), atol=1e-6)


def test_mixing_edge_rows(spark, docs, clashing, empty):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (4, 0, 0), (5, 0, 1), (None, 1, 1), (99, 1, 0), (6, None, None), (7, 1, None)],
        "doc_id long, quality int, toxic int",
    )
    assert mixing.mix(docs, labels).count() == len(rows())
    none = mixing.mix(docs, labels.limit(0))
    assert none.count() == len(rows()) and none.where("abs(p_high - 1D/3D) > 1e-9").count() == 0
    assert mixing.mix(empty, labels).count() == 0
    out = mixing.mix_documents(clashing, labels)
    assert set(out.columns) == set(clashing.columns) and out.where("copies < 1").count() == 0
    with pytest.raises(ValueError):
        mixing.fit_rates(empty, {"high": -1.0})


# ------------------------------------------------------------------------ chat
def test_chat_round_trip(spark):
    said = ["</s>", "<\\/s>", "[INST] ok [/INST]", "<s>[INST]user[/INST]", "\\", "<\\\\s>", "", "a\né\U0001f600", "[\\/INST]</s", "<<s>"]
    talks = {None: [("user", "x")], 1: [("user", s) for s in said], 2: [("assistant", s) for s in said]}
    talks[3] = [("system", "be"), (None, None), ("user", "q"), ("assistant", "r"), ("assistant", "</s>"), ("user", "last"), ("</s>[INST]", "odd")]
    data = [(c, t, role, text) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    found = chat.examples(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    got = found.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    for c, turns in talks.items():
        turns = [(r or "", t or "") for r, t in turns]
        own = sorted((r for r in got if r.conv_id == c), key=lambda r: r.example)
        assert [(t.role, t.text) for t in own[-1].turns] == turns
        replies = [t for r, t in turns if r == "assistant"]
        masked = [r.formatted[r.loss_start : r.loss_end] for r in own if r.loss_end > r.loss_start]
        assert len(masked) == sum(t != "" for t in replies)
        for r in own:
            assert [(t.role, t.text) for t in r.turns] == turns[: r.example + 1]
    assert chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_repeated_rows_and_ties(spark):
    data = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "z"), (1, 1, "assistant", "r"), (1, 1, "assistant", "r")]
    (row,) = chat.digest(chat.examples(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))).collect()
    assert row.n_turns == 5 and row.loss_chars == 2


# ---------------------------------------------------------- queries and pipeline
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, sf_small, name):
    ok, said = compare(spark, sf_small, name, queries.QUERIES[name], queries.SQL[name])
    assert ok, said


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark, sf_small):
    """Every stage against a plain reading of its rule on its own input."""
    docs = common.table(spark, sf_small, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.saved(stage(spark, docs, sf_small), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "language_id":
            assert {i for i in before if i not in after} == {i for i, r in before.items() if not any(c.isalpha() for c in r.text or "")}
        if name == "line_dedup":
            from tests.llm.test_documents import _lines_brute

            want = _lines_brute([(i, r.text) for i, r in before.items()])
            assert {(i, r.text) for i, r in after.items()} == {(i, t) for i, _, _, t in want}
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "simhash_near_dedup":
            from tests.llm.test_documents import _groups, _print_brute

            prints = {i: _print_brute(r.text) for i, r in before.items()}
            group = _groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
            low = {}
            for i, p in sorted(prints.items()):
                low.setdefault(group[p], i)
            assert set(after) == set(low.values())
        if name == "benchmark_decontamination":
            from tests.llm.test_documents import _contaminated_brute

            items = duckdb.sql(f"select item_id, text from '{sf_small}/benchmark.parquet'").fetchall()
            bad = {i for i, *_ in _contaminated_brute([(i, r.text) for i, r in before.items()], items)}
            assert set(after) == set(before) - bad
        if name == "source_mixing":
            assert docs.columns == [*columns, "rate", "copies"]
            assert all(r.copies >= 1 and r.rate > 0 for r in after.values())
        else:
            assert docs.columns == columns
        before = after


def test_pipeline_on_an_empty_table(spark, empty, sf_small):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert docs.count() == 0


def test_language_chains_have_no_cut():
    """Blocks side by side give what one long chain gives."""
    rng = np.random.default_rng(7)
    for k in (2, 4):
        model = language.Model(list("abcd")[:k], np.zeros((1, 1, k)), rng.normal(size=(k, k)) * 3, rng.normal(size=k))
        sizes = np.array([1, 200, 64, 65, 3, 128, 511])
        scores = rng.normal(size=(int(sizes.sum()), k))
        got = language.chained(model, scores, sizes)
        for start, n in zip(np.cumsum(sizes) - sizes, sizes):
            alone = language.marginals(model, scores[None, start : start + n], np.array([n]))[0][0]
            assert np.allclose(got[start : start + n], alone, atol=1e-9)


def test_language_lexicon_is_the_whole_word():
    pairs = [("abcdpqefxyzrstuv", "abcdmnefxyzrstuv"), ("a" * 30 + "b" + "a" * 30, "a" * 29 + "ba" + "a" * 30)]
    for x, y in pairs:
        f = language.features([x, y, x])
        assert f.lexicon[0] != f.lexicon[1] and f.lexicon[0] == f.lexicon[2]


def test_language_features_and_scores_match_plain_sums(spark, sf_small):
    """Emissions by reading the tables n-gram by n-gram; a text's prediction by plain
    forward-backward over its words."""
    docs = common.table(spark, sf_small, "documents").limit(60)
    model = language.learn(docs)
    shift = 33 - language._TABLE.bit_length()

    def emission(word):
        marked = [ord(c) for c in f" {word} "]
        total = np.zeros(len(model.languages))
        for order, n in enumerate((2, 3, 4)):
            for i in range(len(marked) - n + 1):
                h = 0
                for j, c in enumerate(marked[i : i + n]):
                    h = (h ^ c if j else c) * 0x01000193 % 2**32
                total += model.weights[order][((h + n) * 0x9E3779B1 % 2**32) >> shift]
        return total + model.weights[3][(zlib.crc32(word.encode()) * 0x9E3779B1 % 2**32) >> shift]

    words = [w for t in ("The cat, sat.", "niño où über 12 !! x") for w in language.split_words(t)]
    scores, letters = language.Lexicon(model).of(words)
    assert letters.tolist() == [any(c.isalpha() for c in w) for w in words]
    assert np.allclose(scores, [emission(w) for w in words], atol=1e-3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    for r in docs.collect()[:12]:
        ws = [w for w in language.split_words(r.text or "") if any(c.isalpha() for c in w)]
        if ws:
            p = language.marginals(model, np.array([[emission(w) for w in ws]]), np.array([len(ws)]))[0][0]
            share = p.sum(axis=0) / len(ws)
            assert got[r.doc_id][0] == model.languages[int(share.argmax())] and got[r.doc_id][1] == pytest.approx(share.max(), abs=1e-3)
