"""Soft-membership mixing: rates per document whose expected domain totals meet
target weights.  DataFrame functions only.

Domains are the classes of the labelled table: ``toxic`` (toxic = 1), else
``high`` (quality = 1) or ``low`` (quality = 0).  A naive-Bayes classifier fitted
on labelled rows gives every document posteriors p over the domains.  With n
tokens, a document at rate r adds r n p_k tokens to domain k; the rates r >= 0
minimise the squared distance of these sums to target_k times all tokens, in
the metric of the documents' Gram matrix, by projected gradient from r = 1.
A step subtracts p . g with one vector g for all documents, so a rate is a
function of the document's p and the vectors so far; each step is one
aggregation to a handful of sums.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import fresh, hash_share, row_key, saved, table

DOMAINS = ("high", "low", "toxic")
TARGET = {"high": 0.9, "low": 0.1, "toxic": 0.0}
# Bounds of the classifier: labelled rows it is fitted on, and features it keeps at
# most (``max_features`` of ``mix``).
# A feature must be LEAST_RATIO times as frequent in one domain as in the rows of
# the others (words that only tell long texts from short ones are not), which any
# size of the domains allows, with an effect (chi-square over rows) of
# LEAST_EFFECT, and stand in LEAST_ROWS labelled rows at least.
TRAIN_ROWS = 20_000
FEATURES = 256
LEAST_RATIO = 3.0
LEAST_EFFECT = 0.01
LEAST_ROWS = 2
_SMOOTH = 2.0  # documents at the common share that every domain is given
_STEPS = 40
_CLOSE = 1e-3  # share of all tokens by which a total may miss its target
_STILL = 1e-4  # steps end when no total moves by more

# Letters with digits, and the marks between them, are features of their own.
_MARKS = r"[\s\p{Punct}]+"
_LETTERS = r"[^\p{Punct}]+"


def features(text: Column) -> Column:
    """The different lower-cased words and runs of punctuation of a text."""
    t = F.lower(F.coalesce(text, F.lit("")))
    runs = F.array_union(F.split(t, _MARKS, -1), F.split(t, _LETTERS, -1))
    return F.filter(runs, lambda w: w != F.lit(""))


def n_tokens(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != F.lit("")))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(domain, feature list)`` of at most TRAIN_ROWS labelled documents (nine tenths of
    that on average, so that none of its spread passes it), those whose id has a small hash; copies count once.  Rows without both labels are left
    out; of several labels of a document toxic goes before low before high."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"))
    known = known.where("doc_id is not null and domain is not null")
    known = known.groupBy("doc_id").agg(F.max("domain").alias("domain"))
    known = saved(known, "mixing-labels")
    some = known.where(hash_share(F.xxhash64("doc_id")) < 0.9 * TRAIN_ROWS / max(known.count(), 1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(some), "doc_id").select("domain", F.sort_array(features(F.col("text"))).alias("fs"))
    return found.distinct()


def classifier(docs: DataFrame, labels: DataFrame, max_features: int = FEATURES) -> tuple[DataFrame, list[float]]:
    """Bernoulli naive Bayes on the at most ``max_features`` features that tell the domains apart
    best: ``(feature, w0, w1, ...)`` what the presence of each adds to the domains'
    log-odds, and where those start with all absent (-inf: a domain without rows)."""
    rows = saved(_labelled(docs, labels), "mixing-train")
    found = {r[0]: r[1] for r in rows.groupBy("domain").count().collect()}
    size = [found.get(k, 0) for k in range(len(DOMAINS))]
    total = sum(size)
    each = rows.select("domain", F.explode("fs").alias("feature"))
    holders = each.groupBy("feature").agg(
        *(F.count_if(F.col("domain") == k).alias(f"n{k}") for k in range(len(DOMAINS)))
    )
    k = range(len(DOMAINS))
    mean = sum(F.col(f"n{i}") for i in k) / max(total, 1)
    share = [(F.col(f"n{i}") + _SMOOTH * mean) / (size[i] + _SMOOTH) for i in k]
    others = [
        (sum(F.col(f"n{j}") for j in k if j != i) + _SMOOTH * mean) / (total - size[i] + _SMOOTH) for i in k
    ]
    ratio = F.greatest(*(s / o for s, o in zip(share, others)))
    stray = sum(size[i] * F.pow(share[i] - mean, 2) / (mean * (1 - mean) + 1e-9) for i in k)
    best = holders.withColumn("stray", stray).where(
        (F.col("stray") >= LEAST_EFFECT * total)
        & (ratio >= LEAST_RATIO)
        & (sum(F.col(f"n{i}") for i in k) >= LEAST_ROWS)
    )
    best = best.orderBy(F.desc("stray"), "feature").limit(max_features)
    held = [F.least(s, F.lit(0.999)) for s in share]
    columns = [F.log(s / (1 - s)).alias(f"w{i}") for i, s in enumerate(held)]
    absent = [F.log(1 - s).alias(f"a{i}") for i, s in enumerate(held)]
    model = saved(best.select("feature", *columns, *absent), "mixing-model")
    start = model.agg(*(F.sum(f"a{i}") for i in k)).first()
    priors = [float(np.log(size[i] / total)) + (start[i] or 0.0) if size[i] else float("-inf") for i in k]
    return model.select("feature", *(f"w{i}" for i in k)), priors


def posteriors(docs: DataFrame, model: DataFrame, priors: list[float]) -> DataFrame:
    """``(k1, k2, doc_id, n_tokens, p0, p1, ...)`` per document row.  A text without a
    known feature has the priors; with no labelled row at all every domain is
    equally likely.  The model (a bounded number of short rows) is a literal of the
    plan, so a row is scored where it is read: one scan, no shuffle."""
    k = range(len(DOMAINS))
    rows = docs.select(
        *(c.alias(n) for c, n in zip(row_key(), ("k1", "k2"))), F.col("doc_id").cast("long").alias("doc_id"),
        n_tokens(F.col("text")).cast("long").alias("n_tokens"), "text",
    )
    known = sorted(model.collect())
    if all(p == float("-inf") for p in priors):
        known, priors = [], [0.0] * len(DOMAINS)
    start = F.array(*(F.lit(float(p)) for p in priors))
    if known:
        names = F.array(*(F.lit(r["feature"]) for r in known))
        weights = F.map_from_arrays(names, F.array(*(F.array(*(F.lit(float(r[f"w{i}"])) for i in k)) for r in known)))
        held = F.array_sort(F.array_intersect(features(F.col("text")), names))
        start = F.aggregate(held, start, lambda s, f: F.zip_with(s, F.element_at(weights, f), lambda a, b: a + b))
    told = rows.withColumn("w", start)
    top = F.array_max("w")
    odds = told.withColumn("e", F.transform("w", lambda x: F.exp(x - top)))
    total = sum(F.col("e")[i] for i in k)
    return odds.select("k1", "k2", "doc_id", "n_tokens", *((F.col("e")[i] / total).alias(f"p{i}") for i in k))


def _rate(steps: list[list[float]]) -> Column:
    """Rate of a document after these gradient steps."""
    p = F.array(*(F.col(f"p{i}") for i in range(len(DOMAINS))))
    if not steps:
        return F.lit(1.0)
    moves = F.array(*(F.array(*(F.lit(float(x)) for x in g)) for g in steps))
    dot = lambda g: F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(moves, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - dot(g)))


def fit_rates(members: DataFrame, target: dict[str, float]) -> tuple[list[list[float]], list[float]]:
    """The gradient steps whose rates bring the expected totals to the targets, and by how
    much of all tokens each domain's total still misses its target after them (steps
    end when all are near, when totals stand still, or after ``_STEPS``)."""
    k = range(len(DOMAINS))
    weight = np.array([target.get(d, 0.0) for d in DOMAINS], float)
    if (weight < 0).any() or weight.sum() <= 0:
        raise ValueError("target weights are nonnegative and not all zero")
    weight /= weight.sum()
    n = F.col("n_tokens")
    sums = members.agg(
        F.sum(n).alias("all"), *(F.sum(n * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"g{i}_{j}") for i in k for j in k)
    ).first()
    if not sums["all"]:
        return [], [0.0] * len(DOMAINS)
    gram = np.array([[sums[f"g{i}_{j}"] for j in k] for i in k]) / sums["all"]
    inverse = np.linalg.inv(gram + 1e-6 * np.eye(len(DOMAINS)))
    steps: list[list[float]] = []
    before = np.full(len(DOMAINS), np.inf)
    while True:
        now = members.select(*(F.sum(n * _rate(steps) * F.col(f"p{i}")) for i in k)).first()
        miss = np.array([float(x) for x in now]) / sums["all"] - weight
        if np.abs(miss).max() < _CLOSE or np.abs(miss - before).max() < _STILL or len(steps) == _STEPS:
            return steps, miss.tolist()
        before = miss
        steps.append((inverse @ miss).tolist())


def mix(docs: DataFrame, labels: DataFrame, target: dict[str, float] = TARGET, max_features: int = FEATURES) -> DataFrame:
    """``(k1, k2, doc_id, n_tokens, p_<domain>..., rate, copies, miss)`` per document row.
    ``copies`` turns the rate into a whole number: its floor, and one more where a
    hash of the id and text falls below the rest.  ``miss``, the same in every row, is
    the largest share of all tokens by which a domain's expected total misses its
    target.  Null and empty texts have no tokens and a rate like any other; a domain
    that no document can fill leaves its target unmet; labels of unknown documents
    count for nothing; rows equal in id and text are rows of their own with one rate."""
    model, priors = classifier(docs, labels, max_features)
    members = saved(posteriors(docs, model, priors), "mixing-members")
    steps, miss = fit_rates(members, target)
    rated = members.withColumn("rate", _rate(steps))
    chance = hash_share(F.xxhash64("k1", "k2", F.lit("mix")))
    return rated.select(
        "k1", "k2", "doc_id", "n_tokens",
        *(F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(DOMAINS)),
        "rate",
        F.floor(F.col("rate") + chance).cast("long").alias("copies"),
        F.lit(max(map(abs, miss))).alias("miss"),
    )


def mix_documents(docs: DataFrame, labels: DataFrame, target: dict[str, float] = TARGET) -> DataFrame:
    """``docs`` with ``rate`` and ``copies`` added; documents with no copy go.  Rows equal
    in id and text share their rate."""
    k1, k2 = fresh([*docs.columns, "rate", "copies"], "k1", "k2")
    found = mix(docs, labels, target).select(F.col("k1").alias(k1), F.col("k2").alias(k2), "rate", "copies")
    rows = docs.drop("rate", "copies").withColumns(dict(zip((k1, k2), row_key())))
    return rows.join(found.where("copies > 0").distinct(), [k1, k2]).drop(k1, k2)


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mix(docs, table(spark, sf_dir, "labels")).drop("k1", "k2")
