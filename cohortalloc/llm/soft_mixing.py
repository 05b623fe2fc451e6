"""Mixing to target weights with soft domain membership (DataFrame functions only).

Method.  A labelled table teaches a naive Bayes classifier on the distinct
words and sign runs of a text (hashed to ``BUCKETS``) and its share of
distinct words; it gives every document a posterior over the domains.  The
documents' rates r >= 0 (expected copies) then solve

    minimise  the squares of  sum_i r_i t_i p_id - T_d  over the domains d

where t_i are a document's tokens, p_id its posteriors and T_d its target
(weight times the tokens of all documents), by accelerated projected gradient
from r = 1.  The squares are taken in the metric of the inverse of the sum of
t_i p_i p_i', in which a step of length 1 is the longest safe one however much
the domains overlap: without documents at rate 0 it meets the targets at once.
Every step is one distributed sum of D numbers and one update of the rates,
projected on r >= 0.  Because a step changes a rate by the inner product of
p_i with the same D numbers for all documents, the list of steps is the whole
solution: a rate can be computed from a text alone, without a join.

Steps go on until the targets are met within ``TOLERANCE`` of all tokens, or
until they no longer come nearer: then no nonnegative rates reach the targets,
and the result says how much is missing (``miss``, a share of all tokens).

Fit.  The classifier learns from at most about ``TRAIN`` labelled documents,
chosen by a hash of the key; the least squares run over all documents.  A
word's weight for a domain is the log of (count + ``SHRINK``) over (expected
count + ``SHRINK``): the same rule at every size, under which a word seen once
says little and one seen often what its counts say.

Edge cases.  A NULL or empty text has no words and no tokens; its posterior
is that of the empty class of texts.  Labels without a key or domain, or of
unknown documents, are ignored; a key with several labels counts for each.
Without any usable label all posteriors are equal.  Repeated rows are
documents of their own; NULL keys are never labelled.  Domains of the
targets without a labelled row have posterior 0.  An empty table gives an
empty result.

Scale.  Texts are read twice (sample, posteriors) and never shuffled, but
for the sample's.  The driver sees one row per word bucket and domain, and
D x D sums.  Documents' small rows are written once, and again every
``UNROLL`` steps with the rates reached by then.  Columns of the documents
travel in one struct, so no name of theirs can clash with one used here.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import materialise, table

BUCKETS = 16384
RATIOS = 24
TRAIN = 20_000
#: Occurrences of a word as expected that stand against those seen.
SHRINK = 0.5
#: Likelihood ratio at which a word's weight is half of what its counts say.
CHANCE = 10.0
UNROLL = 16
TOLERANCE = 1e-4
#: Steps without a better miss (by a hundredth) that show the targets to be out of reach.
PATIENCE = 40
#: Words and runs of other signs.
PIECES = r"\p{L}+|[^\p{L}\s]+"

#: Domains of the standard labels and their target weights in the registered query.
TARGETS = {"good": 0.94, "poor": 0.05, "toxic": 0.01}


def label_domain(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the standard ``labels`` table."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    return labels.where("quality is not null and toxic is not null").select("doc_id", domain.alias("domain"))


def constant(values) -> Column:
    """An array constant that the optimizer folds into one literal."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_tokens`` and ``_features`` (bucket numbers, from 1)."""
    pieces = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(PIECES), F.lit(0))
    out = docs.withColumn("_pieces", pieces).withColumn("_distinct", F.array_distinct("_pieces"))
    # many repeats show in long texts only: length class (3) by share of distinct pieces (8)
    n = F.size("_pieces")
    length = F.when(n < 20, 0).when(n < 200, 1).otherwise(2)
    share = F.least(F.lit(7), F.floor(8 * F.size("_distinct") / F.greatest(n, F.lit(1))))
    extra = (BUCKETS + 1 + 8 * length + share).cast("int")
    words = F.transform("_distinct", lambda w: (F.pmod(F.xxhash64(w), F.lit(BUCKETS)) + 1).cast("int"))
    out = out.withColumn("_features", F.concat(words, F.array(extra)))
    return out.withColumn("_tokens", n.cast("double")).drop("_pieces", "_distinct")


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], key: str = "doc_id") -> list[list[float]]:
    """For each domain: log prior, then the log likelihood of every feature (empty: nothing labelled)."""
    labelled = labelled.where(F.col(key).isNotNull() & F.col("domain").isin(domains)).select(key, "domain")
    total = labelled.count()
    place = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    share = min(1.0, TRAIN / max(1, total))
    texts = docs.select(key, "text").where(place < share)
    rows = with_features(texts.join(labelled.where(place < share), key)).select("domain", "_features")
    marked = F.explode(F.concat(F.array(F.lit(0)), F.col("_features")))  # 0 counts the document
    counts = rows.select("domain", marked.alias("f")).groupBy("domain", "f").count().collect()
    size = 1 + BUCKETS + RATIOS
    seen = np.zeros((len(domains), size))
    for domain, f, n in counts:  # a row per domain and bucket at most
        seen[domains.index(domain), f] = n
    docs_of = seen[:, :1]
    if not docs_of.sum():
        return []
    with np.errstate(divide="ignore"):
        prior = np.log(docs_of / docs_of.sum())

    def weights(counts: np.ndarray) -> np.ndarray:
        """Log of seen over expected counts, times how far the two are from chance."""
        expected = counts.sum(axis=0) / max(1, counts.sum()) * counts.sum(axis=1, keepdims=True)
        ratio = np.log((counts + SHRINK) / (expected + SHRINK))
        surprise = 2 * ((counts + SHRINK) * ratio - (counts - expected))  # the likelihood ratio of a Poisson count
        drawn = ratio * surprise**2 / (surprise**2 + CHANCE**2)
        overall = counts.sum(axis=0) / max(1, counts.sum())
        return drawn - np.log((overall * np.exp(drawn)).sum(axis=1, keepdims=True))  # shares add up to 1 again

    words, kinds = seen[:, 1 : 1 + BUCKETS], seen[:, 1 + BUCKETS :]
    likelihood = np.hstack([prior, weights(words), weights(kinds)])
    likelihood[:, :1] = np.maximum(prior, -1e6)
    return likelihood.tolist()


def with_posteriors(docs: DataFrame, model: list[list[float]], domains: list[str]) -> DataFrame:
    """``docs`` with ``_tokens`` and ``_p`` (array, in the order of ``domains``)."""
    out = with_features(docs)
    if not model:
        equal = F.array(*[F.lit(1 / len(domains))] * len(domains))
        return out.withColumn("_p", equal).drop("_features")

    def score(weights: list[float]) -> Column:
        held = constant(weights)
        return F.aggregate("_features", F.lit(weights[0]), lambda s, f: s + F.element_at(held, f + 1))

    scores = [score(weights) for weights in model]
    out = out.withColumn("_s", F.array(*scores)).withColumn("_top", F.array_max("_s"))
    out = out.withColumn("_e", F.transform("_s", lambda s: F.exp(s - F.col("_top"))))
    total = F.aggregate("_e", F.lit(0.0), lambda a, e: a + e)
    out = out.withColumn("_sum", total).withColumn("_p", F.transform("_e", lambda e: e / F.col("_sum")))
    return out.drop("_features", "_s", "_top", "_e", "_sum")


def advanced(state: Column, p: Column, moves: list[list[float]]) -> Column:
    """(rate, rate one step before) after more steps; a step holds its momentum, then a number per domain."""
    if not moves:
        return state
    held = F.from_json(F.lit(json.dumps(moves)), "array<array<double>>")
    size = len(moves[0]) - 1

    def one(now, move):
        change = F.lit(0.0)
        for d in range(1, size + 1):
            change = change + F.element_at(p, d) * F.element_at(move, d + 1)
        ahead = now["rate"] + F.element_at(move, 1) * (now["rate"] - now["last"])
        return F.struct(F.greatest(F.lit(0.0), ahead - change).alias("rate"), now["rate"].alias("last"))

    return F.aggregate(held, state, one)


def start() -> Column:
    return F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("last"))


def rate_of(p: Column, steps: list[list[float]]) -> Column:
    """The rate that ``steps`` give to posteriors ``p``."""
    return advanced(start(), p, steps)["rate"]


def fit_rates(rows: DataFrame, weights: list[float]) -> tuple[DataFrame, list[list[float]], float]:
    """``rows`` (with ``_tokens`` and ``_p``) with ``_rate``, the steps that lead there, and the remaining miss."""
    size = len(weights)
    p = [F.element_at("_p", d + 1) for d in range(size)]
    t = F.col("_tokens")
    sums = rows.agg(
        F.sum(t), *[F.sum(t * x) for x in p], *[F.sum(t * x * y) for x in p for y in p]
    ).first()
    numbers = np.array([x or 0.0 for x in sums], float)
    total, plain, gram = numbers[0], numbers[1 : 1 + size], numbers[1 + size :].reshape(size, size)
    if not total:
        return rows.withColumn("_rate", F.lit(1.0)), [], 0.0
    target = np.array(weights) * total
    metric = np.linalg.pinv(gram, rcond=1e-12, hermitian=True)
    rows = rows.withColumn("_state", start())
    # now, before: the domains' tokens at the last rates and at those one step earlier; sums are linear in the rates
    steps, pending, now, before = [], [], plain, plain
    best, since, speed = np.inf, 0, 1.0
    while True:
        miss = float(np.abs(now - target).max() / total)
        since = 0 if miss < 0.99 * best else since + 1
        best = min(best, miss)
        if miss <= TOLERANCE or since >= PATIENCE:
            break
        faster = (1 + (1 + 4 * speed**2) ** 0.5) / 2
        ahead, speed = (speed - 1) / faster, faster
        if (metric @ (now - target)) @ (now - before) > 0:
            ahead, speed = 0.0, 1.0  # momentum leads away: start anew
        move = metric @ (now + ahead * (now - before) - target)
        pending.append([ahead, *move.tolist()])
        steps.append(pending[-1])
        if len(pending) == UNROLL:
            rows, pending = materialise(rows.withColumn("_state", advanced(F.col("_state"), F.col("_p"), pending)), "rates"), []
        reached = rows.withColumn("_now", advanced(F.col("_state"), F.col("_p"), pending)["rate"])
        before, now = now, np.array(reached.agg(*[F.sum(F.col("_now") * t * x) for x in p]).first(), float)
    out = rows.withColumn("_rate", advanced(F.col("_state"), F.col("_p"), pending)["rate"])
    return out.drop("_state"), steps, miss


def copies_of(rate: Column, key: Column) -> Column:
    """Whole copies whose mean over documents is the rate; fixed by the key."""
    place = F.pmod(F.xxhash64(key, F.lit(23)), F.lit(1 << 30)) / (1 << 30)
    return F.greatest(F.floor(rate + place).cast("int"), F.lit(0))


def solve(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id"):
    """(model, rows with key, ``_tokens``, ``_p`` and ``_rate``, steps, remaining miss)."""
    domains = list(targets)
    model = train(docs, labelled, domains, key)
    rows = with_posteriors(docs.select(key, "text"), model, domains).select(key, "_tokens", "_p")
    rows, steps, miss = fit_rates(materialise(rows, "posteriors"), list(targets.values()))
    return model, rows, steps, miss


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id") -> DataFrame:
    """``docs``, every row as often as its rate says; columns unchanged."""
    model, _, steps, _ = solve(docs, labelled, targets, key)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = with_posteriors(rows.withColumn("text", F.col("row").getField("text")), model, list(targets))
    # no filter on the copies: it would be pushed below the posteriors and compute them again and again
    copies = F.array_repeat(F.lit(0), copies_of(rate_of(F.col("_p"), steps), F.col("row").getField(key)))
    out = out.select("row", F.explode(copies).alias("_copy"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document, and the fit's remaining miss; see the module."""
    labelled = label_domain(table(spark, sf_dir, "labels"))
    _, rows, _, miss = solve(table(spark, sf_dir, "documents"), labelled, TARGETS)
    best = F.array_position("_p", F.array_max("_p"))
    return rows.select(
        "doc_id",
        F.col("_tokens").cast("long").alias("n_tokens"),
        F.element_at(F.array(*map(F.lit, TARGETS)), best.cast("int")).alias("domain"),
        *[F.element_at("_p", d + 1).alias(f"p_{name}") for d, name in enumerate(TARGETS)],
        F.col("_rate").alias("rate"),
        copies_of(F.col("_rate"), F.col("doc_id")).alias("copies"),
        F.lit(miss).alias("miss"),
    )
