"""Mixing: rates against a plain projected gradient, targets, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from cohortalloc.llm import soft_mixing as M

SF = "/root/testdata/sf0.01"


def plain_rates(t, p, weights):
    """Nonnegative rates next to 1 that meet the targets: a plain projected gradient, many small steps."""
    target = np.array(weights) * t.sum()
    metric = np.linalg.pinv((p * t[:, None]).T @ p)
    rate = np.ones(len(t))
    for _ in range(20_000):
        miss = (rate * t) @ p - target
        if np.abs(miss).max() <= 1e-9 * t.sum():
            break
        rate = np.maximum(0, rate - p @ (0.5 * metric @ miss))
    return rate, np.abs((rate * t) @ p - target).max() / t.sum()


def fitted(spark, t, p, weights):
    rows = spark.createDataFrame(
        [(i, float(x), [float(v) for v in y]) for i, (x, y) in enumerate(zip(t, p))],
        "doc_id long, _tokens double, _p array<double>",
    )
    got, steps, miss = M.fit_rates(rows, weights)
    return got.withColumn("again", M.rate_of(F.col("_p"), steps)).orderBy("doc_id").toPandas(), steps, miss


def test_rates_meet_targets_and_follow_from_the_steps(spark):
    rnd = np.random.default_rng(2)
    t = rnd.integers(1, 500, 400).astype(float)
    p = rnd.dirichlet([0.3, 0.3, 0.3], 400)
    for weights in ([0.6, 0.3, 0.1], [0.05, 0.05, 0.9]):
        got, _, miss = fitted(spark, t, p, weights)
        assert np.allclose(got["_rate"], got["again"], atol=1e-9)
        assert (got["_rate"] >= 0).all()
        reached = np.abs((got["_rate"] * t) @ p / t.sum() - weights).max()
        assert reached <= 1e-4 and abs(reached - miss) < 1e-9
        want, plain_miss = plain_rates(t, p, weights)
        assert plain_miss < 1e-4 and np.abs(got["_rate"] - want).mean() < 0.05 * want.mean()


def test_overlapping_domains_meet_a_target_that_can_be_met(spark):
    p = np.array([[0.45, 0.55], [0.55, 0.45]] * 15)
    got, steps, miss = fitted(spark, np.full(30, 10.0), p, [0.54, 0.46])
    assert miss <= 1e-4 and np.abs(got["_rate"].to_numpy() @ p / 30 - [0.54, 0.46]).max() <= 1e-4
    assert sorted(set(got["_rate"].round(3))) == [0.2, 1.8]


def test_targets_out_of_reach_say_how_much_is_missing(spark):
    # no nonnegative rates turn 45 to 55 percent of a domain into 90
    p = np.array([[0.45, 0.55], [0.55, 0.45]] * 15)
    t = np.full(30, 10.0)
    got, steps, miss = fitted(spark, t, p, [0.9, 0.1])
    assert miss > 0.01 and len(steps) < 1000
    want, plain_miss = plain_rates(t, p, [0.9, 0.1])
    assert abs(miss - plain_miss) < 0.01 * plain_miss + 1e-4
    assert np.allclose(got["_rate"], want, atol=0.02)


def test_classifier_equals_a_plain_count(spark, make_docs):
    import math

    import regex

    rnd = np.random.default_rng(4)
    words = [f"w{chr(97 + i)}" for i in range(20)]
    texts, labels = [], []
    for i in range(120):
        domain = ["good", "poor", "toxic"][i % 3]
        pick = rnd.choice(words[: 12] if domain == "good" else words[4:], 30).tolist() + (["zzz"] if domain == "toxic" else [])
        texts.append(" ".join(pick))
        labels.append(domain)
    texts += ["wa wb zzz", "", None]
    docs = make_docs(list(enumerate(texts)))
    labelled = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "doc_id long, domain string")
    domains = ["good", "poor", "toxic"]
    model = M.train(docs, labelled, domains)
    rows = M.with_posteriors(docs.select("doc_id", "text"), model, domains)
    got = {r.doc_id: r["_p"] for r in rows.collect()}

    def features(text):
        pieces = regex.findall(M.PIECES, (text or "").lower())
        kinds = 0 if len(pieces) < 20 else 1 if len(pieces) < 200 else 2
        share = min(7, 8 * len(set(pieces)) // max(1, len(pieces)))
        return len(pieces), [("word", w) for w in sorted(set(pieces))], ("kind", kinds, share)

    counts = {"word": {d: {} for d in domains}, "kind": {d: {} for d in domains}}
    for text, domain in zip(texts, labels):
        _, found, kind = features(text)
        for f in [*found, kind]:
            held = counts[f[0]][domain]
            held[f] = held.get(f, 0) + 1

    def weight(f, domain):
        held = counts[f[0]]
        total = {d: sum(held[d].values()) for d in domains}
        names = {x for d in domains for x in held[d]}
        overall = {x: sum(held[d].get(x, 0) for d in domains) / sum(total.values()) for x in names}

        def drawn(x):
            seen, expected = held[domain].get(x, 0), overall.get(x, 0) * total[domain]
            ratio = math.log((seen + M.SHRINK) / (expected + M.SHRINK))
            surprise = 2 * ((seen + M.SHRINK) * ratio - (seen - expected))
            return ratio * surprise**2 / (surprise**2 + M.CHANCE**2)

        return drawn(f) - math.log(sum(overall[x] * math.exp(drawn(x)) for x in names))

    for i, text in enumerate(texts):
        _, found, kind = features(text)
        scores = [math.log(labels.count(d) / len(labels)) + sum(weight(f, d) for f in [*found, kind]) for d in domains]
        top = max(scores)
        want = [math.exp(s - top) / sum(math.exp(x - top) for x in scores) for s in scores]
        assert np.allclose(got[i], want, atol=1e-6), (i, got[i], want)


def test_labels_outside_the_sample_at_two_sizes(spark):
    # half of the labels teach, the other half judges
    for sf, good, toxic in (("/root/testdata/sf0.1", 0.97, 0.55), ("/root/testdata/sf0.01", 0.97, 0.4)):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        labelled = M.label_domain(spark.read.parquet(f"{sf}/labels.parquet"))
        half = F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(2))
        model = M.train(docs, labelled.where(half == 0), list(M.TARGETS))
        rows = M.with_posteriors(docs.select("doc_id", "text"), model, list(M.TARGETS)).join(labelled.where(half == 1), "doc_id")
        best = F.array_position("_p", F.array_max("_p")).cast("int")
        found = rows.select("domain", F.element_at(F.array(*map(F.lit, M.TARGETS)), best).alias("got")).toPandas()
        share = {d: (g["got"] == d).mean() for d, g in found.groupby("domain")}
        assert share["good"] >= good and share["toxic"] >= toxic, (sf, share)


def test_documents_are_classified_and_weighted(spark):
    # a table with several hundred toxic labels: fewer teach too few words that are not learned by heart
    sf = "/root/testdata/sf0.1"
    rows = M.op8_soft_mixing(spark, sf)
    found = rows.join(M.label_domain(spark.read.parquet(f"{sf}/labels.parquet")).withColumnRenamed("domain", "true"), "doc_id")
    found = found.toPandas()
    assert rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert (found.domain == found.true).mean() > 0.9
    good = found[found.true == "good"]
    assert (good.copies >= 1).mean() > 0.95
    toxic = found[found.true == "toxic"]
    assert (toxic.copies == 0).mean() > 0.8


def test_native_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = M.with_posteriors(docs, [[0.0] * (1 + M.BUCKETS + M.RATIOS)] * 2, ["a", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "good words here"), (3, "good words here"), (None, "bad bad"), (4, "w " * 50_000)])
    labelled = spark.createDataFrame([(3, "good"), (99, "good"), (None, "poor"), (4, None)], "doc_id long, domain string")
    mixed = M.mix(docs, labelled, {"good": 1.0, "poor": 0.0})
    assert mixed.columns == docs.columns
    none = spark.createDataFrame([], "doc_id long, domain string")
    _, rows, _, _ = M.solve(docs, none, {"good": 0.5, "poor": 0.5})
    assert {tuple(r["_p"]) for r in rows.collect()} == {(0.5, 0.5)}
    assert M.mix(make_docs([]), labelled, {"good": 1.0}).count() == 0


def test_columns_of_any_name_come_through_unchanged(spark):
    rows = [(i, f"good words number {i}", i + 0.5, "s", i, [1.0, 2.0], "c") for i in range(8)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, _tokens double, _s string, _copy int, _p array<double>, row string")
    labelled = spark.createDataFrame([(0, "good"), (1, "poor")], "doc_id long, domain string")
    mixed = M.mix(docs, labelled, {"good": 0.5, "poor": 0.5})
    assert mixed.columns == docs.columns
    assert {tuple(map(str, r)) for r in mixed.collect()} <= {tuple(map(str, r)) for r in rows}
    assert mixed.count() > 0
