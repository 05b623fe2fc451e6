"""Multi-index hashing: complete probing, recall against brute force, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from cohortalloc.llm import multi_index_hashing as mih

SCHEMA = "vec_id long, embedding array<double>, rank int, key string, dim int"


def brute(ids, vectors, k, wanted):
    out = {}
    for a in wanted:
        scores = np.zeros(len(ids))
        for d in range(vectors.shape[1]):
            scores += vectors[:, d] * vectors[a, d]
        rows = np.flatnonzero(ids != ids[a])
        best = rows[np.lexsort((ids[rows], -scores[rows]))[:k]]
        out[int(ids[a])] = [(int(ids[b]), float(scores[b])) for b in best]
    return out


def test_probing_finds_every_code_within_the_radius():
    random = np.random.default_rng(1)
    codes = random.integers(0, 256, (500, 4), np.uint8)
    block = mih.Block(np.arange(500), random.normal(size=(500, 3)), codes)
    for radius in range(0, 33, 3):
        for i in range(0, 500, 50):
            near = np.flatnonzero(np.bitwise_count(codes ^ codes[i]).sum(axis=1) <= radius)
            assert block.within(codes[i], radius).tolist() == near.tolist()


def test_recall_and_scores_of_the_registered_query(spark):
    folder = "/root/testdata/sf0.1"
    got = mih.op13_multi_index_hashing(spark, folder).toPandas()
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, vectors = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    truth = brute(ids, vectors, 20, np.flatnonzero(ids % 20 == 0))
    assert got.dtypes.astype(str).to_dict() == {
        "query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "float64"}
    found = 0
    for query, lines in got.groupby("query_id"):
        lines = lines.sort_values("rank")
        assert lines["rank"].tolist() == list(range(1, 21))
        exact = dict(truth[query])
        found += len(exact.keys() & set(lines["vec_id"]))
        assert all(exact.get(v, s) == s for v, s in zip(lines["vec_id"], lines["score"]))
        assert list(zip(-lines["score"], lines["vec_id"])) == sorted(zip(-lines["score"], lines["vec_id"]))
    assert set(truth) == set(got["query_id"])
    assert found / (20 * len(truth)) >= 0.9


def test_uneven_norms_and_copies(spark):
    random = np.random.default_rng(2)
    vectors = random.normal(size=(600, 16)) * random.uniform(0.2, 5, size=(600, 1))
    vectors[300:500] = vectors[0]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = mih.search(df, F.col("vec_id") % 20 == 0, k=10).toPandas()
    truth = brute(np.arange(600), vectors, 10, range(0, 600, 20))
    lists = {q: g.sort_values("rank")["vec_id"].tolist() for q, g in got.groupby("query_id")}
    assert lists[0] == [v for v, _ in truth[0]]
    assert sum(len(set(lists[q]) & {v for v, _ in truth[q]}) for q in truth) >= 0.9 * 10 * len(truth)


def test_edge_cases(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [0.0, 0.0]),
        (6, []), (None, [1.0, 1.0]), (7, [float("inf"), 0.0]), (20, [1.0, 0.0, 2.0]), (8, [1.0, 0.0]),
        (8, [1.0, 0.0]), (40, [-1.0, 0.0]), (40, [0.0, 1.0]),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 9) for r in rows], SCHEMA)
    got = {}
    for r in mih.search(df, F.col("vec_id") % 20 == 0, k=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got[0]) == [(1, 8, 1.0), (2, 8, 1.0), (3, 1, 0.5)]
    assert 20 not in got  # alone in its dimension
    # the id 40 asks twice, and neither of its rows is a candidate of the other
    assert sorted(got[40]) == [(1, 1, -0.5), (1, 1, 0.5), (2, 0, -1.0), (2, 0, 0.0), (3, 8, -1.0), (3, 8, 0.0)]
    assert mih.search(df.limit(0), F.col("vec_id") % 20 == 0, k=3).count() == 0
