"""Bit-sliced search against brute force and its SQL."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from cohortalloc.llm import bit_sliced_search as X

SF = "/root/testdata/sf0.01"


def best(v, keys, q, k):
    scores = v.astype(np.int64) @ v[q].astype(np.int64)
    return sorted((-int(s), int(key)) for s, key in zip(scores, keys) if key != keys[q])[:k]


def test_blocks_select_exactly():
    rnd = np.random.default_rng(1)
    for n, d, low, high in ((1, 3, -4, 5), (64, 5, -2, 3), (200, 8, -30, 31), (900, 16, 0, 2)):
        v, keys = rnd.integers(low, high, (n, d)), np.sort(rnd.choice(10 * n, n, replace=False))
        least = int(v.min())
        block = X.Block(keys, X.slices(v, least, max(1, int(v.max() - least).bit_length())), least)
        for q in range(0, n, max(1, n // 9)):
            hits, scores = block.top(v[q], int(keys[q]), 20)
            assert sorted(zip((-scores).tolist(), hits.tolist())) == best(v, keys, q, 20)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(X.OP3_SQL).df().sort_values(["query_id", "rank"])
    got = X.op3_bit_sliced_search(spark, SF).toPandas().sort_values(["query_id", "rank"])[list(want.columns)]
    assert len(got) == 500 and (got.to_numpy() == want.to_numpy()).all()


def test_several_blocks_ties_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(X, "MINI", 8)
    monkeypatch.setattr(X, "BLOCK", 2)
    monkeypatch.setattr(X, "LIST", 3)
    rnd = np.random.default_rng(3)
    v = rnd.integers(-2, 3, (120, 4))
    good = [(i, [float(x) / 64 for x in row], "extra") for i, row in enumerate(v)]
    bad = [(500, None, "e"), (520, [1.0, None, 0.0, 0.0], "e"), (540, [float("nan")] * 4, "e"), (560, [float("inf")] * 4, "e"),
           (None, [0.0] * 4, "e"), (580, [0.5, 0.5], "other dimension"), (600, [], "e")]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>, rank string")
    rows = X.search(df, F.col("vec_id") % 20 == 0, k=7, scale=64).collect()
    for q in range(0, 120, 20):
        got = [(-r.score, r.vec_id) for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q]
        assert got == best(v, np.arange(120), q, 7)
    assert {r.query_id for r in rows} == set(range(0, 120, 20))  # the one of another dimension has no candidate
    assert X.search(df.limit(0), F.col("vec_id") % 20 == 0, k=7, scale=64).count() == 0


def test_wide_numbers_and_repeated_query_ids_equal_the_sql(spark, monkeypatch):
    monkeypatch.setattr(X, "MINI", 8)
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=3)]) for i in range(50)]
    rows += [(60, [300000.0, -2.5, 1e9]), (61, [-1e9, 0.5, -300000.0]), (60, [0.25, 0.5, -0.125]), (20, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = X.search(df, F.col("vec_id") % 20 == 0, k=20, scale=64).toPandas()
    con = duckdb.connect()
    con.register("embeddings", df.toPandas().astype({"embedding": object}))
    want = con.execute(X.OP3_SQL).df()
    columns = ["query_id", "rank", "vec_id", "score"]
    as_rows = lambda d: sorted(d[columns].astype("int64").itertuples(index=False, name=None))
    assert as_rows(got) == as_rows(want)
    assert (got["query_id"] == 60).sum() == 40  # two rows of that id, a list each


def test_blocks_of_64_bit_numbers():
    v = np.array([[2**62, -3], [-(2**62), 5], [7, 1], [0, -1]], np.int64)
    low = int(v.min())
    block = X.Block(np.arange(4), X.slices(v, low, int(int(v.max()) - low).bit_length()), low)
    hits, scores = block.top(np.array([1, 2], np.int64), 99, 4)
    assert list(zip(scores.tolist(), hits.tolist())) == sorted(
        [(int(a) + 2 * int(b), i) for i, (a, b) in enumerate(v.tolist())], key=lambda x: list(scores).index(x[0]))
    import pytest

    with pytest.raises(OverflowError):
        block.top(np.array([4, 0], np.int64), 99, 4)
