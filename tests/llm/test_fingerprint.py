"""Fingerprints: estimates against true likeness, next documents, edge cases."""

import hashlib

from pyspark.sql import functions as F

from cohortalloc.llm import fingerprint as G

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + G.SHINGLE]) for i in range(len(w) - G.SHINGLE + 1)} or {tuple(w)}


def test_estimates_edits_and_next_documents(spark):
    rows = sorted(G.op1_fingerprint(spark, SF).collect(), key=lambda r: r.doc_id)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    errors = []
    for i, (row, text) in enumerate(zip(rows, texts, strict=True)):
        other, half = texts[(i + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(text)
        for got, b in ((row.near_edited, edited), (row.near_next, other)):
            x, y = shingles(text), shingles(b)
            errors.append(abs(got - len(x & y) / len(x | y)))
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.2
    by_text = {}
    assert all(by_text.setdefault(t, r.fingerprint) == r.fingerprint for t, r in zip(texts, rows))


def test_native_plan(spark):
    plan = G.op1_fingerprint(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_densification_fills_every_bin_alike(spark, make_docs):
    rows = G.with_fingerprint(make_docs([(1, "a b c d e"), (2, "a b c d e"), (3, "a b c d e f"), (4, "q")]), "text", "f")
    got = {r.doc_id: r.f for r in rows.select("doc_id", "f").collect()}
    assert got[1] == got[2] and len(set(got[1])) == 1 and len({x & 255 for x in got[3]}) <= 2


def test_edge_cases(spark, make_docs):
    docs = make_docs([(3, "a b c d e f g"), (1, None), (None, "x y z x y z"), (7, ""), (9, "a " * 30_000), (3, "a b c d e f g"), (2, "   ")])
    rows = G.with_next(G.with_fingerprint(docs.withColumn("text", F.coalesce("text", F.lit(""))), "text", "own"),
                       "doc_id", "text", ["text"])
    got = sorted(((str(r.doc_id), r.next_text) for r in rows.select("doc_id", "next_text").collect()), key=str)
    seven = "a b c d e f g"
    assert got == sorted([("1", "   "), ("2", seven), ("3", seven), ("3", ""), ("7", "a " * 30_000), ("9", ""), ("None", None)], key=str)
    one = G.with_next(G.with_fingerprint(make_docs([(5, "a")]), "text", "own"), "doc_id", "text", ["text"])
    assert [r.next_text for r in one.collect()] == ["a"]
    assert G.with_next(G.with_fingerprint(make_docs([]), "text", "own"), "doc_id", "text", ["text"]).count() == 0
