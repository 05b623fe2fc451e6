"""Source divergence audit: brute force, SQL, refinement level by level, tiles of sources."""

import re
from collections import Counter, defaultdict

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortalloc.llm import iceberg_audit as ia

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, tile int, block string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "t", 1, 2, "b") for i, r in enumerate(rows)], SCHEMA)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, min_docs=10, top=10):
    docs, groups = Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        docs.update({(lang or "", t) for t in terms(text)})
        groups[lang or "", source or ""].update(terms(text))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (g, t), n in docs.items() if g == lang and n >= min_docs]
        own = {s: c for (g, s), c in groups.items() if g == lang}
        own[None] = sum(own.values(), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in own.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s, c in own.items()}
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own.keys() - {None}:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o) for o in own if o not in (s, None)]
            over = [(-far(p[s][t], p[None][t]), t) for t in kept if own[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pairs), ("term", over)):
                for i, (value, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))):
                    if part == "pair" or i < top:
                        out.append((lang, s, part, item, -value, i + 1))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    import random

    random.seed(5)
    words = ["a", "ab", "abc", "abcd", "abcde", "Abcdefgh", "abcdefghi", "é", "éè", "日本", "日本語", "x" * 40, "x" * 41, "rare"]
    rows = [(" ".join(random.choices(words[: 4 + i % 11], k=25)) + f" only{'z' * (i % 30)} 1_2",
             ["en", "fr", None][i % 3], ["s1", "s2", None, "s4", "s5"][i % 5]) for i in range(180)]
    rows += rows[:15] * 2  # repeated rows count again
    return rows + [(None, "en", "silent"), ("", "de", "a"), ("12 34", "de", "b"), ("lone", "es", "s1"), (None, None, None)]


def test_equals_brute_force(spark, texts):
    got = ia.audit(frame(spark, texts))
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    assert rows_of(got) == brute(texts)


def test_small_blocks_tiles_and_a_crowded_filter(spark, texts, monkeypatch):
    monkeypatch.setattr(ia, "TERMS", 3)
    monkeypatch.setattr(ia, "MATRIX", 12)
    monkeypatch.setattr(ia, "TILE", 2)
    monkeypatch.setattr(ia, "FILTER_BITS", 8)  # nearly every bit is shared
    assert rows_of(ia.audit(frame(spark, texts))) == brute(texts)


def test_counts_are_added_up_as_they_arrive(spark, texts, monkeypatch):
    monkeypatch.setattr(ia, "CHARS", 300)  # many blocks of text
    monkeypatch.setattr(ia, "PENDING", 2)
    monkeypatch.setattr(ia, "TERMS", 3)
    assert rows_of(ia.audit(frame(spark, texts))) == brute(texts)
    held = ia.materialise(ia.blocks(frame(spark, texts), "text", "lang", "source"), "test-many")
    plan = ia.cells(held, ia.kept_terms(held), 2, 1)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "CoGroup" not in plan  # no group is one table


def test_remembered_answers_and_stored_rows_are_bounded(spark, texts, monkeypatch):
    monkeypatch.setattr(ia, "REMEMBERED", 10)
    known = ia.Filter({0: b"\xff" * 4096}, ia.BITMAP)
    for lang in ("en", "fr", "de"):
        assert known.among(lang, [b"%d" % i for i in range(100)]) == [True] * 100
        assert sum(map(len, known.known.values())) <= 10
    monkeypatch.setattr(ia, "CHARS", 300)
    held = ia.materialise(ia.blocks(frame(spark, texts).coalesce(1), "text", "lang", "source"), "test-groups", row_group=1)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in held.inputFiles()]
    assert sum(f.num_rows for f in files) > 10 and all(f.num_row_groups == f.num_rows for f in files)


def test_levels_keep_exactly_the_frequent_prefixes(spark, texts):
    held = ia.materialise(ia.blocks(frame(spark, texts), "text", "lang", "source"), "test-blocks")
    before = None
    for length in (2, 4, 8):
        level = ia.counted(held, length, before).where(F.col("docs") >= 10)
        got = {(r["lang"], bytes(r["prefix"])): r["docs"] for r in level.collect()}
        expected = Counter()
        for text, lang, _ in texts:
            found = {t.encode() for t in terms(text)}
            expected.update({(lang or "", ia.prefix_of(t, length)) for t in found if len(t) > length // 2 or length == 2})
        assert got == {k: n for k, n in expected.items() if n >= 10}
        before = ia.filter_of(level.where(F.substring("prefix", -1, 1) != F.lit(b"\0")))


def test_registered_query_equals_its_sql(spark):
    got = ia.op12_iceberg_audit(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert rows_of(got) == sorted(con.execute(f"select {', '.join(got.columns)} from ({ia.OP12_SQL})").fetchall())


def test_empty_and_termless_tables(spark):
    one = frame(spark, [("12", "en", "a"), (None, "en", "b")])
    assert ia.audit(one.limit(0)).count() == 0
    assert rows_of(ia.audit(one)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
