"""Phrase mining: brute force and SQL, at budgets that extend prefixes to every level."""

import re
from collections import Counter

import duckdb
import pytest

from cohortalloc.llm import phrase_mining as pm

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, phrase string, words int, f long, n string, key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, 2, "n", 3) for i, (t, g) in enumerate(rows)], SCHEMA)


def brute(rows, min_count=10, top=None):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", small):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {k: v for k, v in counts.items() if v >= min_count and len(k) > 2}
    out = []
    for (lang, *words), a in found.items():
        if any(100 * f >= 50 * a and len(o) > len(words) + 1 and o[0] == lang
               and any(list(o[i : i + len(words)]) == words for i in range(1, len(o) - len(words) + 1))
               for o, f in found.items()):
            continue
        score, _, l, r = min(
            (10**6 * a * a // (counts[(lang, *words[:k])] * counts[(lang, *words[k:])]), k,
             counts[(lang, *words[:k])], counts[(lang, *words[k:])]) for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), l, r, sizes[lang]))
    ranked, place = [], Counter()
    for lang, score, a, phrase, l, r, n in sorted(out):
        place[lang] += 1
        ranked.append((lang, place[lang], phrase.decode(), -a, l, r, n, -score))
    return [x for x in ranked if top is None or x[1] <= top]


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def texts():
    import random

    random.seed(3)
    words = ["the", "The", "of", "é", "ÉA", "x-1", "new", "york", "it's", " z"]
    rows = []
    for i in range(150):
        body = [random.choice(words[: 3 + i % 7]) + random.choice(["", "", "", ",", ".\n", "\t", "!?", "  "]) for _ in range(60)]
        rows.append((" ".join(body) + " new york city", ["en", "fr", None][i % 3]))
    return rows + rows[:20] * 2 + [(None, "en"), ("", "de"), (" \t.,", None), ("lone words here", "de")]


@pytest.mark.parametrize("budget", [1 << 21, 300, 20])
def test_equals_brute_force_at_every_budget(spark, texts, budget, monkeypatch):
    monkeypatch.setattr(pm, "SLOTS", 64)  # many prefixes share a slot
    got = pm.collocations(frame(spark, texts), budget=budget, top=40)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(c, "bigint") for c in (
        "a", "l", "r", "n", "score")]]
    assert rows_of(got) == sorted(brute(texts, top=40))


def test_small_budgets_extend_the_prefixes_of_hot_words(spark, texts):
    held = pm.materialise(pm.blocks(frame(spark, texts), "text", "lang"), "test-blocks")
    assert len(pm.partition(held, 10_000, 1 << 21).levels) == 1
    plan = pm.partition(held, 10_000, 20)
    assert len(plan.levels) == pm.DEPTH and (plan.levels[0] < 0).any() and plan.n_groups > 10


def test_registered_query_equals_its_sql(spark):
    got = rows_of(pm.op11_phrase_mining(spark, SMALL))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    columns = "lang, rank, phrase, a, l, r, n, score"
    assert got == sorted(con.execute(f"select {columns} from ({pm.OP11_SQL})").fetchall())
    assert len(got) > 100


def test_one_very_long_text_and_huge_counts(spark):
    text = "aa bb cc " * 30_000 + "dd"
    got = rows_of(pm.collocations(frame(spark, [(text, "en")]), budget=50))
    assert got == sorted(brute([(text, "en")]))


def test_empty_and_wordless_tables(spark):
    empty = frame(spark, [("x", "en")])
    assert pm.collocations(empty.limit(0)).count() == 0
    assert pm.collocations(frame(spark, [(None, None), ("", "en"), (". ,", "fr")])).count() == 0
    assert pm.collocations(empty).count() == 0
