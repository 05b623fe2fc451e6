"""Language ID: held-out accuracy, rejection, edge cases."""

import random
import zlib

from pyspark.sql import functions as F

from cohortalloc.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = L.op10_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    tested = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.98 * len(tested)
    assert sum(r.rejected for r in found) <= 0.01 * len(found)


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.held_out(F.col("doc_id"))
    changed = docs.withColumn("lang", F.when(out, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = L.fit(docs), L.fit(changed)
    assert a.languages == b.languages and (a.centroids == b.centroids).all() and (a.floors == b.floors).all()


def test_far_text_is_rejected_and_near_text_kept():
    rnd = random.Random(5)
    word = lambda signs: "".join(rnd.choices(signs, k=rnd.randrange(2, 8)))
    text = lambda signs: " ".join(word(signs) for _ in range(80))
    import numpy as np

    texts = [text("abcde") for _ in range(60)] + [text("mnopq") for _ in range(60)]
    model = L.fit_sample(["a", "m"], np.repeat([0, 1], 60), np.stack([L.trigram_counts(t) for t in texts]))
    names, _, rejected = L._judge(model, [text("abcde"), text("mnopq"), text("vwxyz"), "1 2 3", ""])
    assert names[:2] == ["a", "m"] and names[3:] == ["und", "und"]
    assert rejected == [False, False, True, True, True]


def foreign(rnd, signs, letters):
    return " ".join("".join(rnd.choices(signs, k=rnd.randrange(3, 8))) for _ in range(letters // 5))


def test_rejection_does_not_depend_on_the_size_of_the_table(spark):
    docs = [spark.read.parquet(f"/root/testdata/{sf}/documents.parquet") for sf in ("sf0.001", "sf0.01")]
    small, large = map(L.fit, docs)
    assert (small.floors > 0).all() and (large.floors > 0).all()
    assert (abs(small.floors[4:10] / large.floors[4:10] - 1) < 0.35).all()
    rnd = random.Random(8)
    for signs in ("αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзиклмнопрстуфхцч", "qwxzkvjpyg"):
        for letters in (20, 40, 80, 160, 400, 2000):
            texts = [foreign(rnd, signs, letters) for _ in range(40)]
            for model in (small, large):
                assert sum(L._judge(model, texts)[2]) >= (0.85 if letters < 80 else 1) * len(texts), (signs, letters)
    for frame, model in zip(docs, (small, large)):
        own = [r.text for r in frame.where("length(text) > 0").select("text").collect()]
        for n in (20, 40, 80, 100_000):
            texts = [t[:n] for t in own if L.has_letter(t[:n])]
            assert sum(L._judge(model, texts)[2]) <= 0.02 * len(texts), n


def test_few_sample_texts_still_reject():
    import numpy as np

    texts = [("the cat sat on the mat and the dog ran " * 3)[: 90 + i] for i in range(4)]
    model = L.fit_sample(["en"], np.zeros(4, int), np.stack([L.trigram_counts(t) for t in texts]))
    assert L._judge(model, ["ψωφχ ξζθλ", "ξζθλ ψωφχ " * 30, "the cat and the dog"])[2] == [True, True, False]
    one = L.fit_sample(["en"], np.zeros(1, int), np.stack([L.trigram_counts(texts[0])]))
    assert L._judge(one, ["ψωφχ ξζθλ", texts[0]])[2] == [True, False]


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, "123 !"), (3, "hello there"), (3, "hello there"), (None, "x " * 100_000)])
    assert L.fit(docs) is None
    rows = L.predict(docs, None).collect()
    assert {r.lang_pred for r in rows} == {"und"} and len(rows) == 5
    some = docs.withColumn("lang", F.when(F.col("doc_id") == 3, "en"))
    model = L.fit(some)
    if model:  # 3 may be held out
        kept = L.keep_known(some, model)
        assert kept.columns == docs.columns and kept.where("doc_id in (1, 2)").count() == 0
    assert L.fit(make_docs([])) is None
    assert L.predict(make_docs([]), None).count() == 0


def plain_model(languages, label, counts):
    """Centroids and idf by plain loops over Python lists."""
    import math

    n, used = len(counts), [dict(enumerate(row.tolist())) for row in counts]
    used = [{d: c for d, c in row.items() if c} for row in used]
    idf = [math.log((1 + n) / (1 + sum(d in row for row in used))) + 1 for d in range(L.DIM)]

    def unit(vector):
        size = math.sqrt(sum(x * x for x in vector.values()))
        return {d: x / size for d, x in vector.items()} if size else {}

    def dot(a, b):
        return sum(x * b.get(d, 0.0) for d, x in a.items())

    def total(vectors):
        out = {}
        for v in vectors:
            for d, x in v.items():
                out[d] = out.get(d, 0.0) + x
        return out

    rows = [unit({d: math.log1p(c) * idf[d] for d, c in row.items()}) for row in used]
    centroids, owner = [], []
    for i in range(len(languages)):
        own = [r for r, at in zip(rows, label) if at == i]
        mean = total(own)
        chosen = [max(range(len(own)), key=lambda j: dot(own[j], mean))]
        while len(chosen) < min(L.CENTROIDS, len(own)):
            chosen.append(min(range(len(own)), key=lambda j: max(dot(own[j], own[c]) for c in chosen)))
        held = [own[c] for c in chosen]
        for _ in range(L.ROUNDS):
            near = [max(range(len(held)), key=lambda k: dot(r, held[k])) for r in own]
            held = [unit(total(r for r, at in zip(own, near) if at == k)) if k in near else held[k] for k in range(len(held))]
        centroids += held
        owner += [i] * len(held)

    def judge(row):
        vector = unit({d: math.log1p(c) * idf[d] for d, c in enumerate(row.tolist()) if c})
        scores = [dot(vector, c) for c in centroids]
        best = max(range(len(scores)), key=lambda k: scores[k])
        return languages[owner[best]], scores[best]

    return judge


def test_predictions_equal_plain_clustering_and_cosines(spark):
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) between 200 and 1500").orderBy("doc_id").collect()
    learn, asked = docs[:60], docs[60:100]
    languages = sorted({r.lang for r in learn})
    label = np.array([languages.index(r.lang) for r in learn])
    counts = np.stack([L.trigram_counts(r.text) for r in learn])
    model, judge = L.centroids_of(languages, label, counts), plain_model(languages, label, counts)
    assert len(languages) > 1 and len(asked) > 20
    tested = np.stack([L.trigram_counts(r.text) for r in asked])
    best, cosine, _ = model.score(tested)
    for i, row in enumerate(tested):
        name, score = judge(row)
        assert model.languages[best[i]] == name and abs(score - cosine[i]) < 1e-4
