"""The corpus pipeline on a small corpus: each stage's decisions take effect."""

import corpus_pipeline as P
from cohortalloc.llm import order_minhash
from cohortalloc.llm.common import materialise, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, after = docs.columns, {}
    for name, stage in P.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        after[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns, name
    whole = table(spark, SF, "documents")
    assert after["language"].count() >= 0.98 * whole.count()
    kept = after["near_dedup"]
    assert kept.count() == order_minhash.classes(after["language"]).select("class_id").distinct().count()
    assert kept.select("text").distinct().count() == kept.count()
    assert after["secrets"].count() == kept.count()
    assert after["secrets"].where("text rlike 'AKIA[A-Z0-9]{14,}'").count() == 0
    assert after["mixing"].select("doc_id").distinct().join(kept, "doc_id", "left_anti").count() == 0
    final = {(r.doc_id, r.decoded) for r in after["bpe"].collect()}
    assert final == {(r.doc_id, r.text) for r in after["mixing"].collect()}
    assert after["bpe"].count() == after["mixing"].count()


def test_run_and_names(spark):
    assert [n for n, _ in P.STAGES] == ["language", "near_dedup", "secrets", "mixing", "bpe"]
    assert P.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "decoded"]


def odd_corpus(spark):
    """Real documents with odd rows and with columns named like those the stages use inside."""
    docs = table(spark, SF, "documents").where("length(text) < 3000")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (900001, "", "en", "src1", 0), (900002, "12 34 !?", None, None, 8),
         (None, "The and of the in that with.", "en", None, 28), (900003, "short", "en", "src1", 5),
         (900004, "of the and in " * 20_000, "en", "src1", 280_000)],
        "doc_id long, text string, lang string, source string, n_chars long")
    whole = docs.unionByName(odd).unionByName(docs.where("doc_id < 40"))  # repeated rows
    names = ["_p", "_tokens", "_s", "_copy", "node", "_node", "_key", "row", "key", "label", "part", "bucket", "spans", "ids"]
    return whole.selectExpr("*", *[f"concat('{n}', coalesce(doc_id, 0)) AS `{n}`" for n in names]), names


def test_odd_rows_and_clashing_columns_pass_all_stages(spark):
    docs, names = odd_corpus(spark)
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = materialise(stage(spark, docs, SF), f"odd-{name}")
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns, name
            # every extra column still belongs to its row
            for n in names:
                assert docs.where(f"`{n}` != concat('{n}', coalesce(doc_id, 0))").count() == 0, (name, n)
        if name == "near_dedup":
            assert docs.count() == docs.select("text").distinct().count() > 50
    assert docs.count() > 50 and docs.where("doc_id in (900001, 900002)").count() == 0


def test_an_empty_corpus_passes_all_stages(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in P.STAGES:
        docs = materialise(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0, name
