"""The pipeline's stages on small data: what goes, what stays, and the columns."""

import corpus_pipeline as P
from edge import TEXTS

from tidemark.session import scratch_path

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def awkward(spark, rows=None):
    rows = TEXTS if rows is None else rows
    extra = docs_of(spark).limit(0)
    own = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs_of(spark).unionByName(own) if rows else extra


def test_stages_in_order():
    assert [name for name, _ in P.STAGES] == ["language_id", "quality", "simhash_dedup", "secret_scan", "packing"]
    assert P.ORACLE_SQL is None


def test_stages_one_after_the_other(spark):
    docs = awkward(spark)
    counts = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if name == "language_id":  # only texts without a language go
            assert docs.where("text IS NULL OR trim(text) = ''").count() == 0 and counts[-1] >= 1000
        if name == "simhash_dedup":
            assert docs.count() == docs.select("text").distinct().count()
        if name == "secret_scan":
            assert docs.where("text RLIKE '[0-9a-f]{32}'").count() == 0 and docs.where("text LIKE '%[SECRET]%'").count() > 0
            assert docs.where("n_chars != length(text)").count() == 0
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4]
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_clean_documents_stay(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs_of(spark).join(labels.where("quality = 1"), "doc_id", "left_semi")
    kept = P.quality_stage(spark, P.language_stage(spark, docs, SF), SF)
    assert kept.count() >= 0.97 * docs.count()


def test_empty_table(spark):
    docs = docs_of(spark).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0
