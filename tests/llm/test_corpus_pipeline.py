from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from riverload.llm import decontaminate, quality, simhash
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    first, lines, near, clean = kept.values()
    source = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r.doc_id for r in source.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality = 0").collect()}
    assert len(bad & first.keys()) <= 0.3 * len(bad) and len(first) > 0.8 * source.count()
    assert lines.keys() == first.keys()
    prints = [(i, brute_print(t)) for i, t in lines.items()]
    assert set(near) == {c for _, _, c in brute_components(prints)}
    items = [d for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (d := " ".join(decontaminate.words(r.text)))]
    leaked = {i for i, t in near.items() if any(f" {d} " in f" {' '.join(decontaminate.words(t))} " for d in items)}
    assert set(clean) == set(near) - leaked
    packed = pipeline.run(spark, SF).collect()
    check(packed, list(clean.items()))


def test_keep_one_of_each_group(spark):
    rows = [(3, "same words in here", 1), (2, "same words in here", 1), (2, "same words in here", 1), (2, "an altogether different text of words", 1), (None, "same words in here", 1),
            (None, "nothing like it at all", 1), (5, None, 1), (4, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component long")
    got = sorted(map(tuple, simhash.keep_one(df).collect()), key=str)
    assert got == sorted([(2, "same words in here", 1), (2, "an altogether different text of words", 1), (None, "nothing like it at all", 1), (4, "", 1)], key=str)


def test_odd_rows_pass_all_stages(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    extra = "Plain words of an ordinary text stand in this document. " * 5
    odd = [(None, extra, None, None, None), (1, None, "en", "a", 0), (1, "", "en", "a", 0), (2, extra + "x", "en", "b", 9), (2, extra + "x", "en", "b", 9),
           (3, "word and word again " * 30_000, "en", "c", 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert (docs.count() > 0) == bool(rows)


def test_rejected_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r.doc_id for r in pipeline.quality_classifier(spark, docs, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where(quality.held_out(F.col("doc_id"))).collect()
    wrong = [r.doc_id for r in labels if (r.doc_id in kept) != bool(r.quality)]
    assert len(wrong) <= 0.05 * len(labels)
