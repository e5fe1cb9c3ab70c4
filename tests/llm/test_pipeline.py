"""The pipeline: columns between stages, and what its decisions must bring about."""

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import decontaminate

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    names, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == names
        assert docs.count() <= n
        n = docs.count()
    assert decontaminate.find(docs, bench).where("size(spans) > 0").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_odd_rows_and_empty_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, columns with names that operators use."""
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa the of and to in is was"
    rows = [(1, text, "en"), (1, text, "en"), (2, None, None), (2, None, None), (3, "", "en"), (None, text + " more", None), (4, "word and the " * 30_000, "en"), (5, "le la les des une dans que qui est pour", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("own_id", "own_th", "first_id", "found", "blocks", "hit_spans", "was_cut", "turn", "th", "__id", "a.b"):
        docs = docs.withColumn(name, F.lit("x"))
    for d, frame in (("odd", docs), ("none", docs.limit(0))):
        frame.write.parquet(f"{tmp_path}/{d}/documents.parquet")
        items = spark.createDataFrame([("i", "one two three four five six seven eight nine ten")], "item_id string, text string")
        items.limit(1 if d == "odd" else 0).write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, f"{tmp_path}/{d}").persist()
            assert now.columns == docs.columns
        out = corpus_pipeline.STAGES[-1][1](spark, now, f"{tmp_path}/{d}")
        kept = {r["doc_id"] for r in now.collect()}
        assert kept == ({1, 4, 5} if d == "odd" else set()) or kept == {1, 4, 5, None}
        assert {r["doc_id"] for r in out.collect()} == kept
