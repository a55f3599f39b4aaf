"""The pipeline's stages against their brute-force versions on a small corpus."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from concordia.llm._cluster import ship

ORDER = ["quality rules", "quality classifier", "near dedup", "packing"]


def corpus(spark, folder):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    good = lambda: "\n".join(" ".join(word() for _ in range(12)) + "." for _ in range(8))
    rows, labels = [], []
    for i in range(120):
        text = good()
        rows.append((i, text, "clean"))
        labels.append((i, 1))
    for i in range(120, 180):
        rows.append((i, "\n".join(" ".join(word() + "###" for _ in range(12)) for _ in range(8)), "junk"))
        labels.append((i, 0))
    rows += [(200 + i, "again and again " * 40, "repeat") for i in range(5)] + [(220, None, "empty"), (221, "", "empty"), (222, "short text", "short")]
    rows += [(300 + i, rows[i][1] + " x", "copy") for i in range(10)]
    docs = ship(spark).createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages(spark, tmp_path):
    folder = str(tmp_path / "sf")
    corpus(spark, folder)
    assert [n for n, _ in corpus_pipeline.STAGES] == ORDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept.append({r.source for r in docs.select("source").distinct().collect()})
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert kept == [{"clean", "junk", "copy"}, {"clean", "copy"}, {"clean"}]
    assert docs.count() == 120
    packed = corpus_pipeline.run(spark, folder)
    assert packed.agg(F.count_distinct("doc_id")).first()[0] == 120


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
