import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import langid as L

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(4000)
    model = L.train(docs, L.fold(F.col("doc_id")) != 1)
    rows = L.detect(docs.filter(L.fold(F.col("doc_id")) == 1), model).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows) and len(rows) > 1000
    right = np.array([r.lang == r.lang_pred for r in rows])
    score = np.array([r.score for r in rows])
    assert right.mean() >= 0.97
    assert abs(score.mean() - right.mean()) < 0.03
    assert (model.w == 0).mean() > 0.2  # sparse


def test_counts_equal_a_plain_count(monkeypatch):
    text = "Aé!中 ab\nab" * 7
    whole = L.counts(text)
    assert whole.sum() == sum(len(text) - n + 1 for n in L.SIZES)
    monkeypatch.setattr(L, "PIECE", 8)
    assert (L.counts(text) == whole).all()
    assert L.counts("").sum() == 0 and L.counts("a").sum() == 1


def test_edge_rows(spark):
    rows = [(i, t, g, 1) for i in range(60) for t, g in (("the cat and the dog", "en"), ("der hund und die katze", "de"))]
    rows += [(900, None, "en", 1), (901, "", "en", 1), (902, "12 !?", "de", 1), (None, "the dog", "de", 1), (903, "the dog", None, 1), (903, "the dog", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, SCORE_ int").withColumn("FEATURE", F.lit("x"))
    model = L.train(docs, F.col("doc_id").isNotNull())
    out = [(r.doc_id, r.text, r.lang_pred, r.score) for r in L.detect(docs, model).collect()]
    got = {(d, t): (g, s) for d, t, g, s in out}
    assert len(out) == len(rows)
    assert got[900, None] == got[901, ""] == got[902, "12 !?"] == ("und", 0.0)
    assert got[903, "the dog"][0] == got[None, "the dog"][0] == "en" and 0 < got[903, "the dog"][1] <= 1


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert L.detect(docs, L.train(docs, F.lit(True))).first().lang_pred == "und"
    none = docs.filter("doc_id > 5")
    assert L.detect(none, L.train(none, F.lit(True))).collect() == []
