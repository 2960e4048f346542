import collections
import re

import corpus_pipeline
import numpy as np
from test_bpe import ids_of
from test_mixing import brute as brute_mix
from test_mixing import size_of
from test_quality_mcd import brute as brute_quality
from test_setsketch import unsorted_brute

from tallyspark.llm import quality_mcd

SECRET = re.compile(r"(?i)(?<![A-Za-z0-9+/_-])(AKIA[0-9A-Z]{16}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{18}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{40})(?![A-Za-z0-9+/_-])")


def test_run_against_brute_force(spark, monkeypatch):
    import test_setsketch
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    rows = [r for r, (_, failed, d2) in zip(rows, brute_quality(rows)) if not failed and (d2 is None or d2 <= quality_mcd.CUTOFF)]
    five = test_setsketch.brute
    monkeypatch.setattr(test_setsketch, "brute", lambda rows: five(rows, n=5))
    rows = [r for r, v in zip(rows, unsorted_brute([r[:2] for r in rows])) if v[3]]
    rows = [(d, SECRET.sub("[SECRET]", t), g, s) for d, t, g, s in rows]
    text = {d: t for d, t, _, _ in rows}
    want = collections.Counter()
    for d, _, n, _, _, copies in brute_mix([(d, s, t) for d, t, _, s in rows]):
        assert n == size_of(text[d])
        want[d] += copies
    out = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter(r.doc_id for r in out) == +want
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and ids == ids_of(text[r.doc_id])


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns


def test_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
