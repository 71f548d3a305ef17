import zlib

import numpy as np

from visitmap.llm.quality_classifier import Network, classify, pooled, dense, BUCKETS, DIM, SHAPES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_split(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = classify(spark, docs, labels).collect()
    assert len(got) == docs.count()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    judged = [r for r in got if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in judged]) >= 0.95


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "", 1), (2, "a", 1), (3, "w " * 50_000, 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(None, 1), (2, None), (3, 7)], "doc_id long, quality int")
    got = classify(spark, docs, labels).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    assert not next(r for r in got if r.doc_id is None).held_out
    assert classify(spark, docs.limit(0), labels).count() == 0


def test_pooling_is_the_mean_and_calibration_keeps_order():
    body = np.frombuffer(b"aa bb aa cc", dtype=np.uint8)
    vectors = np.random.default_rng(1).normal(size=(BUCKETS, DIM)).astype(np.float32)
    whole = pooled(body, np.array([0, 11]), vectors, dense(SHAPES, 2))
    parts = pooled(np.frombuffer(b"aabbaacc", dtype=np.uint8), np.array([0, 2, 2, 4, 6, 8]), vectors, dense(SHAPES, 2))
    assert np.allclose(whole[0, :DIM], parts[[0, 2, 3, 4], :DIM].mean(axis=0), atol=1e-5) and not parts[1].any()
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 4))
    y = (x[:, 0] + rng.normal(size=2000) > 0).astype(float)
    net = Network(x[:1500], y[:1500])
    p = net(x[1500:])
    assert np.mean((p > 0.5) == y[1500:]) > 0.7 and abs(p.mean() - y[1500:].mean()) < 0.08
