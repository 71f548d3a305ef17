import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from visitmap.llm.textnum import string_column
from visitmap.llm.toxic_spans import FIELDS, SIZE, Field, Tokens, ToxicSpans, association, chain_marginals, held_out, log_likelihood, logistic, measures, pieces, tag

SF = "/root/testdata/sf0.01"


def some_field(seed):
    rng = np.random.default_rng(seed)
    return Field(rng.normal(size=SIZE + 1) * 0.4, rng.normal(size=(2, 2)), rng.normal(size=2))


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(0)
    field = some_field(0)
    for n in (1, 2, 5, 9, 11):
        odds, resets = rng.normal(size=n) * 2, rng.random(n) < 0.3
        resets[0] = True
        weights = {}
        for y in itertools.product((0, 1), repeat=n):
            weights[y] = np.exp(sum(o for o, k in zip(odds, y) if k) + sum(field.start[y[t]] if resets[t] else field.move[y[t - 1], y[t]] for t in range(n)))
        want = sum(w * np.array(y) for y, w in weights.items()) / sum(weights.values())
        for columns in (1, 2, 3, 4, 128):
            assert np.allclose(chain_marginals(field, odds, resets, columns=columns)[0], want)


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(1)
    features = rng.integers(0, 30, (FIELDS, 6, 5))
    labels, lengths = (rng.random((6, 5)) < 0.4).astype(float), np.array([6, 3, 1, 5, 6])
    labels[np.arange(6)[:, None] >= lengths] = 0
    field = some_field(2)
    _, error, moves, start = log_likelihood(field, features, labels, lengths)
    weights = sum(np.bincount(one.ravel(), weights=error.ravel(), minlength=SIZE + 1) for one in features)
    for values, gradient in ((field.move, moves), (field.start, start), (field.weights, weights)):
        for at in [i for i in np.ndindex(values.shape) if i < (30,)]:
            values[at] += 1e-5
            up = log_likelihood(field, features, labels, lengths)[0]
            values[at] -= 2e-5
            down = log_likelihood(field, features, labels, lengths)[0]
            values[at] += 1e-5
            assert abs((up - down) / 2e-5 - gradient[at]) < 1e-5


def test_long_texts_in_pieces_agree_with_the_whole():
    """The chain crosses the pieces' edges exactly; only features of the neighbour across an edge are missing."""
    field = some_field(3)
    k = FIELDS - 2
    field.weights[Tokens.of(np.frombuffer(b"idiot", np.uint8), np.array([0, 5])).features()[0, 0]] = 9
    rng = np.random.default_rng(4)
    text = " ".join(rng.choice(["idiot", "the", "été", "Word,", "x\n\n"], 4000)).encode()
    body = np.frombuffer(text, np.uint8)
    whole = Tokens.of(body, np.array([0, len(body)]))
    features = whole.features()
    edges = [np.searchsorted(whole.starts, e) for _, e in pieces(body, 900)[:-1]]
    for e in edges:
        features[e, k], features[e - 1, k + 1] = SIZE, SIZE
    begins = np.zeros(len(features), dtype=bool)
    begins[0] = True
    want, _, _ = chain_marginals(field, field.emissions(features), begins)
    total, spans = tag(field, body, np.array([0, len(body)]), piece=900)
    assert np.allclose(total[0], [len(want), want.sum(), want.max()])
    told = text.decode()
    assert spans and all(told[s:e].strip() == told[s:e] for _, s, e, _ in spans)
    assert sum(len(told[s:e].split()) for _, s, e, _ in spans) == (want > 0.5).sum()
    no_gap = np.frombuffer("é".encode() * 1000, np.uint8)
    assert [x for x, _ in pieces(no_gap, 301)][1:] == [y for _, y in pieces(no_gap, 301)][:-1]
    assert all((no_gap[x] & 0xC0) != 0x80 for x, _ in pieces(no_gap, 301))


def test_spans_stand_where_the_words_are():
    field = Field.untrained()
    text = "Ça va, you idiot idiot! été — IDIOT.\n"
    body, offs = string_column(pa.array(["", text, text]))
    word = Tokens.of(np.frombuffer(b"idiot", np.uint8), np.array([0, 5])).features()[0, 0]
    field.weights[word] = 40
    field.start, field.move = np.array([5.0, -5.0]), np.array([[5.0, -5.0], [5.0, -5.0]])
    total, spans = tag(field, body, offs)
    assert [(d, text[s:e]) for d, s, e, _ in spans] == [(d, w) for d in (1, 2) for w in ("idiot idiot", "IDIOT")]
    assert total[0].tolist() == [0, 0, 0] and total[1, 0] == 8 and abs(total[1, 1] - 3) < 0.01


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = ToxicSpans(spark, docs, labels, learn=~held_out(F.col("key")))
    got = model.score(docs).withColumn("held", held_out(F.col("doc_id"))).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(got) == docs.count() and all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    judged = [(int(r.score >= 0.7), truth[r.doc_id], r) for r in got if r.held and r.doc_id in truth]
    assert np.mean([p == y for p, y, _ in judged]) >= 0.95
    assert np.mean([p for p, y, _ in judged if y == 0]) <= 0.01
    assert all(r.spans for p, _, r in judged if p)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1.0, "a"), (1, "", 1.0, "a"), (1, "", 1.0, "a"), (2, "a", 1.0, "b"), (3, "w " * 50_000, 1.0, "c"), (4, "é" * 50_000, 1.0, "c")],
                                 "doc_id long, text string, score double, row string")
    labels = spark.createDataFrame([(None, 1), (2, None), (3, 7), (4, 0), (4, 1)], "doc_id long, toxic int")
    model = ToxicSpans(spark, docs, labels)
    got = model.score(docs, ["doc_id", "row", "text", "score"]).collect()
    assert len(got) == 6 and all(0 <= r.score < 0.5 and r.spans == [] for r in got) and model.score(docs.limit(0)).count() == 0
    assert next(r for r in got if r.doc_id == 3).text == "w " * 50_000
    one = spark.createDataFrame([(2, 1)], "doc_id long, toxic int")
    assert {r.score > 0.5 for r in ToxicSpans(spark, docs, one).score(docs).collect()} == {True}


def test_fits():
    assert association(5, 0, 10, 100) > 18 > association(1, 0, 10, 100) > 0 == association(0, 0, 10, 0)
    rows = np.array([[100, 3.0, 0.99], [80, 2.0, 0.9], [100, 0.1, 0.05], [50, 0.0, 0.01]])
    w = logistic(measures(rows), np.array([1.0, 1.0, 0.0, 0.0]))
    p = 1 / (1 + np.exp(-measures(rows) @ w))
    assert (p[:2] > 0.5).all() and (p[2:] < 0.5).all()
