import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from visitmap.llm import pii_crf as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def weights(spark):
    return P.learn(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_base_patterns_equal_plain_matching():
    rng = random.Random(2)
    parts = ["a", "1", "22", "4111111111111111", ".", "@", "+", "-", " ", "(", ")", "é", "x.y", "1.2.3.4", "٣", "_", "%", "com", "0005"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(t) == brute.personal_data(t), t


def test_field_adds_what_patterns_miss(weights):
    find = lambda t: [(k, t[s:e]) for k, s, e in P.added_spans(t, weights, P.base_spans(t), 2.0)]
    assert find("call (456) 555-2186 now") == [("phone", "(456) 555-2186")]
    assert find("card 4111.1111.1111.1111 end") == [("card", "4111.1111.1111.1111")]
    for clean in ("born 1987-06-05, room 1234567", "at the end 404189 of it", "k=a9f8e7d6c5b4a39281", "look at this dot here"):
        assert find(clean) == []


def test_spelled_addresses_are_seen_in_any_case_and_whole(weights):
    find = lambda t: [(k, s, e) for k, s, e in P.added_spans(t, weights, P.base_spans(t), 2.0)]
    for lower in ("write to john at example dot com today", "write to john.smith at example dot com"):
        assert P.regions(lower.upper()) == P.regions(lower) == [(0, len(lower))]
        assert find(lower.upper()) == find(lower)
    name, host = "n" * 60, "h" * 60
    text = f"one {name} at {host} two " + "w " * 200 + f"1{'x' * 300}2 end"
    assert [text[a:b] for a, b in P.regions(text)][0].startswith(name) and f" {host} " in [text[a:b] + " " for a, b in P.regions(text)][0]
    for a, b in P.regions(text):
        assert (a == 0 or text[a - 1].isspace()) and (b == len(text) or text[b].isspace())
    assert P.regions("x" * 5000 + "1" + "x" * 5000 + "2") == [(0, 10_002)]


def test_gradient_and_best_labelling():
    regions = [r for t, s in P.made_up(15) for r in P.labelled_regions(t, s)][:6]
    rng = np.random.default_rng(3)
    w = rng.normal(0, 0.3, (P.N_FEATURES, len(P.KINDS)))
    total, grad = P.log_likelihood(regions, w)
    for _ in range(10):
        i, k = rng.integers(P.N_FEATURES), rng.integers(len(P.KINDS))
        step = np.zeros_like(w)
        step[i, k] = 1e-5
        up, down = P.log_likelihood(regions, w + step)[0], P.log_likelihood(regions, w - step)[0]
        assert abs((up - down) / 2e-5 - grad[i, k]) < 1e-3

    def best(n, segments, at=0):
        rest = [best(n, segments, at + 1)] if at < n else [0.0]
        return max(rest + [s + best(n, segments, b) for a, b, s in segments if a == at])

    for _ in range(30):
        first = rng.integers(0, 6, 8)
        after = np.minimum(first + rng.integers(1, 4, 8), 7)
        scores = rng.normal(0, 1, (8, 4))
        found = P.best_segments(7, first, after, scores)
        assert abs(sum(x[3] for x in found) - best(7, [(a, b, s) for a, b, row in zip(first, after, scores) for s in row])) < 1e-9


def test_rows_masks_and_odd_input(spark, weights):
    rows = [(1, "é x@y.com, +1 (456) 555-2186 q", 1), (None, None, 1), (2, "", 1), (2, "", 1), (3, "1 " * 30_000, 1), (4, "1.2.3.4.5 and 1.2.3.4", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = P.find_personal_data(spark, docs, weights=weights)
    assert got.columns == ["doc_id", "text", "spans"] and got.count() == len(rows)
    for r in got.collect():
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == brute.personal_data(r.text or "")
    masked = {r.doc_id: r.text for r in P.mask_documents(spark, docs, weights=weights).collect()}
    assert masked[1] == "é <EMAIL>, <PHONE> q" and masked[None] is None and masked[4] == "<IP>.5 and <IP>"
    assert P.mask_documents(spark, docs, weights=weights).columns == docs.columns
    assert P.find_personal_data(spark, docs.limit(0), weights=weights).count() == 0
    line = got.select(P.span_text(F.filter("spans", lambda s: s["base"])).alias("t")).where("doc_id = 1").first().t
    assert line == "email:2:9,phone:11:28"


def test_texts_go_to_python_once(spark, weights):
    docs = spark.createDataFrame([(1, "call +1 555 123 4567 now", "en")], "doc_id long, text string, lang string")
    rows = P.searched_rows(spark, docs, "text", docs.columns, weights, 2.0)
    assert "text" not in rows.schema["row"].dataType.names
    found, masked = P.find_personal_data(spark, docs, weights=weights), P.mask_documents(spark, docs, weights=weights)
    assert found.columns == [*docs.columns, "spans"] and found.first().text == docs.first().text
    assert masked.columns == docs.columns and masked.first().text == "call <PHONE> now"
