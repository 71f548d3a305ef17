"""The registered queries over whole tables: columns and types, SQL where there is some, plain versions elsewhere."""

import hashlib
import re
import struct
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tools.check_oracles import compare, duck
from visitmap.llm import queries as Q

SF = "/root/testdata/sf0.001"

#: Each query's columns and types.
CONTRACT = {
    "op1": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op2": "doc_id:bigint n_words:bigint n_removed:bigint kept_sha256:string",
    "op3": "query_id:bigint rank:int vec_id:bigint score:double",
    "op4": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op5": "doc_id:bigint n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    "op6": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op7": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op8": "doc_id:bigint n_shingles:bigint component_id:bigint",
    "op9": "conv_id:bigint n_turns:bigint turns_sha256:string loss_chars:bigint loss_sha256:string formatted_chars:bigint",
    "op10": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op11": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op12": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    "op13": "doc_id:bigint n:bigint form:string prefix_chars:bigint middle_chars:bigint output_sha256:string restored_sha256:string",
}
EACH_DOCUMENT = ("op1", "op2", "op4", "op5", "op6", "op7", "op8", "op10", "op11", "op13")


def columns_of(text):
    return dict(part.split(":") for part in text.split())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def results(spark):
    found = {}

    def get(op):
        if op not in found:
            (name,) = [n for n in Q.QUERIES if n.startswith(op + "_")]
            df = Q.QUERIES[name](spark, SF)
            found[op] = (dict(df.dtypes), df.collect())
        return found[op]

    return get


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("op", CONTRACT)
def test_columns_types_and_rows(results, texts, op):
    types, rows = results(op)
    assert {c: types.get(c) for c in columns_of(CONTRACT[op])} == columns_of(CONTRACT[op])
    if op in EACH_DOCUMENT:
        assert sorted(r.doc_id for r in rows) == sorted(texts)
    for column in [c for c in types if c.endswith("sha256")]:
        assert all(re.fullmatch("[0-9a-f]{64}", r[column]) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, name):
    found = compare(spark, duck(SF), name, Q.QUERIES[name], Q.ORACLES[name], SF)
    assert found["cols"] and found["values"] and found["rows"] == found["oracle_rows"] > 0


def test_neighbours_against_all_distances(spark, results):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r[[c for c in r.__fields__ if isinstance(r[c], list)][0]], dtype=np.float64) for r in rows}
    ids = np.array(sorted(vectors))
    table = np.stack([vectors[i] for i in ids])
    got, hits, asked = {}, 0, 0
    for r in results("op3")[1]:
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {i for i in vectors if i % 100 == 0}
    for query, near in got.items():
        near.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in near] == list(range(1, len(near) + 1)) and query not in {r.vec_id for r in near}
        assert [(r.score, r.vec_id) for r in near] == sorted((r.score, r.vec_id) for r in near)
        far = np.sqrt(((table - vectors[query]) ** 2).sum(axis=1))
        best = [int(i) for i in ids[np.lexsort((ids, far))] if i != query][:10]
        np.testing.assert_allclose([r.score for r in near], [np.sqrt(((vectors[r.vec_id] - vectors[query]) ** 2).sum()) for r in near], rtol=1e-12)
        hits, asked = hits + len(set(best) & {r.vec_id for r in near}), asked + len(best)
    assert hits >= 0.9 * asked


def test_ids_and_decoded_text_against_the_library(results, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(Q.word_bpe()))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for r in results("op4")[1]:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)))
        assert r.decoded_sha256 == sha(tokenizer.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize(("op", "cut"), [("op7", 0.5), ("op11", 0.7)])
def test_scores_held_out_rows_and_verdicts(results, op, cut):
    for r in results(op)[1]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)


def test_turns_read_back_against_the_table(spark, results):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    rows = {r.conv_id: r for r in results("op9")[1]}
    assert set(rows) == set(turns)
    for key, said in turns.items():
        answers = "".join(t for role, t in said if role == "assistant")
        assert rows[key].n_turns == len(said) and rows[key].turns_sha256 == sha("".join(f"{role}\n{t}\n" for role, t in said))
        assert (rows[key].loss_chars, rows[key].loss_sha256) == (len(answers), sha(answers))
        assert rows[key].formatted_chars >= sum(len(t) for _, t in said)


def test_counts_and_base_rules_against_brute_force(results, texts):
    for r in results("op10")[1]:
        counts = brute.counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r.base_failed and r.kept)


def test_spans_of_the_base_kinds_are_all_there(results):
    for r in results("op6")[1]:
        spans = [s for s in r.spans.split(",") if s]
        assert len(spans) >= r.n_email + r.n_ip + r.n_card + r.n_phone
        for kind in ("email", "ip", "card", "phone"):
            assert sum(s.startswith(kind + ":") for s in spans) >= r[f"n_{kind}"]
