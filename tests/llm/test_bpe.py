import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitmap.llm import scratch
from visitmap.llm.chunk_bpe import Encoder, cut_chunks, decode_corpus, encode_corpus

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["a", "é", "ß", " ", "  ", "\n", "\t", "'s", "'", "<|endoftext|>", "<|startoftext|>", " ", " ", "Σ", "ΑΣ", "é", "́", "日本", "😀", "\x00", "\x1c", "12", "!!", "\x85", " ", "x" * 30]


def rows():
    rng = random.Random(1)
    out = [(i, "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 300))), 1) for i in range(120)]
    shared = " ".join(f"shared{i % 13} passage" for i in range(200))
    out += [(500 + i, f"own {i} " + shared + f" end{i}", 1) for i in range(20)]
    return out + [(None, None, 1), (None, "hello world", 1), (3, "dup key", 1), (3, "dup key", 1), (-5, "", 1), (-6, "x" * 70_000, 1), (-7, " ", 1), (-8, "ab " * 20_000, 1)]


@pytest.mark.parametrize("average", [1024, 40])
def test_equals_the_library(spark, average):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, ids int")
    got = decode_corpus(spark, encode_corpus(spark, docs, PATH, average=average, carry=["text"]), PATH).collect()
    assert len(got) == len(rows())
    library = Tokenizer.from_file(PATH)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_shared_text_falls_into_the_same_chunks():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 20_000).astype(np.uint8)
    a = np.concatenate((rng.integers(97, 123, 777).astype(np.uint8), shared))
    ends, hashes = cut_chunks(np.concatenate((a, shared)), np.array([0, len(a), len(a) + len(shared)]))
    first = hashes[ends <= len(a)]
    assert np.isin(hashes[ends > len(a)], first).mean() > 0.8


def test_null_and_repeated_keys_gather_one_documents_chunks(spark):
    shared = " ".join(f"shared{i % 13} passage" for i in range(200))
    rows = [(None if i % 2 else 7, f"own {i // 3} " + shared + f" end{i // 3}") for i in range(120)]
    before = set(scratch.tables())
    got = encode_corpus(spark, spark.createDataFrame(rows, "doc_id long, text string"), PATH, average=40, carry=["text"]).collect()
    library = Tokenizer.from_file(PATH)
    assert sorted(r.text for r in got) == sorted(t for _, t in rows)
    assert all(np.frombuffer(bytes(r.ids), "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids for r in got)
    path = next(p for p in scratch.tables() if p not in before and "bpe-chunks" in p)
    by = spark.read.parquet(path).groupBy("k").agg(F.size(F.array_distinct(F.flatten(F.collect_list("h")))).alias("gathered"), F.max(F.size(F.array_distinct("h"))).alias("own"))
    assert by.where("gathered > own").isEmpty() and by.count() == len(set(rows))


def test_empty_table(spark):
    assert encode_corpus(spark, spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_words_beyond_those_to_remember_are_forgotten():
    library = Tokenizer.from_file(PATH)
    enc = Encoder(open(PATH, encoding="utf-8").read(), remember=100)
    for i in range(40):
        text = " ".join(f"often w{i}x{j}" for j in range(30))
        assert np.frombuffer(enc.words(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert b"often" in enc.tokens and len(enc.tokens) <= 200 and len(enc.older) <= 200
