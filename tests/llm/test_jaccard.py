import random

import numpy as np
import pandas as pd
import pytest

from tests.llm import brute
from visitmap.llm.blocks import write_blocks
from visitmap.llm.components import components
from visitmap.llm.jaccard_join import JaccardJoin, classes_of, classify_tokens, count_messages, keep_one_of_each, node_of


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(words) for _ in range(n)]

    def edit(w, k):
        w = list(w)
        for _ in range(k):
            o, i = rng.random(), rng.randrange(len(w))
            if o < 0.4:
                w[i] = rng.choice(words)
            elif o < 0.7:
                del w[i]
            else:
                w.insert(i, rng.choice(words))
            w = w or ["x"]
        return w

    out = []
    add = lambda w: out.append((len(out), " ".join(w)))
    for n in (1, 2, 3, 5, 12, 40, 100, 400, 1500, 1, 2, 150):
        base = text(n)
        for _ in range(rng.choice([1, 2, 3, 8])):
            add(edit(base, rng.choice([0, 0, 1, 2, 3, n // 30, n // 40])))
    base, passage = text(60), text(100)
    for _ in range(40):
        add(edit(base, rng.choice([0, 1, 1, 2])))
    base = text(300)
    for _ in range(40):
        add(edit(base, rng.randint(0, 9)))
    for _ in range(15):
        add(passage + text(rng.randint(0, 30)))
    out += [(None, None), (900, ""), (901, " \n"), (None, out[3][1]), (5, out[5][1].upper()), (None, "lonely zebra"), (None, "Lonely zebra")]
    rng.shuffle(out)
    return out


# Few rare tokens: nearly all keys are combinations.
@pytest.mark.parametrize("percent, size, rare", [(90, 3, 16), (90, 3, 2), (80, 5, 2)])
def test_components_equal_brute_force(spark, percent, size, rare):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    join = JaccardJoin(spark, docs, size=size, percent=percent, rare=rare, block_bytes=20_000, bucket_bytes=2_000)
    got = sorted(((r.key, r.n, r.component_id) for r in join.members().collect()), key=str)
    assert got == sorted(brute.jaccard_components(rows, size, percent), key=str)


def test_one_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    got = keep_one_of_each(spark, docs, size=3, percent=90)
    assert got.columns == docs.columns
    named = [(i, t) for i, (_, t) in enumerate(rows)]  # keys may repeat: number the rows
    groups = {}
    for (i, _), (key, _) in zip(brute.jaccard_components(named, 3, 90) and [(c, 0) for _, _, c in brute.jaccard_components(named, 3, 90)], rows):
        groups.setdefault(i, []).append((key is None, key))
    want = sorted((min(v)[1] for v in groups.values()), key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == want


def test_long_chains_and_empty_input(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(120)] + [(1000, 5000), (5000, 3000), (7, 7)], "a long, b long")
    got = {(r.comp, r["count"]) for r in components(spark, chain).groupBy("comp").count().collect()}
    assert got == {(0, 121), (1000, 3)}
    assert components(spark, chain.limit(0)).count() == 0
    assert JaccardJoin(spark, spark.createDataFrame([], "doc_id long, text string")).members().count() == 0


def test_keys_for_any_number_of_buckets():
    rng = np.random.default_rng(6)
    tokens = np.unique(rng.integers(0, 1 << 48, 3000).astype(np.uint64))
    tokens = np.concatenate((tokens, tokens[:500], tokens[:100]))  # 500 tokens twice, 100 of them three times
    for bits in (6, 16, 17, 20, 32):
        sent = count_messages(5, tokens, bits).to_pylist()
        assert max(m["bucket"] for m in sent) < 1 << bits
        reduce = classify_tokens(2)
        back = [m for b in {m["bucket"] for m in sent} for m in reduce((b,), pd.DataFrame([m for m in sent if m["bucket"] == b])).to_dict("records")]
        count = np.bincount(np.unique(tokens, return_inverse=True)[1])[np.unique(tokens, return_inverse=True)[1]]
        assert (classes_of(tokens, back, bits) == (count > 1).astype(int) + (count > 2)).all()


def test_node_numbers_are_checked():
    blocks = [(0, 0), (0, 1), (1, 0), ((1 << 20) - 1, (1 << 21) - 1)]
    nodes = np.concatenate([node_of((p << 32) | s, np.array([0, (1 << 22) - 1])) for p, s in blocks])
    assert len(set(nodes.tolist())) == 8 and nodes.min() >= 0
    for block, index in (((1 << 20) << 32, 0), (1 << 21, 0), (0, 1 << 22)):
        with pytest.raises(ValueError):
            node_of(block, np.array([index]))


def test_blocks_of_empty_texts_end(spark):
    docs = spark.range(1000).selectExpr("id as doc_id", "'' as text").coalesce(1)
    blocks = write_blocks(spark, docs, "empty-blocks", words=True, block_docs=64)
    sizes = [r.n_docs for r in blocks.collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 64
