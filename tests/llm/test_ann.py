import numpy as np
from pyspark.sql import functions as F

from visitmap.llm import graph_ann
from visitmap.llm.graph_ann import nearest

SF = "/root/testdata/sf0.01"


def test_recall_exact_scores_and_odd_vectors(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 100, [0.0] * 64), (10**6 + 200, [float("nan")] * 64), (10**6 + 300, [None] + [1.0] * 63),
                                 (None, [1.0] * 64), (10**7, [1.0, 2.0]), (10**7 + 100, [1.0, 2.5]), (10**7 + 200, [])], "vec_id long, embedding array<float>")
    same = e.where("vec_id = 100").select(F.explode(F.sequence(F.lit(2 * 10**6), F.lit(2 * 10**6 + 300))).alias("vec_id"), "embedding")
    rows = e.unionByName(odd).unionByName(same).unionByName(same).withColumn("score", F.lit(1))
    got = nearest(spark, rows, rows.where("vec_id % 20 = 0"), shard_size=128, degree=16, build_beam=32, beam=48).toPandas()
    plain = e.unionByName(same).toPandas()
    x, ids = np.stack(plain.embedding).astype(float), plain.vec_id.to_numpy()
    hit = total = 0
    by = dict(list(got.sort_values("rank").groupby("query_id")))
    assert set(by) == {*ids[ids % 20 == 0], 10**7, 10**7 + 100}
    for i in np.flatnonzero(ids % 20 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[ids == ids[i]] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = by[ids[i]]
        assert mine["rank"].tolist() == list(range(1, 11)) and mine.score.is_monotonic_increasing
        far = dict(zip(ids, d))
        assert all(abs(far[v] - s) < 1e-12 for v, s in zip(mine.vec_id, mine.score))
        hit, total = hit + len({*best} & {*mine.vec_id}), total + 10
    assert hit / total >= 0.95
    assert by[100].vec_id.tolist() == list(range(2 * 10**6, 2 * 10**6 + 10))
    assert by[10**7][["vec_id", "score"]].values.tolist() == [[10**7 + 100, 0.5]]


def test_empty_and_small_tables(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert nearest(spark, e.limit(0), e.limit(0)).count() == 0
    few = e.where("vec_id < 3")
    assert nearest(spark, few, few).count() == 6


def test_larger_shards_prune_no_more_a_node(monkeypatch):
    pruned = []
    prune = graph_ann.robust_prune
    monkeypatch.setattr(graph_ann, "robust_prune", lambda x, nodes, *more: (pruned.append(len(nodes)), prune(x, nodes, *more))[1])
    a_node = []
    for n in (1500, 6000):
        pruned.clear()
        x = np.random.default_rng(5).random((n, 16), dtype=np.float32)
        edges, _ = graph_ann.build_graph(x, 16, 16, 1.2)
        assert (edges >= 0).any(axis=1).all()
        a_node.append(sum(pruned) / n)
    assert a_node[1] < 1.2 * a_node[0]


def test_shards_are_not_packed_into_one_task(spark):
    e = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(400)], "vec_id long, embedding array<float>")
    index, shards = graph_ann.build_index(spark, e, "vec_id", "embedding", 10, 50, 8, 16, 1.2)
    files = index.select(F.input_file_name().alias("f")).distinct().count()
    assert shards == 8 and index.count() == 8 and files >= 4
