"""Approximate nearest neighbours on a pruned directed graph for every shard.

Different vectors are dealt to shards by hash; equal vectors are one node with
their smallest ids. In a shard every node looks for neighbours by a greedy
search over the graph built so far; of the nodes that search has opened, pruning keeps the
nearest one, drops those much nearer to it than to the node (by the factor
``alpha``), and so on, so that edges lead in all directions. Edges back are added
and pruned alike. A query walks every shard's graph with a beam; the shards' best
are merged by exact distance in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmap.llm.repeats import rows_of
from visitmap.llm.scratch import scratch_path

INDEX = "dim int, shard long, vectors binary, ids binary, edges binary, start int"
FOUND = "query_id long, vec_id long, score double"
OPEN_AT_ONCE = 4


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of a[i] and b[i, j]."""
    diff = b - a[:, None, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def beam_search(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the ``beam`` nearest nodes met, nearest first (-1: none)."""
    q = len(queries)
    rows = np.arange(q)[:, None]
    ids = np.full((q, beam), -1, dtype=np.int64)
    dist = np.full((q, beam), np.inf, dtype=np.float32)
    opened = np.ones((q, beam), dtype=bool)
    seen = np.zeros((q, len(x)), dtype=bool)
    ids[:, 0], opened[:, 0], seen[:, start] = start, False, True
    dist[:, 0] = squared(queries, x[None, [start]].repeat(q, axis=0))[:, 0]
    while True:
        # The nearest nodes in each beam that haven't been opened; the beam is in order.
        order = np.argsort(opened, axis=1, kind="stable")[:, :OPEN_AT_ONCE]
        fresh = ~opened[rows, order]
        if not fresh.any():
            return ids, dist
        opened[rows, order] = True
        near = np.where(fresh[:, :, None], edges[ids[rows, order]], -1).reshape(q, -1)
        near = np.where(near >= 0, near, start)  # the start has always been seen
        near.sort(axis=1)
        new = ~seen[rows, near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[rows, near] = True
        # Distances of nodes not met before alone.
        who, at = np.nonzero(new)
        diff = x[near[who, at]] - queries[who]
        d = np.full(near.shape, np.inf, dtype=np.float32)
        d[who, at] = np.einsum("ij,ij->i", diff, diff)
        ids, dist = np.concatenate((ids, near), axis=1), np.concatenate((dist, d), axis=1)
        opened = np.concatenate((opened, ~new), axis=1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist, opened = ids[rows, order], dist[rows, order], opened[rows, order]


def robust_prune(x: np.ndarray, nodes: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` of each node's candidates (-1: none), far from each other as seen from the node."""
    near = np.where(near == nodes[:, None], -1, near)
    near = np.sort(near, axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    there = x[near]
    d = np.where(near >= 0, squared(x[nodes], there), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    rows = np.arange(len(nodes))
    near, d, there = near[rows[:, None], order], d[rows[:, None], order], there[rows[:, None], order]
    norm = np.einsum("ijk,ijk->ij", there, there)
    between = norm[:, :, None] + norm[:, None, :] - 2 * there @ there.transpose(0, 2, 1)
    alive, out = np.isfinite(d), np.full((len(nodes), degree), -1, dtype=np.int64)
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        out[some, k] = near[rows, pick][some]
        alive &= alpha * alpha * between[rows, pick] > d
        alive[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int, beam: int, alpha: float, batch: int = 256, batches: int = 8) -> tuple[np.ndarray, int]:
    """Edges (-1: none) and the start, the node nearest to the mean. Two rounds: alpha 1, then ``alpha``.

    Edges back are added after every ``batches``-th part of the nodes, ``batch`` at least: a node gets
    edges from nearly every part, and is pruned for each, so a fixed part would prune more a node in larger shards.
    """
    n = len(x)
    rng = np.random.default_rng(n)
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, degree), -1, dtype=np.int64)
    if n > 1:
        first = min(degree // 2, n - 1)
        edges[:, :first] = (np.arange(n)[:, None] + rng.integers(1, n, (n, first))) % n
    part_size = max(batch, -(-n // batches))
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for i in range(0, n, part_size):
            nodes = order[i: i + part_size]
            ahead = []
            for j in range(0, len(nodes), batch):
                some = nodes[j: j + batch]
                met, _ = beam_search(x, edges, start, x[some], beam)
                ahead.append(robust_prune(x, some, np.concatenate((met, edges[some]), axis=1), degree, a))
            edges[nodes] = np.concatenate(ahead)
            # The edges back, a few for each node at a time.
            to, src = edges[nodes].ravel(), np.repeat(nodes, degree)
            to, src = to[to >= 0], src[to >= 0]
            by = np.argsort(to, kind="stable")
            to, src = to[by], src[by]
            place = np.arange(len(to)) - np.searchsorted(to, to)
            for k in range(0, int(place.max(initial=-1)) + 1, degree):
                part = (place >= k) & (place < k + degree)
                node, at = np.unique(to[part], return_inverse=True)
                back = np.full((len(node), degree), -1, dtype=np.int64)
                back[at, place[part] - k] = src[part]
                both = np.concatenate((edges[node], back), axis=1)
                for j in range(0, len(node), batch):
                    edges[node[j: j + batch]] = robust_prune(x, node[j: j + batch], both[j: j + batch], degree, a)
    return edges, start


def usable(vector: str) -> "F.Column":
    """Vectors that take part: not null, not zero, all components finite."""
    v = F.col(vector)
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    return v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda e: e != 0)


def build_index(spark: SparkSession, vectors: DataFrame, key: str, vector: str, k: int, shard_size: int, degree: int, beam: int, alpha: float) -> tuple[DataFrame, int]:
    """A row a shard, written to the scratch folder, and the number of shards."""
    # Of equal vectors the k + 1 smallest ids can be needed; the limit is applied before the shuffle too.
    by_vector = Window.partitionBy("v").orderBy("id")
    rows = vectors.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    few = rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    nodes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    shards = max(1, -(-rows.count() // shard_size))
    nodes = nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), "v", "ids")

    def build(group, part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(first=[i[0] for i in part["ids"]]).sort_values("first")
        x = np.stack(part["v"].to_numpy()).astype(np.float64)
        ids = np.full((len(x), k + 1), -1, dtype=np.int64)
        for r, i in enumerate(part["ids"]):
            ids[r, : len(i)] = i
        edges, start = build_graph(x.astype(np.float32), degree, beam, alpha)
        return pd.DataFrame({"dim": [group[0]], "shard": [group[1]], "vectors": [x.tobytes()], "ids": [ids.tobytes()], "edges": [edges.astype(np.int32).tobytes()], "start": [start]})

    # Shards are few bytes and much work: by bytes, adaptive execution would pack several into a task.
    nodes = nodes.repartition(4 * shards, "dim", "shard")
    path = scratch_path(spark, "graph-index")
    nodes.groupBy("dim", "shard").applyInPandas(build, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path), shards


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10,
            shard_size: int = 8192, degree: int = 32, build_beam: int = 64, beam: int = 64, alpha: float = 1.2, block: int = 256) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` found for each row of ``queries``, without the query's own id.

    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: Euclidean distance in double
    precision, ties to the smaller id. Null, zero and non-finite vectors and null
    ids take no part; vectors only meet vectors of their own length. Equal vectors
    are all found, by id. Repeated rows count once. Empty table: no rows. Every query
    walks every shard, in blocks of queries; every vector is indexed.
    """
    index, shards = build_index(spark, vectors, key, vector, k, shard_size, degree, build_beam, alpha)
    asked = queries.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    blocks = max(1, -(-asked.count() // block))
    packed = (asked.groupBy(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
              .agg(F.collect_list(F.struct("id", "v")).alias("queries")))
    dealt = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).join(index, ["dim", "shard"])

    def search(batches):
        for row in rows_of(batches):
            x = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
            ids = np.frombuffer(row["ids"], dtype=np.int64).reshape(len(x), -1)
            edges = np.frombuffer(row["edges"], dtype=np.int32).reshape(len(x), -1).astype(np.int64)
            own = np.array([q["id"] for q in row["queries"]])
            v = np.array([q["v"] for q in row["queries"]])
            met, _ = beam_search(x.astype(np.float32), edges, row["start"], v.astype(np.float32), min(beam, max(len(x), 1)))
            exact = np.where(met >= 0, np.sqrt(squared(v, x[met])), np.inf)
            found = np.where((met >= 0)[:, :, None], ids[met], -1).reshape(len(v), -1)
            far = np.repeat(exact, ids.shape[1], axis=1)
            far[(found < 0) & (found != own[:, None])] = np.inf
            far[found == own[:, None]] = np.inf
            order = np.lexsort((found, far), axis=1)[:, :k]
            at = np.arange(len(v))[:, None]
            score, vec = far[at, order], found[at, order]
            good = np.isfinite(score)
            yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(own[:, None], vec.shape)[good]), pa.array(vec[good]), pa.array(score[good])], names=["query_id", "vec_id", "score"])

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    best = dealt.select(*[x.split()[0] for x in INDEX.split(", ")], "queries").mapInArrow(search, FOUND)
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
