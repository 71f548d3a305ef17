"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors are dealt to blocks of near ones, and each block gets a minimum spanning
tree. A candidate's score at the tree's root is computed; at every other anchor it
lies within the score at the parent, plus or minus the edge's length times the
candidate's norm. Only candidates whose bounds overlap a window that the anchor
asks for are scored there, which makes their bounds exact for the children.

Vectors are integers, and all scores are exact inner products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmap.llm.repeats import rows_of
from visitmap.llm.scratch import scratch_path

PACKED = "dim int, {part} long, ids binary, labels binary, vectors binary"
TREE = PACKED.format(part="block") + ", parent binary, edge binary, positives binary, scores binary, floors binary"
GROUP = PACKED.format(part="grp")
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long, rescored long"

#: Squared norms from here on give scores that don't fit a long.
TOO_LONG = float(1 << 62)
#: Below this all sums of products are exact in double precision.
EXACT = float(1 << 53)
MOST, LEAST = int(np.iinfo(np.int64).max), int(np.iinfo(np.int64).min)
CODE_BITS = 16


def pack(rows: pd.DataFrame) -> dict[str, list]:
    x = np.stack(rows["v"].to_numpy()).astype(np.int64) if len(rows) else np.zeros((0, 1), np.int64)
    return {"ids": [rows["id"].to_numpy(np.int64).tobytes()], "labels": [rows["label"].to_numpy(np.int64).tobytes()], "vectors": [x.tobytes()]}


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["dim"])


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes in an order with parents first, each node's parent (by place; -1: the root), and the edges' lengths."""
    y = x.astype(np.float64)
    n = len(y)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    root = int(((y - y.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
    near, by, place = np.full(n, np.inf), np.full(n, -1), np.full(n, -1)
    at = root
    for k in range(n):
        order[k], place[at] = at, k
        if k:
            parent[k], edge[k] = place[by[at]], near[at]
        d = np.sqrt(((y - y[at]) ** 2).sum(axis=1))
        closer = d < near
        near[closer], by[closer] = d[closer], at
        near[place >= 0] = np.inf
        at = int(np.argmin(np.where(place >= 0, np.inf, near)))
    return order, parent, edge


class Candidates:
    """A chunk of one group's rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x, self.y = ids, labels, x, x.astype(np.float64)
        self.norm = np.sqrt((self.y ** 2).sum(axis=1))

    def scores(self, a: np.ndarray, norm: float, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Exact inner products with ``a``."""
        if norm * self.norm.max(initial=0.0) < EXACT:
            return (self.y[some] @ a.astype(np.float64)).astype(np.int64)
        return self.x[some] @ a

    def bounded(self, tree: dict, wanted) -> "Iterator":  # noqa: F821
        """For every anchor, parents first: its place, and the exact scores of all candidates that ``wanted`` doesn't rule out.

        ``wanted(k, low, high)`` tells from bounds which candidates the anchor must see.
        """
        n = len(self.ids)
        children = np.bincount(tree["parent"][tree["parent"] >= 0], minlength=len(tree["ids"]))
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in range(len(tree["ids"])):
            a, own = tree["x"][k], tree["norm"][k]
            up = int(tree["parent"][k])
            low, high = -own * self.norm, own * self.norm
            if up >= 0:
                # A little wider, against rounding.
                gap = tree["edge"][k] * self.norm * (1 + 1e-9) + 1
                low, high = np.maximum(low, held[up][0] - gap), np.minimum(high, held[up][1] + gap)
                children[up] -= 1
                if not children[up]:
                    del held[up]
            slack = 1 + 1e-9 * own * self.norm
            see = np.ones(n, dtype=bool) if up < 0 else wanted(k, low - slack, high + slack)
            some = np.flatnonzero(see)
            # Beyond a quarter, one product with all is cheaper than gathering rows.
            if len(some) * 4 > n:
                exact = self.scores(a, own)
                low = high = exact.astype(np.float64)
                score = exact[some]
            else:
                score = self.scores(a, own, some)
                low[some] = high[some] = score
            if children[k]:
                held[k] = low, high
            yield k, some, score


def best(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, ties to the smaller id, in that order."""
    at = np.arange(len(score))
    if len(score) > most:
        at = np.flatnonzero(score >= np.partition(score, len(score) - most)[len(score) - most])
    return at[np.lexsort((ids[at], -score[at]))[:most]]


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The integer scores s with low * positive <= 100 * s <= high * positive."""
    return -((-low * positive) // 100), (high * positive) // 100


def search(batches, most: int, low: int, high: int, positives: bool, chunk: int):
    """For every (group, block of anchors): the anchors' best candidates, or their windows' best.

    A positive's floor (its window's last place among what was searched before) and what the task has found so
    far raise the least score that an anchor still asks for.
    """
    last, chunks, floors = None, [], {}
    for row in rows_of(batches):
        at = (row["dim"], row["grp"])
        if at != last:
            ids, labels, x = unpack(row)
            chunks = [Candidates(ids[i: i + chunk], labels[i: i + chunk], x[i: i + chunk]) for i in range(0, len(ids), chunk)]
            last = at
        tree = {"ids": np.frombuffer(row["anchor_ids"], np.int64), "labels": np.frombuffer(row["anchor_labels"], np.int64),
                "parent": np.frombuffer(row["parent"], np.int64), "edge": np.frombuffer(row["edge"])}
        tree["x"] = np.frombuffer(row["anchors"], np.int64).reshape(len(tree["ids"]), row["dim"])
        tree["norm"] = np.sqrt((tree["x"].astype(np.float64) ** 2).sum(axis=1))
        n = len(tree["ids"])
        width = len(row["positives"]) // 8 // n
        table = {c: np.frombuffer(row[c], np.int64).reshape(n, width).tolist() for c in ("positives", "scores", "floors")}
        asked: list[dict] = [{} for _ in range(n)]  # each anchor's windows, with the positives they are for
        floor = floors.setdefault((row["dim"], row["block"]), [{} for _ in range(n)])
        for k in range(n):
            for p, s, f in zip(*(table[c][k] for c in ("positives", "scores", "floors"))):
                w = (LEAST, MOST) if positives else window(s, low, high)
                if w[0] <= w[1] and (positives or p != LEAST):
                    asked[k].setdefault(w, []).append((p, s))
                    floor[k][w] = max(floor[k].get(w, w[0]), f)
        out = {c.split()[0]: [] for c in FOUND.split(", ")}
        seen, tops = 0, {}
        for part in chunks:
            def fits(k, part=part):
                same = part.labels == tree["labels"][k]
                return same & (part.ids != tree["ids"][k]) if positives else ~same

            def wanted(k, least, highest):
                see = np.zeros(len(part.ids), dtype=bool)
                for w in asked[k]:
                    see |= (highest >= floor[k][w]) & (least <= w[1])
                return see & fits(k)

            for k, some, score in part.bounded(tree, wanted):
                seen += len(some)
                mine = fits(k)[some]
                some, score = some[mine], score[mine]
                for w in asked[k]:
                    inside = np.flatnonzero((score >= floor[k][w]) & (score <= w[1]))
                    if not len(inside):
                        continue
                    ids, points = part.ids[some[inside]], score[inside]
                    if (k, w) in tops:
                        ids, points = np.concatenate((tops[k, w][0], ids)), np.concatenate((tops[k, w][1], points))
                    top = best(points, ids, most)
                    tops[k, w] = ids[top], points[top]
                    if len(top) == most:
                        floor[k][w] = max(floor[k][w], int(points[top[-1]]))
        for (k, w), (ids, points) in tops.items():
            for positive, ps in asked[k][w]:
                out["anchor_id"] += [int(tree["ids"][k])] * len(ids)
                out["positive_id"] += [positive] * len(ids)
                out["positive_score"] += [ps] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += points.tolist()
        out["rescored"] = [None] * len(out["score"])
        for name, value in zip(out, (None, None, None, None, None, seen)):
            out[name].append(value)  # one row that only counts
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})


def signs(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).normal(size=(dim, CODE_BITS))


class HardNegatives:
    """Anchors, positives and hard negatives of labelled vectors.

    ``vectors`` has ``key``, ``label`` and ``vector``; a component x counts as
    floor(``scale`` * x). A row's score at an anchor is the inner product; higher comes
    first, ties go to the smaller key. ``positives()``: each anchor's first ``n_positives`` other rows of its own label.
    ``negatives()``: for each of them the first ``n_negatives`` rows of other labels whose score s has
    low * p <= 100 * s <= high * p, p being the positive's. Fewer where there are fewer.
    ``anchors`` is a condition on ``id`` (the key).

    Rows with a null key or label, a null or empty vector, or a component that is null or not
    finite take no part, nor do rows of a squared integer norm from 2**62 on, whose scores fit no long. Of
    rows with the same key one takes part, that with the smallest label and then the smallest vector. Vectors
    meet vectors of their own length. Empty table: no rows. Other columns are ignored.
    """

    def __init__(self, spark: SparkSession, vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                 anchors: str = "id % 100 = 0", scale: float = 256.0, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
                 block: int = 256, chunk: int = 4096, group_rows: tuple[int, int] = (1024, 65536)):
        self.spark, self.block, self.chunk, self.group_rows = spark, block, chunk, group_rows
        self.n_positives, self.n_negatives, self.low, self.high = n_positives, n_negatives, low, high
        self.rows = self._rows(vectors, F.col(f"`{key}`"), F.col(f"`{label}`"), F.col(f"`{vector}`"), scale)
        self.groups, self.n_groups = self._groups()
        self.anchors = self._blocks(self.rows.where(anchors))
        self._positives = None

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _rows(self, vectors: DataFrame, key: Column, label: Column, vector: Column, scale: float) -> DataFrame:
        whole = F.transform(vector, lambda x: F.lit(scale) * x.cast("double"))
        finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float(1 << 31)))
        rows = vectors.select(key.cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"))
        # Larger components have too large a norm; the cast to long is safe for the rest.
        rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
        rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x)))
        norm = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
        one = rows.where(norm < TOO_LONG).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
        return self._write(one.select("id", F.size("r.v").alias("dim"), F.col("r.label").alias("label"), F.col("r.v").alias("v")), "vectors")

    def _groups(self) -> tuple[DataFrame, int]:
        """The candidates, packed: some 64 groups, of the fewest and most rows that ``group_rows`` names, about."""
        n = self.rows.count()
        groups = max(1, -(-n // min(max(n // 64, self.group_rows[0]), self.group_rows[1])))

        def build(group, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"dim": [group[0]], "grp": [group[1]], **pack(rows.sort_values("id"))})

        dealt = self.rows.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)))
        return self._write(dealt.groupBy("dim", "grp").applyInPandas(build, GROUP), "candidates"), groups

    def _blocks(self, anchors: DataFrame) -> DataFrame:
        """The anchors with their block: those on the same sides of a few fixed planes, some ``block`` together."""
        n = anchors.count()
        bits = min(CODE_BITS, max(0, (n // self.block).bit_length()))

        def code(batches):
            for batch in batches:
                dims, vectors = batch.column(1).to_pylist(), batch.column(3)
                sides = [int(((np.array(v.as_py(), dtype=np.float64) @ signs(d)) > 0)[:bits] @ (1 << np.arange(bits))) if bits else 0 for d, v in zip(dims, vectors)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sides, pa.int64())], names=[*batch.schema.names, "code"])

        coded = anchors.select("id", "dim", "label", "v").mapInArrow(code, "id long, dim int, label long, v array<bigint>, code long")
        size = coded.groupBy(F.col("dim").alias("d"), F.col("code").alias("c")).agg(F.count("*").alias("n"))
        dealt = coded.join(size, (F.col("dim") == F.col("d")) & (F.col("code") == F.col("c")))
        sub = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / self.block))
        return self._write(dealt.select("id", "dim", "label", "v", (F.col("code") * F.lit(1 << 40) + sub).alias("block")), "anchors")

    def _scan(self, anchors: DataFrame, positives: bool, groups: Column, name: str) -> DataFrame:
        """Every block of ``anchors`` searched in the ``groups``; ``anchors`` has ``p``, an array of (score, vec_id, floor)."""
        most, low, high, chunk = self.n_positives if positives else self.n_negatives, self.low, self.high, self.chunk

        def tree(group, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("id").reset_index(drop=True)
            x = np.stack(rows["v"].to_numpy()).astype(np.int64)
            order, parent, edge = spanning_tree(x)
            rows = rows.iloc[order]
            width = max(len(p) for p in rows["p"])
            table = np.full((3, len(rows), width), LEAST)
            for i, p in enumerate(rows["p"]):
                for k, c in enumerate(("vec_id", "score", "floor")):
                    table[k, i, : len(p)] = [r[c] for r in p]
            return pd.DataFrame({"dim": [group[0]], "block": [group[1]], **pack(rows), "parent": [parent.astype(np.int64).tobytes()],
                                 "edge": [edge.tobytes()], "positives": [table[0].tobytes()], "scores": [table[1].tobytes()], "floors": [table[2].tobytes()]})

        blocks = anchors.groupBy("dim", "block").applyInPandas(tree, TREE)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.n_groups - 1).cast("long"))).alias("grp")
        asked = blocks.select("dim", "block", F.col("ids").alias("anchor_ids"), F.col("labels").alias("anchor_labels"), F.col("vectors").alias("anchors"),
                              "parent", "edge", "positives", "scores", "floors", every).where(groups)
        # As many partitions as groups: what a task costs doesn't show in its bytes.
        pairs = asked.repartition(self.n_groups, "dim", "grp").join(self.groups.repartition(self.n_groups, "dim", "grp"), ["dim", "grp"])
        found = pairs.mapInArrow(lambda batches: search(batches, most, low, high, positives, chunk), FOUND)
        return self._write(found, name)

    def _found(self, anchors: DataFrame, positives: bool) -> DataFrame:
        """All groups searched: first a few (their number's square root), whose last places are floors for the rest.

        So what the rest sends grows with the anchors and hardly with the groups.
        """
        name, most = ("positives", self.n_positives) if positives else ("negatives", self.n_negatives)
        step = max(1, round(self.n_groups ** 0.5))
        first = self._scan(anchors, positives, F.col("grp") % step == 0, name)
        if step == 1:
            return first
        one = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
        last = first.where("anchor_id is not null").withColumn("place", F.row_number().over(one)).where(F.col("place") == most)
        last = last.select(F.col("anchor_id").alias("id"), F.col("positive_id").alias("pid"), F.col("score").alias("found"))
        p = anchors.select("id", F.explode("p").alias("x")).withColumn("pid", F.col("x.vec_id")).join(last, ["id", "pid"], "left")
        p = p.groupBy("id").agg(F.collect_list(F.struct("x.score", "x.vec_id", F.coalesce("found", F.lit(LEAST)).alias("floor"))).alias("p"))
        rest = self._scan(anchors.drop("p").join(p, "id"), positives, F.col("grp") % step != 0, name + "-rest")
        return first.unionByName(rest)

    def positives(self) -> DataFrame:
        """``anchor_id``, ``rank``, ``vec_id``, ``score``."""
        if self._positives is None:
            all_scores = F.array(F.struct(F.lit(0).cast("long").alias("score"), F.lit(LEAST).alias("vec_id"), F.lit(LEAST).alias("floor")))
            self.positive_scan = self._found(self.anchors.withColumn("p", all_scores), True)
            rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
            ranked = self.positive_scan.where("anchor_id is not null").withColumn("rank", rank).where(F.col("rank") <= self.n_positives)
            self._positives = ranked.select("anchor_id", "rank", "vec_id", "score")
        return self._positives

    def negatives(self) -> DataFrame:
        """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
        known = self.positives().groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id", F.lit(LEAST).alias("floor")))).alias("p"))
        asked = self.anchors.join(known, F.col("id") == F.col("anchor_id")).drop("anchor_id")
        self.negative_scan = self._found(asked, False)
        rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id"))
        ranked = self.negative_scan.where("anchor_id is not null").withColumn("rank", rank).where(F.col("rank") <= self.n_negatives)
        return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH rows AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM rows a JOIN rows c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) <= 10"""
