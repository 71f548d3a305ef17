"""A quality classifier on random-indexing word vectors.

Every hash bucket of words has a sparse random index vector. A word's vector is
the sum of its neighbours' index vectors over the whole corpus; a word's shape
(its pattern of capitals, small letters, digits and signs, and whether it repeats the word before) has its
index vector alone, so words never seen still count. A document is the mean of
its words' vectors and of its shapes' vectors. A network of two layers, trained
in numpy on a bounded sample of the labelled rows, scores it; a temperature
fitted on rows left out of training calibrates the probabilities.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.sampling import smallest_hashes
from visitmap.llm.textnum import _U, IS_SPACE, mix, slices, string_column, word_bounds, word_hashes
from visitmap.llm.scratch import scratch_path

BUCKETS, SHAPES, DIM, NONZERO = 1 << 14, 1 << 10, 32, 4
SLICES = 32
PIECE = 1 << 20

# A byte's class in a shape: capitals, small letters (and all beyond ASCII), digits, else itself.
CLASS = np.arange(256, dtype=np.uint8)
CLASS[65:91], CLASS[97:123], CLASS[128:], CLASS[48:58] = 65, 97, 97, 48


def index_vectors(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the nonzero entries of each bucket's index vector."""
    rng = np.random.default_rng(seed)
    place = np.argsort(rng.random((count, DIM)), axis=1)[:, :NONZERO]
    return place, rng.choice([-1.0, 1.0], (count, NONZERO)).astype(np.float32)


def dense(count: int, seed: int) -> np.ndarray:
    place, sign = index_vectors(count, seed)
    out = np.zeros((count, DIM), dtype=np.float32)
    np.put_along_axis(out, place, sign, axis=1)
    return out


def terms(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket and shape bucket of every word, and the documents' word offsets."""
    starts, ends, first = word_bounds(body, offs)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), first
    words = word_hashes(body, starts, ends)
    kind = CLASS[body]
    keep = ~IS_SPACE[body]
    keep[1:] &= kind[1:] != kind[:-1]
    keep[starts] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    shape = word_hashes(kind[keep], place[starts], place[ends])
    again = np.zeros(len(words), dtype=bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[1:] > first[:-1]]] = False
    shape = mix(shape + again.astype(np.uint64))
    return (words >> _U(40)).astype(np.int64) % BUCKETS, (shape >> _U(40)).astype(np.int64) % SHAPES, first


def word_vectors(spark: SparkSession, docs: DataFrame, text: str = "text") -> np.ndarray:
    """A unit vector for every bucket (``BUCKETS`` x ``DIM``), from all documents.

    Each task sums its own documents and sends one row a slice of buckets; the
    driver gets the sums, whose size is fixed.
    """
    def count(batches):
        place, sign = index_vectors(BUCKETS, 1)
        total = np.zeros(BUCKETS * DIM, dtype=np.float64)
        for batch in batches:
            body, offs = string_column(batch.column(0))
            for i, j in slices(offs, PIECE):
                word, _, first = terms(body[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                if len(word) < 2:
                    continue
                inner = np.ones(len(word) - 1, dtype=bool)
                edge = first[1:-1]
                inner[edge[(edge > 0) & (edge < len(word))] - 1] = False
                left, right = word[:-1][inner], word[1:][inner]
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        total += np.bincount(a * DIM + place[b, k], weights=sign[b, k], minlength=len(total))
        parts = np.split(total, SLICES)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "sums"])

    def add(key, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in rows["sums"])
        return pd.DataFrame({"part": [key[0]], "sums": [total.tobytes()]})

    # Two levels, so that no task reads the sums of all tasks.
    schema = "part int, sums binary"
    part = docs.select(F.col(text).alias("text")).mapInArrow(count, schema).withColumn("group", F.spark_partition_id() % 256)
    some = part.groupBy("part", "group").applyInPandas(add, schema)
    rows = some.groupBy("part").applyInPandas(add, schema).collect()
    total = np.zeros((SLICES, BUCKETS * DIM // SLICES))
    for r in rows:
        total[r["part"]] = np.frombuffer(r["sums"])
    total = total.reshape(BUCKETS, DIM)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(body: np.ndarray, offs: np.ndarray, vectors: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Mean word vector and mean shape vector of every document; zeros without words."""
    word, shape, first = terms(body, offs)
    out = np.zeros((len(offs) - 1, 2 * DIM), dtype=np.float32)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        size = np.diff(first)[full][:, None]
        # Counts of a document's shapes are few; its words' vectors are summed as they come.
        out[full, :DIM] = np.add.reduceat(vectors[word], first[full], axis=0) / size
        out[full, DIM:] = np.add.reduceat(shapes[shape], first[full], axis=0) / size
    return out


class Network:
    """Two layers with a tanh between, trained by Adam on the cross entropy."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, steps: int = 600, batch: int = 256, rate: float = 0.01, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.temperature = 1.0
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        self.p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
        if len(x) == 0 or len(set(y.tolist())) < 2:
            # Nothing to tell apart: the share of label 1, or a half without labels.
            share = min(max(y.mean() if len(y) else 0.5, 0.01), 0.99)
            self.p[2][:] = 0
            self.p[3][:] = np.log(share / (1 - share))
            return
        part = rng.random(len(x)) < 0.2
        if part.all() or not part.any() or len(set(y[~part].tolist())) < 2:
            part[:] = False
        z = (x - self.mean) / self.scale
        tx, ty = z[~part], y[~part]
        m, v = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p]
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(tx), batch)
            a, g = tx[pick], None
            h = np.tanh(a @ self.p[0] + self.p[1])
            e = 1 / (1 + np.exp(-(h @ self.p[2] + self.p[3][0]))) - ty[pick]
            back = np.outer(e, self.p[2]) * (1 - h * h)
            g = [a.T @ back / batch + 1e-4 * self.p[0], back.mean(axis=0), h.T @ e / batch + 1e-4 * self.p[2], np.array([e.mean()])]
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        if part.any():
            logit = self.logits(x[part])
            trial = np.geomspace(0.25, 8, 60)
            loss = [np.logaddexp(0, np.where(y[part] == 1, -1, 1) * logit / t).mean() for t in trial]
            self.temperature = float(trial[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             sample: int = 20_000) -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    The network learns from at most ``sample`` labelled rows that are not held
    out, those with the smallest hash of their id; the word vectors come from all texts.
    Labels other than 0 and 1 are left out. Null or empty text: zero vectors, scored like another.
    Null id: not held out, never learned from. Repeated rows: a row each. Without
    labels every score is 0.5. Empty table: no rows. Ids, languages and sources are no features.
    """
    vectors = spark.sparkContext.broadcast(word_vectors(spark, docs, text))
    schema = "key long, vector binary"

    def pool(batches):
        shapes = dense(SHAPES, 2)
        for batch in batches:
            body, offs = string_column(batch.column(1))
            for i, j in slices(offs, PIECE):
                x = pooled(body[offs[i]: offs[j]], offs[i: j + 1] - offs[i], vectors.value, shapes)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([r.tobytes() for r in x], pa.binary())], names=["key", "vector"])

    path = scratch_path(spark, "quality-vectors")
    docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(pool, schema).write.parquet(path)
    pooled_rows = spark.read.schema(schema).parquet(path)
    held = F.coalesce(F.crc32(F.col("key").cast("string")) % 3 == 1, F.lit(False))
    marks = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    rows = smallest_hashes(pooled_rows.where(~held).join(marks, "key").select("key", "y", "vector", F.xxhash64("key").alias("h")), "h", sample).collect()
    x = np.array([np.frombuffer(r["vector"], np.float32) for r in rows], dtype=np.float64).reshape(len(rows), 2 * DIM)
    network = Network(x, np.array([r["y"] for r in rows], dtype=np.float64))

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                v = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network(v.astype(np.float64)))], names=["key", "score"])

    scored = pooled_rows.mapInArrow(score, "key long, score double")
    return scored.select(F.col("key").alias(key), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
