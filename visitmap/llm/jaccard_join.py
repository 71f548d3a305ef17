"""N-gram Jaccard join with token-combination prefixes.

A document is its set of word shingles (tokens). Tokens stand in one order for
all documents: rare before frequent. Two sets that overlap enough share their
first common tokens inside prefixes of both; a prefix longer by g tokens holds
g + 1 common ones. Rare tokens of the extended prefix are index keys by
themselves. Frequent tokens fall into g classes by hash, so two of g + 1 common
ones share a class, and only pairs within a class are keys. g grows with the size of
the set, which keeps the number of keys in proportion to it. Sets that meet in
a key are verified by their exact overlap.

Documents with equal sets are one node. Tokens in one document only can't be common,
so a document with too many of them has no link and drops out before any
set is moved. In each key every set is first verified against the key's smallest
node, not against all; pairs that these links leave in different components are
verified afterwards. Parity sketches, whose difference never exceeds that of the
sets, keep pairs that can't link from being made at all.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.blocks import COLUMNS, bucket_count, unpack_block, with_messages, write_blocks
from visitmap.llm.components import components
from visitmap.llm.repeats import _arrow, batch, bucket_slices, rows_of
from visitmap.llm.textnum import _MULT, _U, mix, pack_ints, ranges, unpack_ints, word_bounds, word_hashes
from visitmap.llm.scratch import drop_table, scratch_path

NODES = "node long, key long, n long, s1 long, s2 long"
COUNTS = "bucket long, block long, keys binary, docs binary"
CLASSES = "block long, bucket long, classes binary"
SETS = "block long, size long, nodes binary, offs binary, tokens binary, alone binary"
LIVE = "node long, n int, common int, tokens binary, keys array<long>, parity array<long>"
PARITY_WORDS = 16
TOKEN_BITS = 48
MOST_BITS = 32  # of a bucket's number
SAMPLE = 4  # a quarter of the tokens, by hash, tells most unlinked documents


def node_of(block: int, index: np.ndarray) -> np.ndarray:
    """One number for a block's document: 20 bits of partition, 21 of block, 22 of place."""
    part, seq, index = block >> 32, block & 0xFFFFFFFF, np.asarray(index, dtype=np.int64)
    if part >> 20 or seq >> 21 or (len(index) and int(index.max()) >> 22):
        raise ValueError(f"partition {part}, block {seq}: beyond the node numbers' 20, 21 and 22 bits; read the documents in fewer partitions")
    return (part << 43) + (seq << 22) + index


def bucket_key(tokens: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """A token's upper bits, ``bits`` of bucket and the next ones below, up to 32, and the number of these."""
    low = min(32, TOKEN_BITS - bits)
    return tokens >> _U(TOKEN_BITS - bits - low), low


def shingle_sets(body: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's different shingle hashes, ascending, and their offsets."""
    starts, ends, first = word_bounds(body, offs)
    words = word_hashes(body, starts, ends, fold=True)
    count = np.diff(first)
    shingles = np.maximum(count - size + 1, np.where(count > 0, 1, 0))
    at = ranges(first[:-1], shingles)
    doc = np.repeat(np.arange(len(count)), shingles)
    whole = count[doc] >= size
    h = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        there = whole | (at + k < first[1:][doc])
        h = h * _MULT + np.where(there, words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else 0, _U(k + 1)).astype(np.uint64)
    h = mix(h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(count) + 1))


def segment_sum(x: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, dtype=x.dtype)
    np.cumsum(x, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def count_messages(block: int, tokens: np.ndarray, bits: int) -> pa.RecordBatch:
    """A block's different tokens by bucket, each with the number of its documents (up to 255)."""
    key, low_bits = bucket_key(tokens, bits)
    key, docs = np.unique(key, return_counts=True)
    buckets, low = (key >> _U(low_bits)).astype(np.int64), (key & _U((1 << low_bits) - 1)).astype(np.uint32)
    docs = np.minimum(docs, 255).astype(np.uint8)
    return batch(_arrow(COUNTS), [(b, block, pack_ints(np.diff(low[i:j], prepend=np.uint32(0))), docs[i:j].tobytes()) for b, i, j in bucket_slices(buckets)])


def classify_tokens(rare: int):
    """For every block's tokens: 0 in one document, 1 in up to ``rare``, 2 in more."""
    def reduce(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack_ints(x, np.uint32), dtype=np.uint32) for x in rows["keys"]]
        docs = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["docs"]])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=docs)
        classes = ((total > 1).astype(np.uint8) + (total > rare))[at].astype(np.uint8)
        return pd.DataFrame({"block": rows["block"], "bucket": key[0], "classes": [c.tobytes() for c in np.split(classes, np.cumsum([len(k) for k in keys])[:-1])]})
    return reduce


def classes_of(tokens: np.ndarray, messages: list, bits: int) -> np.ndarray:
    """The classes that came back, for a block's tokens in their own order."""
    _, at = np.unique(bucket_key(tokens, bits)[0], return_inverse=True)
    return np.concatenate([np.frombuffer(m["classes"], np.uint8) for m in sorted(messages, key=lambda m: m["bucket"])])[at]


def level_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that may link are at most one level apart (the steps are a little wider than needed)."""
    return np.floor(np.log(np.maximum(n, 1)) / -np.log(percent / 100 - 0.01)).astype(np.int64)


def classes_at(level: int, percent: int) -> int:
    """Number of frequent-token classes, and of tokens by which prefixes are extended."""
    return 1 + int((percent / 100 - 0.01) ** -level / 80)


def needed(n, percent: int):
    """Least overlap with any set that links to one of size n."""
    return -(-percent * n // 100)


def index_keys(tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """Index keys of one set: its tokens and their classes (0 alone, 1 rare, 2 frequent)."""
    n = len(tokens)
    order = np.lexsort((tokens, classes))
    tokens, classes = tokens[order], classes[order]
    prefix = n - int(needed(n, percent)) + 1
    level = int(level_of(np.array([n]), percent)[0])
    groups = [classes_at(level, percent), classes_at(level + 1, percent)]
    end = prefix + max(groups)
    out = [mix(tokens[:end][classes[:end] == 1])]
    for l, g in zip((level, level + 1), groups):
        some = tokens[: prefix + g][classes[: prefix + g] == 2]
        if len(some) < 2:
            continue
        kind = mix(some) % _U(g)
        by = np.lexsort((some, kind))
        some, kind = some[by], kind[by]
        last = np.searchsorted(kind, kind, side="right")
        more = last - np.arange(len(some)) - 1
        i = np.repeat(np.arange(len(some)), more)
        j = ranges(np.arange(len(some)) + 1, more)
        out.append(mix(mix(some[i] * _MULT + some[j]) + _U(l + 1)))
    return np.concatenate(out)


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """A bit a hash bucket: whether an odd number of the set's tokens fall into it.

    Two sets' sketches differ in at most as many bits as the sets do in tokens.
    """
    at = mix(tokens + _U(7)) % _U(64 * PARITY_WORDS)
    odd = np.bincount(at.astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def links(percent: int) -> Callable:
    """Keep the pairs whose sets overlap enough: percent of the union, in integers."""
    def verify(batches):
        for b in batches:
            x, y = b.column(b.schema.names.index("tokens_a")), b.column(b.schema.names.index("tokens_b"))
            good = np.zeros(b.num_rows, dtype=bool)
            for i in range(b.num_rows):
                p, q = unpack_set(x[i].as_py()), unpack_set(y[i].as_py())
                at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                both = int((p[at] == q).sum())
                good[i] = 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.names.index(c)) for c in ("a", "b")], names=["a", "b"]).filter(pa.array(good))
    return verify


def pack_set(tokens: np.ndarray) -> bytes:
    return pack_ints(np.diff(tokens, prepend=_U(0)))


def unpack_set(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(data, np.uint64), dtype=np.uint64)


class JaccardJoin:
    """The join's tables: ``rows`` (one a document: node, key, n) and ``links`` (pairs of nodes), ``members``.

    ``links`` are connecting pairs, each verified: enough of the linked pairs to give
    every component, without those inside a component that others already connect.
    They give no count of all linked pairs.

    Texts are lower-cased (A-Z), words are ``[^\\x20\\x09-\\x0D]+``, shingles ``size``
    consecutive words; a text with fewer words has its whole sequence as the one
    shingle. Null and empty texts have the empty set and link with nothing. Null
    keys stay null. Repeated rows have equal sets and so are linked. Empty table: no
    rows. Other columns are not read. Shingles are compared by 64-bit hashes, sets by their upper 48 bits.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90,
                 rare: int = 16, block_bytes: int = 4 << 20, bucket_bytes: int = 1 << 20):
        if not 60 <= percent <= 100:  # below, one-token sets could link to larger ones
            raise ValueError("percent is from 60 to 100")
        self.spark, self.percent = spark, percent
        blocks = written = write_blocks(spark, docs, "jaccard-blocks", key, text, words=True, block_bytes=block_bytes)
        bits = min(MOST_BITS, bucket_count(blocks, bucket_bytes).bit_length() - 1)
        blocks = blocks.select(*COLUMNS)
        short = _U(64 - TOKEN_BITS)

        def describe(batches):
            for row in rows_of(batches):
                ids, known, offs, body = unpack_block(row)
                tokens, at = shingle_sets(body, offs, size)
                node = node_of(row["block"], np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(ids, mask=~known), pa.array(np.diff(at)),
                                                  pa.array(segment_sum(mix(tokens), at).view(np.int64)), pa.array(segment_sum(mix(tokens ^ _MULT), at).view(np.int64))],
                                                 names=["node", "key", "n", "s1", "s2"])

        self.rows = self._written(blocks.mapInArrow(describe, NODES), "jaccard-documents")
        # One node for equal sets.
        same = self.rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("node").alias("rep"))
        place = F.expr("((rep >> 43) << 32) | ((rep >> 22) & 2097151)")
        chosen = same.select(place.alias("block"), F.expr("cast(rep & 4194303 as int)").alias("place"))
        chosen = chosen.groupBy("block").agg(F.collect_list("place").alias("chosen"))

        def count_sample(batches):
            for row in rows_of(batches):
                _, _, offs, body = unpack_block(row)
                tokens, _ = shingle_sets(body, offs, size)
                some = tokens[mix(tokens) % _U(SAMPLE) == 0]
                yield count_messages(row["block"], some >> short, bits)

        def keep_sets(batches):
            """Sets that the sampled tokens leave a chance of a link, by block."""
            for row in rows_of(batches):
                if not row["chosen"]:
                    continue
                ids, _, offs, body = unpack_block(row)
                tokens, at = shingle_sets(body, offs, size)
                sampled = mix(tokens) % _U(SAMPLE) == 0
                alone = np.zeros(len(tokens), dtype=np.int64)
                if row["messages"]:
                    alone[sampled] = classes_of(tokens[sampled] >> short, row["messages"], bits) == 0
                n, single = np.diff(at), segment_sum(alone, at)
                keep = np.zeros(len(ids), dtype=bool)
                keep[row["chosen"]] = True
                keep = np.flatnonzero(keep & (n > 0) & (n - single >= needed(n, percent)))
                some = tokens[ranges(at[:-1][keep], n[keep])] >> short
                where = np.concatenate(([0], np.cumsum(n[keep])))
                if len(keep):
                    yield batch(_arrow(SETS), [(row["block"], len(some) * 8, node_of(row["block"], keep).tobytes(), where.tobytes(), pack_ints(some), b"")])

        flags = blocks.mapInArrow(count_sample, COUNTS).groupBy("bucket").applyInPandas(classify_tokens(rare), CLASSES)
        sets = self._written(with_messages(blocks, flags, ["bucket", "classes"]).join(chosen, "block", "left").mapInArrow(keep_sets, SETS), "jaccard-sets", SETS)
        drop_table(spark, written)
        bits = min(MOST_BITS, bucket_count(sets, bucket_bytes).bit_length() - 1)

        def count_all(batches):
            for row in rows_of(batches):
                yield count_messages(row["block"], unpack_ints(row["tokens"], np.uint64), bits)

        def index(batches):
            for row in rows_of(batches):
                nodes, at = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["offs"], np.int64)
                tokens = unpack_ints(row["tokens"], np.uint64)
                classes = classes_of(tokens, row["messages"], bits)
                out = []
                for node, i, j in zip(nodes, at[:-1], at[1:]):
                    common = int((classes[i:j] > 0).sum())
                    if common >= needed(j - i, percent):
                        out.append((int(node), int(j - i), common, pack_set(tokens[i:j]), index_keys(tokens[i:j], classes[i:j], percent).view(np.int64), parity_sketch(tokens[i:j])))
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=[x.split()[0] for x in LIVE.split(", ")])

        slim = sets.select("block", "nodes", "offs", "tokens")
        counted = slim.mapInArrow(count_all, COUNTS).groupBy("bucket").applyInPandas(classify_tokens(rare), CLASSES)
        self.live = self._written(with_messages(slim, counted, ["bucket", "classes"]).mapInArrow(index, LIVE), "jaccard-index", LIVE)
        drop_table(spark, sets)
        self.links = self._link()

    def _written(self, df: DataFrame, name: str, schema: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(path)

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of pairs (a, b), each once, those that link."""
        sets = self.live.select("node", "tokens")
        one = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a")
        two = one.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")
        return self._written(two.select("a", "b", "tokens_a", "tokens_b").mapInArrow(links(self.percent), "a long, b long"), name, "a long, b long")

    def _possible(self, p: str, q: str):
        """Sizes, tokens that may be common, and sketches allow a link of two rows' sets.

        A link leaves at most (100 - percent) / (100 + percent) of both sizes as tokens of one set only.
        """
        n, m, c, d = F.col(f"{p}.n"), F.col(f"{q}.n"), F.col(f"{p}.common"), F.col(f"{q}.common")
        sizes = (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & ((100 + self.percent) * F.least(c, d) >= self.percent * (n + m))
        apart = sum((F.bit_count(F.col(f"{p}.parity")[i].bitwiseXOR(F.col(f"{q}.parity")[i])) for i in range(PARITY_WORDS)), F.lit(0))
        return sizes & ((100 + self.percent) * apart <= (100 - self.percent) * (n + m))

    def _link(self) -> DataFrame:
        keys = self.live.select(F.explode(F.array_distinct("keys")).alias("key"), "node", "n", "common", "parity")
        # Keys of one set only join nothing.
        first = keys.groupBy("key").agg(F.min(F.struct("node", "n", "common", "parity")).alias("first"), F.count("*").alias("sets")).where("sets > 1").select("key", "first.*")
        met = keys.alias("x").join(first.alias("y"), "key").where((F.col("x.node") != F.col("y.node")) & self._possible("x", "y"))
        found = self._verified(met.select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct(), "jaccard-links")
        found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        # Pairs that this leaves apart: first by a few keys of each set, the smallest, which sets
        # that link mostly share; then, when those have joined most components, by all keys.
        few = self.live.select(F.explode(F.slice(F.array_sort(F.array_distinct("keys")), 1, 3)).alias("key"), "node", "n", "common", "parity")
        pairs = self._apart(few, found)
        found = found.unionByName(self._verified(pairs, "jaccard-links"))
        late = self._apart(keys, found).join(pairs, ["a", "b"], "left_anti")
        return found.unionByName(self._verified(late, "jaccard-links"))

    def _apart(self, keys: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs in one key and different components that may link, each once, written."""
        parts = components(self.spark, found)
        named = self._written(keys.join(parts, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "jaccard-named")
        apart = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        rest = named.join(apart, "key", "left_semi")
        met = rest.alias("x").join(rest.alias("y"), "key").where((F.col("x.comp") < F.col("y.comp")) & self._possible("x", "y"))
        return self._written(met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "jaccard-pairs")

    def members(self) -> DataFrame:
        """Every input row's node, key, n and ``component_id``: the smallest key it is linked to, itself included."""
        same = self.rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("node").alias("rep"), F.min("key").alias("least"))
        parts = components(self.spark, self.links).withColumnRenamed("node", "rep")
        named = same.join(parts, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
        whole = named.join(least, "comp").select("n", "s1", "s2", "component_id")
        linked = self.rows.where("n > 0").join(whole, ["n", "s1", "s2"]).select("node", "key", "n", "component_id")
        return linked.unionByName(self.rows.where("n = 0").select("node", "key", "n", F.col("key").alias("component_id")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, **more) -> DataFrame:
    """One document of each group of linked ones, that with the smallest key (null last), with its own columns.

    Documents without words are linked with nothing and all stay. See ``JaccardJoin`` for odd input.
    """
    # The rows get a number of their own, fixed by writing them: keys may be null or repeated.
    path = scratch_path(spark, "jaccard-rows")
    docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                F.monotonically_increasing_id().alias("id")).write.parquet(path)
    rows = spark.read.parquet(path)
    members = JaccardJoin(spark, rows.select("id", "text"), "id", "text", size, percent, **more).members()
    named = members.select(F.col("key").alias("id"), "component_id").join(rows.select("id", "key"), "id")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "id"))
    kept = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first.id").alias("id"))
    return rows.join(kept, "id", "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])


#: The registered query in DuckDB: equal sets as one class, classes that share a rare shingle compared, links closed step by step.
ORACLE = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] END)) AS s FROM docs),
classes AS MATERIALIZED (SELECT row_number() OVER () AS c, s, len(s) AS n, min(doc_id) AS first FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT c, n, t, count(*) OVER (PARTITION BY t) AS f FROM (SELECT c, n, unnest(s) AS t FROM classes)),
prefixes AS MATERIALIZED (
  SELECT c, n, t FROM tokens QUALIFY row_number() OVER (PARTITION BY c ORDER BY f, t) <= n - (9 * n + 9) // 10 + 1),
pairs AS (SELECT DISTINCT a.c AS a, b.c AS b FROM prefixes a JOIN prefixes b ON a.t = b.t AND a.c < b.c AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT a, b, x.n + y.n AS n, len(list_intersect(x.s, y.s)) AS shared
                    FROM pairs JOIN classes x ON x.c = a JOIN classes y ON y.c = b) WHERE 100 * shared >= 90 * (n - shared)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(c, m) AS (SELECT c, c FROM classes UNION SELECT reach.c, edges.b FROM reach JOIN edges ON reach.m = edges.a),
found AS (SELECT reach.c, min(first) AS component_id FROM reach JOIN classes ON classes.c = reach.m GROUP BY reach.c)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN (classes JOIN found USING (c)) ON classes.s = sets.s"""
