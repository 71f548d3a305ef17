"""Repeated byte strings by merging shards' Burrows-Wheeler transforms.

The stretches of text that may repeat meet in buckets (see ``repeats``), each
different stretch once. In a bucket every shard (the stretches from some
blocks) gets its own transform. The transforms are merged without sorting the
suffixes again: an interleave, which shard the next suffix comes from, is refined
step by step. One step reads the merged transform in the present order and
deals it out stably by its symbols, which puts the suffixes right for as many
symbols more. Suffixes that a step first tells apart have their common prefix
known; those never told apart in ``length`` symbols form an interval of the
merged transform, a repeated string, with the smallest document that has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from visitmap.llm.blocks import text_column, unpack_block, write_blocks
from visitmap.llm.repeats import Plan, covered, find_repeats, rows_of, window_bits
from visitmap.llm.textnum import ranges

SCHEMA = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
SHARDS = 8


#: Grams are numbered with a table of so many places a symbol of the text, and 16 million, at most.
PLACES = 8


class Grams:
    """The runs of a few symbols at every position, numbered in their order.

    ``text`` holds small symbols, 0 ending each string; a string is taken as a ring.
    ``at[k][p]`` is the number of the k symbols from position p on. The longest runs
    have the most symbols, up to ``longest``, with numbers that still fit 16 bits.
    """

    def __init__(self, text: np.ndarray, sizes: np.ndarray, letters: int, longest: int):
        n = len(text)
        end = np.cumsum(sizes)
        self.ahead = np.arange(1, n + 1)
        self.ahead[end - 1] = end - sizes
        self.at = {1: text}
        if longest < 2:
            return
        if letters > 256:  # no room in 16 bits
            self.at[2] = text.astype(np.uint32) * np.uint32(letters) + text[self.ahead]
            return
        code, count, k, far = text, letters, 1, self.ahead
        while k < longest and count * letters <= min(max(PLACES * n, 1 << 16), 1 << 24):
            code, count = numbered(code, text[far], count, letters)
            if count > 1 << 16:
                break
            k, far = k + 1, self.ahead[far]
            self.at[k] = code

    def steps(self, length: int) -> list[int]:
        """Run lengths that add up to ``length``, long ones first."""
        out = []
        for k in sorted(self.at, reverse=True):
            out += [k] * ((length - sum(out)) // k)
        return out


def numbered(high: np.ndarray, low: np.ndarray, n_high: int, n_low: int) -> tuple[np.ndarray, int]:
    """Ranks of the pairs (high, low) among those there are, and how many there are."""
    both = high.astype(np.int32) * np.int32(n_low) + low
    there = np.zeros(n_high * n_low, dtype=bool)
    there[both] = True
    count = int(np.count_nonzero(there))
    rank = np.cumsum(there, dtype=np.int32) - 1
    return rank.astype(np.uint16 if count <= 1 << 16 else np.int32)[both], count


class Shard:
    """The rotations of terminated strings in order of their first ``length`` symbols.

    ``text`` holds small symbols, 0 ending each string. ``before[k][p]`` is the number
    of the k symbols before position p, within p's string taken as a ring, for the
    run lengths of ``steps``. ``grams``: those of the whole text that these strings
    stand in from ``at`` on; without it, pairs of these strings alone.
    """

    def __init__(self, text: np.ndarray, sizes: np.ndarray, length: int, letters: int, grams: Grams | None = None, at: int = 0):
        n = len(text)
        ring = grams.ahead[at: at + n] - at if grams else None
        if grams is None:
            grams = Grams(text, sizes, max(letters, 257), min(length, 2))  # numbers that other shards have too
            ring = grams.ahead
        back = np.empty(n, dtype=np.int64)
        back[ring] = np.arange(n)
        self.steps = grams.steps(length)
        # Order by the symbols from the last to the first, a run at a time.
        order = np.arange(n)
        start = order.copy()
        for _ in range(length):
            start = ring[start]
        far, self.before = {}, {}
        for k in sorted(set(self.steps)):
            to = np.arange(n)
            for _ in range(k):
                to = back[to]
            far[k], self.before[k] = to, grams.at[k][at: at + n][to]
        for k in reversed(self.steps):
            order = order[np.argsort(self.before[k][start][order], kind="stable")]
            start = far[k][start]
        self.order = order


def merge_shards(shards: list[Shard], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave of the shards, interval of each suffix, and common prefix with the one before.

    Intervals number the groups of suffixes that agree in their first ``length``
    symbols; the common prefix is exact up to the step, which is two symbols if
    the shards have no longer runs.
    """
    sizes = [len(s.order) for s in shards]
    columns = {k: np.concatenate([s.before[k][s.order] for s in shards]) for k in shards[0].before}
    z = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    group = np.zeros(len(z), dtype=np.int32)
    prefix = np.full(len(z), length, dtype=np.int16)
    done = 0
    for step in shards[0].steps:
        merged = np.empty_like(columns[step])
        merged[np.argsort(z, kind="stable")] = columns[step]  # the merged transform in the present order
        deal = np.argsort(merged, kind="stable")
        symbol, was = merged[deal], group[deal]
        z = z[deal]
        told = np.ones(len(z), dtype=bool)
        told[1:] = (symbol[1:] != symbol[:-1]) | (was[1:] != was[:-1])
        group = np.cumsum(told, dtype=np.int32) - 1
        np.copyto(prefix, done, where=told & (prefix == length))
        done += step
    return z, group, prefix


def merge_contexts(length: int):
    """Flags of the windows that a smaller document has too."""
    def compare(body: np.ndarray, n: np.ndarray, doc: np.ndarray, shard: np.ndarray) -> np.ndarray:
        sizes = n + length
        present, text = np.unique(body, return_inverse=True)
        letters = len(present) + 1
        text = (text + 1).astype(np.uint16 if letters > 256 else np.uint8)
        closed = np.zeros(len(body) + len(n), dtype=text.dtype)
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        closed[ranges(begin, sizes)] = text
        count = int(shard[-1]) + 1
        part = shard * min(SHARDS, count) // count  # neighbouring blocks together
        shards, offsets, grams = [], [], Grams(closed, sizes + 1, letters, length)
        for k in range(int(part[-1]) + 1):
            i, j = np.searchsorted(part, [k, k + 1])
            lo, hi = begin[i], begin[j - 1] + sizes[j - 1] + 1
            shards.append(Shard(closed[lo:hi], sizes[i:j] + 1, length, letters, grams, lo))
            offsets.append(lo)
        z, group, _ = merge_shards(shards, length)
        place = np.empty(len(z), dtype=np.int64)
        place[np.argsort(z, kind="stable")] = np.concatenate([s.order + o for s, o in zip(shards, offsets)])
        owner = np.repeat(doc, sizes + 1)[place]
        cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.minimum.reduceat(owner, cut)[group]
        earlier = np.zeros(len(closed), dtype=bool)
        earlier[place] = least < owner
        return window_bits(n, earlier[ranges(begin, n + 1)])
    return compare


def remove_bytes(length: int):
    def finish(batches):
        for row in rows_of(batches):
            ids, known, offs, body = unpack_block(row)
            gone = covered(len(body), length, row["status"], row["masks"])
            total = np.concatenate(([0], np.cumsum(gone)))[offs]
            new, last = gone.copy(), gone.copy()
            new[1:] &= ~gone[:-1]
            last[:-1] &= ~gone[1:]
            full = offs[:-1][offs[1:] > offs[:-1]]
            new[full] = gone[full]
            full = offs[1:][offs[1:] > offs[:-1]] - 1
            last[full] = gone[full]
            s, e = np.flatnonzero(new), np.flatnonzero(last) + 1
            doc = np.searchsorted(offs, s, side="right") - 1
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(s, offs).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(s - offs[doc]), pa.array(e - offs[doc])], names=["start", "end"]))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, mask=~known), pa.array(np.diff(offs)), pa.array(np.diff(total)), spans, text_column(body[~gone], offs - total, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
    return finish


def block_bytes_as_symbols(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return body, offs


def dedup_by_merged_transforms(spark: SparkSession, docs: DataFrame, length: int = 50, gram: int = 20, key: str = "doc_id",
                               text: str = "text", hot_contexts: int = 1024, block_bytes: int = 4 << 20, bucket_bytes: int = 1 << 20) -> DataFrame:
    """Remove the bytes of every ``length``-byte string that a document with a smaller id has too.

    Texts are UTF-8 bytes and strings never cross documents; the kept bytes may
    split a character. Strings are judged on the input. One row per input row: a
    null text is empty; a null id stays null and counts as larger than all ids;
    rows with equal ids (or null ids) are not smaller than each other, so they keep their common
    strings; a text under ``length`` bytes is kept; an empty table gives no row.
    Other columns, whatever their names, are not read.
    """
    plan = Plan(length, gram, True, block_bytes_as_symbols, merge_contexts(length), hot_contexts)
    blocks = write_blocks(spark, docs, "bwt-blocks", key, text, block_bytes=block_bytes)
    return find_repeats(spark, blocks, plan, "bwt-status", bucket_bytes).mapInArrow(remove_bytes(length), SCHEMA)


#: The registered query in DuckDB: strings of 50 bytes, bytes covered by one that starts in an earlier document.
ORACLE = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
bytes AS MATERIALIZED (SELECT r, doc_id, b, octet_length(b) AS n, unnest(range(1, octet_length(b) + 1)) AS j FROM docs),
windows AS (SELECT r, j, doc_id, CASE WHEN j + 49 <= n THEN md5(b[j:j + 49]) END AS s FROM bytes),
starts AS (SELECT r, j, CASE WHEN s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id THEN 1 ELSE 0 END AS starts FROM windows),
marked AS (SELECT r, j, max(starts) OVER (PARTITION BY r ORDER BY j ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM starts),
edged AS (SELECT r, j, gone, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY j) AS before FROM marked),
counted AS (
  SELECT r, sum(gone) AS n_removed, count(*) FILTER (WHERE gone = 1 AND before = 0) AS n_spans,
         string_agg(hex(b[j:j]), '' ORDER BY j) FILTER (WHERE gone = 0) AS kept
  FROM edged JOIN docs USING (r) GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN counted USING (r)"""
