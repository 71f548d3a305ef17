"""Substring dedup by relative Lempel-Ziv parsing.

Documents are parsed against reference blocks. A reference block holds every
stretch of the corpus whose anchors fall in its share of the hash space (see
``repeats``), each different stretch once, indexed by its windows of
``length`` words. Parsing is greedy: at a position the index gives another place
with the same window, the factor is extended word by word as far as both
agree, and parsing goes on at the factor's boundary, ``length - 1`` words before
its end, so that windows across the boundary are checked too. Factors have at
least ``length`` words; what they cover is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from visitmap.llm.blocks import squeeze_words, text_column, unpack_block, write_blocks
from visitmap.llm.repeats import Plan, covered, find_repeats, rows_of, window_bits
from visitmap.llm.textnum import ranges, window_hashes, word_bounds, word_hashes

SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"


def block_words(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_bounds(body, offs)
    return word_hashes(body, starts, ends), first


class ReferenceBlock:
    """Stretches of words with an index of all their windows."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, length: int):
        self.words, self.length = words, length
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        starts = ranges(self.begin, sizes - length + 1)
        hashes = window_hashes(words, length)[starts]
        order = np.lexsort((starts, hashes))
        self.hash, self.start = hashes[order], starts[order]
        # The next place with the same window, the last one pointing back.
        same = np.zeros(len(order), dtype=bool)
        same[:-1] = self.hash[1:] == self.hash[:-1]
        other = np.where(same, np.roll(self.start, -1), -1)
        back = np.zeros(len(order), dtype=bool)
        back[1:] = same[:-1]
        other = np.where(~same & back, np.roll(self.start, 1), other)
        self.source = np.full(len(words), -1, dtype=np.int64)
        self.source[self.start] = other
        self.limit = np.repeat(self.end, sizes)

    def factor(self, at: np.ndarray) -> np.ndarray:
        """Length of the factor that starts at each position: 0, or ``length`` and more."""
        source = self.source[at]
        size = np.zeros(len(at), dtype=np.int64)
        live = np.flatnonzero(source >= 0)
        # The hash proposes, the words decide.
        steps = np.arange(self.length)
        agree = (self.words[at[live][:, None] + steps] == self.words[source[live][:, None] + steps]).all(axis=1)
        live = live[agree]
        size[live] = self.length
        while len(live):
            a, b = at[live] + size[live], source[live] + size[live]
            inside = (a < self.limit[at[live]]) & (b < self.limit[source[live]])
            live, a, b = live[inside], a[inside], b[inside]
            live = live[self.words[a] == self.words[b]]
            size[live] += 1
        return size


def parse_contexts(length: int):
    """Greedy parse of every stretch against its reference block; flags of the windows inside factors."""
    def compare(words: np.ndarray, n: np.ndarray, _weight: np.ndarray, _shard: np.ndarray) -> np.ndarray:
        block = ReferenceBlock(words, n + length, length)
        base = np.cumsum(n + 1) - (n + 1)
        hit = np.zeros(int((n + 1).sum()), dtype=bool)
        at, live = np.zeros(len(n), dtype=np.int64), np.arange(len(n))
        while len(live):
            size = block.factor(block.begin[live] + at[live])
            found = np.maximum(size - length + 1, 0)
            hit[ranges(base[live] + at[live], found)] = True
            at[live] += np.maximum(found, 1)
            live = live[at[live] <= n[live]]
        return window_bits(n, hit)
    return compare


def remove_words(length: int):
    def finish(batches):
        for row in rows_of(batches):
            ids, known, offs, body = unpack_block(row)
            starts, ends, first = word_bounds(body, offs)
            gone = covered(len(starts), length, row["status"], row["masks"])
            total = np.concatenate(([0], np.cumsum(gone)))
            edge = np.zeros(len(gone) + 1, dtype=bool)
            if len(gone):
                new = gone.copy()
                new[1:] &= ~gone[:-1]
                edge[first[:-1]] = True
                new |= gone & edge[:-1]
                last = gone.copy()
                last[:-1] &= ~gone[1:]
                ends_doc = np.zeros(len(gone) + 1, dtype=bool)
                ends_doc[first[1:]] = True
                last |= gone & ends_doc[1:]
            else:
                new = last = gone
            s, e = np.flatnonzero(new), np.flatnonzero(last) + 1
            doc = np.searchsorted(first, s, side="right") - 1
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(s, first).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array((s - first[doc]).astype(np.int32)), pa.array((e - first[doc]).astype(np.int32))], names=["start", "end"]))
            keep = np.repeat(~gone, ends - starts + 1)
            # A document's last kept word loses its space.
            kept_words = np.concatenate(([0], np.cumsum(~gone)))[first]
            after = np.concatenate(([0], np.cumsum((ends - starts + 1)[~gone])))
            size = np.diff(after[kept_words])
            text = body[keep]
            tail = (after[kept_words][1:] - 1)[size > 0]
            text = np.delete(text, tail)
            where = np.concatenate(([0], np.cumsum(np.maximum(size - 1, 0))))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, mask=~known), pa.array(np.diff(first)), pa.array(np.diff(total[first])), spans, text_column(text, where)],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])
    return finish


def dedup_by_parsing(spark: SparkSession, docs: DataFrame, length: int = 35, gram: int = 8, key: str = "doc_id",
                     text: str = "text", hot_contexts: int = 1024, block_bytes: int = 4 << 20, bucket_bytes: int = 1 << 20) -> DataFrame:
    """Remove the words of every ``length``-word window that stands anywhere else too.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. All copies go, the first one too,
    and a copy may overlap itself (one word repeated). Windows are judged on the
    input. One row per input row: a null text is empty (0 words, empty kept text,
    no span); a null id stays null; repeated rows are each other's copies; a
    text under ``length`` words is kept; an empty table gives no row. Other
    columns, whatever their names, are not read.
    """
    plan = Plan(length, gram, False, block_words, parse_contexts(length), hot_contexts)
    blocks = write_blocks(spark, docs, "rlz-blocks", key, text, words=True, block_bytes=block_bytes)
    return find_repeats(spark, blocks, plan, "rlz-status", bucket_bytes).mapInArrow(remove_words(length), SCHEMA)


#: The registered query in DuckDB: windows of 35 words by their text, words covered by a repeated one.
ORACLE = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS MATERIALIZED (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM docs),
windows AS (
  SELECT r, j, md5(array_to_string(w[j:j + 34], ' ')) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS j FROM docs)),
repeated AS (SELECT r, j, 1 AS starts FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1),
marked AS (
  SELECT r, j, word, max(coalesce(starts, 0)) OVER (PARTITION BY r ORDER BY j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN repeated USING (r, j)),
kept AS (
  SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (WHERE gone = 0) AS kept_text FROM marked GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""
