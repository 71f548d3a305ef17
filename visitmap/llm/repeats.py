"""Repeated windows over a whole corpus: the exchange behind the two substring operators.

A window is ``length`` consecutive symbols of one document. Every window is
owned by its anchor, a short run of symbols chosen by content, so equal windows
have equal anchors. Work goes in rounds over blocks of documents, each a shuffle
of packed arrays and not of rows:

1. blocks send the hashes of their anchors (each once) to buckets; a bucket
   answers which of them stand anywhere else too;
2. for those, blocks send a hash of each anchor's context (the stretch of all the
   windows that it owns). Equal contexts are settled here, all their windows
   together; where one anchor has different contexts that agree for far enough
   on one side, a copy of each is asked for;
3. the contexts asked for, once each, are compared window by window in their
   bucket, by the operator's own method;
4. the answers go back to the blocks.

A hot anchor (one with more than ``hot_contexts`` contexts, counted a block) is
not kept together: its windows go out one by one, by their own hash, each once a
block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from visitmap.llm.blocks import COLUMNS, bucket_count, unpack_block, with_messages
from visitmap.llm.textnum import _U, anchor_runs, pack_ints, ranges, unpack_ints, window_hashes, BYTE_VALUES
from visitmap.llm.scratch import scratch_path

LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Plan:
    """``symbols`` gives a block's symbols and document offsets; ``earlier`` says which
    windows go: those that a smaller document also has, or (False) all that repeat;
    ``compare`` finds, in one bucket, the windows of its contexts that go.

    An anchor's windows, ``length - gram + 1`` at most, have to fit a 64-bit mask:
    for longer windows the anchors get longer."""

    length: int
    gram: int
    earlier: bool
    symbols: Callable
    compare: Callable
    hot_contexts: int = 1024

    def __post_init__(self):
        object.__setattr__(self, "gram", max(self.gram, self.length - 63))


#: Contexts are compared by their anchor's hash and so many bytes of their own.
CONTEXT_BYTES = 6


def rows_of(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {k: batch.column(j)[i].as_py() for j, k in enumerate(batch.schema.names)}


def split_key(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (the top bits) and the next 32 bits of a 64-bit hash."""
    return (key >> _U(64 - bits)).astype(np.int64), (key >> _U(32 - bits)).astype(np.uint32)


def bucket_slices(buckets: np.ndarray):
    """(bucket, first, last + 1) for an ascending array."""
    if len(buckets):
        cut = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
        yield from zip(buckets[np.concatenate(([0], cut))].tolist(), [0, *cut.tolist()], [*cut.tolist(), len(buckets)])


def order_by(first: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """Ascending order by ``first``, by each of ``then`` where what stands before it is equal, by position at last.

    The others are sorted only where ``first`` is equal: it should tell most values apart."""
    order = np.argsort(first)
    same = first[order[1:]] == first[order[:-1]]
    tied = np.zeros(len(order), dtype=bool)
    tied[1:] = same
    tied[:-1] |= same
    some = np.sort(order[tied])
    order[tied] = some[np.lexsort((*(x[some] for x in reversed(then)), first[some]))]
    return order


def batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


def _arrow(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
    return [(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")]


ANCHORS = "bucket long, block long, keys binary, contexts binary"
FLAGS = "block long, bucket long, flags binary"
ENTRIES = "bucket long, block long, a binary, c binary, l binary, r binary, w binary, lo binary, n binary, own_lo binary, own_n binary"
STATUS = "block long, bucket long, gone_lo binary, gone_n binary, ask_a binary, ask_lo binary, ask_n binary, ask_w binary"
CONTEXTS = "bucket long, block long, a binary, lo binary, n binary, w binary, body binary"
MASKS = "block long, lo binary, mask binary"


def anchor_messages(plan: Plan, bits: int):
    """Each anchor once, with its number of different contexts (0: it stands here once; 255: or more)."""
    def send(batches):
        for row in rows_of(batches):
            ids, known, offs, body = unpack_block(row)
            symbols, offs = plan.symbols(body, offs)
            runs = anchor_runs(symbols, offs, plan.length, plan.gram)
            order = order_by(runs.anchor >> _U(32 - bits), runs.context)
            key, context = (runs.anchor >> _U(32 - bits))[order], runs.context[order]
            new, fresh = np.ones(len(key), dtype=bool), np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            fresh[1:] = new[1:] | (context[1:] != context[:-1])
            group, key = np.cumsum(new) - 1, key[new]
            count, kinds = np.bincount(group, minlength=len(key)), np.bincount(group, weights=fresh, minlength=len(key))
            kinds = np.where(count == 1, 0, np.minimum(kinds, 255)).astype(np.uint8)
            buckets, low = (key >> _U(32)).astype(np.int64), key.astype(np.uint32)
            yield batch(_arrow(ANCHORS), [(b, row["block"], pack_ints(np.diff(low[i:j], prepend=np.uint32(0))), kinds[i:j].tobytes())
                                          for b, i, j in bucket_slices(buckets)])
    return send


def flag_anchors(plan: Plan):
    """For every block's anchors: 0 alone, 1 repeated, 2 hot."""
    def reduce(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack_ints(x, np.uint32), dtype=np.uint32) for x in rows["keys"]]
        kinds = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["contexts"]])
        _, at, blocks = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        repeated = (blocks > 1) | (np.bincount(at, weights=kinds) > 0)
        contexts = np.bincount(at, weights=np.maximum(kinds, 1))
        flags = (repeated.astype(np.uint8) + (repeated & (contexts > plan.hot_contexts)))[at].astype(np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        return pd.DataFrame({"block": rows["block"], "bucket": key[0], "flags": [f.tobytes() for f in np.split(flags, ends[:-1])]})
    return reduce


def entry_messages(plan: Plan, bits: int):
    """Contexts of the repeated anchors: each once a block, further copies as ``own``."""
    def send(batches):
        for row in rows_of(batches):
            if not row["messages"]:
                continue
            ids, known, offs, body = unpack_block(row)
            symbols, offs = plan.symbols(body, offs)
            runs = anchor_runs(symbols, offs, plan.length, plan.gram)
            flags = np.concatenate([np.frombuffer(m["flags"], np.uint8) for m in sorted(row["messages"], key=lambda m: m["bucket"])])
            _, at = np.unique(runs.anchor >> _U(32 - bits), return_inverse=True)
            flag = flags[at]
            some, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
            key, context, left, right, lo, hi = runs.anchor[some], runs.context[some], runs.left[some], runs.right[some], runs.lo[some], runs.hi[some]
            if len(hot):  # window by window
                starts = ranges(runs.lo[hot], runs.hi[hot] - runs.lo[hot] + 1)
                one = window_of(symbols, starts, plan.length)
                none = np.zeros(len(starts), np.uint64)
                key, context = np.concatenate((key, one)), np.concatenate((context, one))
                left, right = np.concatenate((left, none)), np.concatenate((right, none))
                lo, hi = np.concatenate((lo, starts)), np.concatenate((hi, starts))
            doc = np.searchsorted(offs, lo, side="right") - 1
            doc = np.where(known[doc], ids[doc], LAST) if plan.earlier else np.zeros(len(lo), np.int64)
            order = order_by(key >> _U(32 - bits), context, doc, lo)
            key, context, left, right, lo, hi, doc = (x[order] for x in (key, context, left, right, lo, hi, doc))
            short = key >> _U(32 - bits)
            new = np.ones(len(lo), dtype=bool)
            new[1:] = (short[1:] != short[:-1]) | (context[1:] != context[:-1])
            head = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            if plan.earlier:  # a copy in a larger document goes; one in the same document shares the first one's fate
                weight, own = doc[head], ~new & (doc > doc[head][group] if len(head) else new)
                extra = ~new & ~own
                head = np.flatnonzero(new | extra)
                weight = doc[head]
            else:
                weight, own = np.bincount(group, minlength=len(head)).astype(np.int64), ~new
            buckets, low = split_key(key, bits)
            own_at, rows = np.flatnonzero(own), []
            own_cut = {b: (i, j) for b, i, j in bucket_slices(buckets[own_at])}
            for b, i, j in bucket_slices(buckets[head]):
                h = head[i:j]
                x, y = own_cut.get(b, (0, 0))
                o = own_at[x:y]
                rows.append((b, row["block"], pack_ints(np.diff(low[h], prepend=np.uint32(0))), pack_ints(context[h], CONTEXT_BYTES), pack_ints(left[h].astype(np.uint16)),
                             pack_ints(right[h].astype(np.uint16)), pack_ints(weight[i:j]), pack_ints(lo[h].astype(np.uint32)),
                             (hi - lo)[h].astype(np.uint8).tobytes(), pack_ints(lo[o].astype(np.uint32)), (hi - lo)[o].astype(np.uint8).tobytes()))
            yield batch(_arrow(ENTRIES), rows)
    return send


def window_of(symbols: np.ndarray, starts: np.ndarray, length: int, step: int = 1 << 16) -> np.ndarray:
    """Hash of the window at each of the ascending ``starts``."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    from visitmap.llm.textnum import mix

    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + step)))
        piece = symbols[starts[i]: starts[j - 1] + length]
        values = BYTE_VALUES[piece] if piece.dtype == np.uint8 else piece
        out[i:j] = mix(window_hashes(values, length)[starts[i:j] - starts[i]])
        i = j
    return out


def partnered(a: np.ndarray, c: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Where (a, part) also stands with another context than c; a part of 0 has no partner."""
    order = order_by(a.astype(np.uint64) << _U(32) | part.astype(np.uint64) << _U(16) | c >> _U(8 * CONTEXT_BYTES - 16), c)
    a, c, p = a[order], c[order], part[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1])
    other = ~new
    other[1:] &= c[1:] != c[:-1]
    group = np.cumsum(new) - 1
    many = np.bincount(group, weights=other) > 0
    out = np.empty(len(a), dtype=bool)
    out[order] = many[group] & (p != 0)
    return out


def settle_entries(plan: Plan):
    """Equal contexts are settled together; one copy of each that needs comparing is asked for."""
    def reduce(key, rows: pd.DataFrame) -> pd.DataFrame:
        read = lambda name, kind: np.concatenate([unpack_ints(x, kind) for x in rows[name]])
        l, r, w, lo = read("l", np.uint16), read("r", np.uint16), read("w", np.int64), read("lo", np.uint32)
        a = np.concatenate([np.cumsum(unpack_ints(x, np.uint32), dtype=np.uint32) for x in rows["a"]])
        c = np.concatenate([unpack_ints(x, np.uint64, CONTEXT_BYTES) for x in rows["c"]])
        n = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["n"]])
        sizes = np.array([len(x) for x in rows["n"]])
        order = order_by(a.astype(np.uint64) << _U(32) | c >> _U(8 * CONTEXT_BYTES - 32), c, w)
        new = np.ones(len(c), dtype=bool)
        new[1:] = (c[order][1:] != c[order][:-1]) | (a[order][1:] != a[order][:-1])
        group = np.empty(len(c), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        first = order[np.flatnonzero(new)]
        if plan.earlier:
            least = w[first]
            gone = w > least[group]
            chosen = ~gone
        else:
            total = np.bincount(group, weights=w)
            gone = total[group] >= 2
            chosen = np.zeros(len(c), dtype=bool)
            chosen[first] = True
        ask = chosen & (partnered(a, c, l) | partnered(a, c, r))
        ends = np.cumsum(sizes)
        out = []
        for block, i, j, own_lo, own_n in zip(rows["block"], ends - sizes, ends, rows["own_lo"], rows["own_n"]):
            g, q = np.flatnonzero(gone[i:j]) + i, np.flatnonzero(ask[i:j]) + i
            own = unpack_ints(own_lo, np.uint32)
            out.append((block, key[0], pack_ints(np.concatenate((lo[g], own))), n[g].tobytes() + own_n, pack_ints(a[q]), pack_ints(lo[q]), n[q].tobytes(), pack_ints(w[q])))
        return pd.DataFrame(out, columns=[x.split()[0] for x in STATUS.split(", ")])
    return reduce


def context_messages(plan: Plan):
    def send(batches):
        for row in rows_of(batches):
            asked = [m for m in row["status"] or () if m["ask_n"]]
            if not asked:
                continue
            ids, known, offs, body = unpack_block(row)
            symbols, offs = plan.symbols(body, offs)
            out = []
            for m in asked:
                lo, n = unpack_ints(m["ask_lo"], np.uint32), np.frombuffer(m["ask_n"], np.uint8)
                text = symbols[ranges(lo, n.astype(np.int64) + plan.length)]
                out.append((m["bucket"], row["block"], m["ask_a"], m["ask_lo"], m["ask_n"], m["ask_w"], text.tobytes()))
            yield batch(_arrow(CONTEXTS), out)
    return send


#: Symbols that are compared at once: an anchor's contexts stand together, others don't meet.
AT_ONCE = 1 << 18


def compare_contexts(plan: Plan):
    def reduce(key, rows: pd.DataFrame) -> pd.DataFrame:
        kind = np.uint8 if plan.earlier else np.uint64
        read = lambda name, t: np.concatenate([unpack_ints(x, t) for x in rows[name]])
        n = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["n"]]).astype(np.int64)
        a, w = read("a", np.uint32), read("w", np.int64)
        symbols = np.concatenate([np.frombuffer(x, kind) for x in rows["body"]])
        sizes = np.array([len(x) for x in rows["n"]])
        block = np.repeat(rows["block"].to_numpy(), sizes)
        begin = np.cumsum(n + plan.length) - (n + plan.length)
        masks = np.zeros(len(n), dtype=np.uint64)
        order = np.lexsort((block, a))
        new = np.flatnonzero(np.concatenate(([True], a[order][1:] != a[order][:-1])))
        before = np.concatenate(([0], np.cumsum((n + plan.length)[order])))
        i = 0
        while i < len(new):
            j = max(i + 1, int(np.searchsorted(before[np.append(new, len(n))], before[new[i]] + AT_ONCE, side="right")) - 1)
            some = order[new[i]: new[j] if j < len(new) else len(n)]
            some = some[np.argsort(block[some], kind="stable")]
            shard = np.unique(block[some], return_inverse=True)[1]
            masks[some] = plan.compare(symbols[ranges(begin[some], n[some] + plan.length)], n[some], w[some], shard)
            i = j
        return pd.DataFrame({"block": rows["block"], "lo": rows["lo"], "mask": [pack_ints(m) for m in np.split(masks, np.cumsum(sizes)[:-1])]})
    return reduce


def window_bits(n: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """A bit mask a context from flags of all its windows, context after context."""
    count = n + 1
    bit = np.left_shift(_U(1), (np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64))
    return np.bitwise_or.reduceat(np.where(hit, bit, _U(0)), np.cumsum(count) - count)


def covered(size: int, length: int, status: list, masks: list) -> np.ndarray:
    """Which of a block's symbols stand in a window that goes."""
    edge = np.zeros(size + 1, dtype=np.int32)
    for m in status or ():
        lo, n = unpack_ints(m["gone_lo"], np.uint32).astype(np.int64), np.frombuffer(m["gone_n"], np.uint8)
        np.add.at(edge, lo, 1)
        np.add.at(edge, lo + n + length, -1)
    for m in masks or ():
        lo, mask = unpack_ints(m["lo"], np.uint32).astype(np.int64), unpack_ints(m["mask"], np.uint64)
        at, bit = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        np.add.at(edge, lo[at] + bit, 1)
        np.add.at(edge, lo[at] + bit + length, -1)
    return np.cumsum(edge[:-1]) > 0


#: Every block has a message for every bucket. So buckets grow, to so many times their
#: size, before there are more than FEW of them: messages stay large, their number follows the blocks'.
FEW, GROWN = 512, 32


def bucket_bits(blocks: DataFrame, bucket_bytes: int) -> int:
    n = bucket_count(blocks, bucket_bytes)
    return min(n, max(FEW, n // GROWN)).bit_length() - 1


def find_repeats(spark: SparkSession, blocks: DataFrame, plan: Plan, name: str, bucket_bytes: int = 1 << 20) -> DataFrame:
    """The blocks with ``status`` and ``masks``, to be read by ``covered``."""
    bits = bucket_bits(blocks, bucket_bytes)
    blocks = blocks.select(*COLUMNS)
    flags = blocks.mapInArrow(anchor_messages(plan, bits), ANCHORS).groupBy("bucket").applyInPandas(flag_anchors(plan), FLAGS)
    entries = with_messages(blocks, flags, ["bucket", "flags"]).mapInArrow(entry_messages(plan, bits), ENTRIES)
    path = scratch_path(spark, name)
    entries.groupBy("bucket").applyInPandas(settle_entries(plan), STATUS).write.parquet(path)
    status = spark.read.schema(STATUS).parquet(path)
    held = with_messages(blocks, status, [x.split()[0] for x in STATUS.split(", ")][1:], "status")
    masks = held.mapInArrow(context_messages(plan), CONTEXTS).groupBy("bucket").applyInPandas(compare_contexts(plan), MASKS)
    return with_messages(held, masks, ["lo", "mask"], "masks")
