"""Documents packed into blocks: the unit that later steps shuffle and read again.

A block is one row: some thousand documents' ids, their offsets and their
compressed bytes. The blocks are written once, in scan order and without a
shuffle, to the scratch folder that all executors share, so a block's content
stays the same for every later step, also when executors are lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.textnum import pack_ints, slices, string_column, unpack_ints, word_bounds
from visitmap.llm.scratch import scratch_path

BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 1 << 20
SCHEMA = "block long, size long, n_docs long, ids binary, known binary, offs binary, body binary"
COLUMNS = ["block", "ids", "known", "offs", "body"]


def squeeze_words(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents' words, each followed by one space."""
    starts, ends, first = word_bounds(body, offs)
    size = ends - starts + 1
    after = np.cumsum(size)
    out = np.full(int(after[-1]) if len(after) else 0, 0x20, dtype=np.uint8)
    letters = np.ones(len(out), dtype=bool)
    letters[after - 1] = False
    mark = np.zeros(len(body) + 1, dtype=np.int8)
    mark[starts] = 1
    mark[ends] -= 1
    out[letters] = body[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)]
    return out, np.concatenate(([0], after))[first]


def write_blocks(spark: SparkSession, docs: DataFrame, name: str, key: str = "doc_id", text: str = "text",
                 words: bool = False, block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Write ``docs`` as blocks and read them back.

    ``words`` keeps only the words, one space after each. A null text is empty, a
    null id stays null. One document larger than ``block_bytes`` is a block alone; a block of short
    or empty texts ends after ``block_docs`` of them.
    """
    def pack(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        squash = zstandard.ZstdCompressor(level=3)
        held, size, docs_held = [], 0, 0

        def block():
            nonlocal held, size, docs_held, seq
            ids = np.concatenate([x[0] for x in held])
            known = np.concatenate([x[1] for x in held])
            body = np.concatenate([x[2] for x in held])
            sizes = np.concatenate([np.diff(x[3]) for x in held])
            offs = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            row = pa.RecordBatch.from_arrays([
                pa.array([(part << 32) | seq], pa.int64()), pa.array([len(body)], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([ids.tobytes()], pa.binary()), pa.array([np.packbits(known).tobytes()], pa.binary()),
                pa.array([pack_ints(offs)], pa.binary()), pa.array([squash.compress(body.tobytes())], pa.binary())],
                names=["block", "size", "n_docs", "ids", "known", "offs", "body"])
            held, size, docs_held, seq = [], 0, 0, seq + 1
            return row

        for batch in batches:
            body, offs = string_column(batch.column(1))
            key_column = batch.column(0)
            known = ~np.asarray(key_column.is_null())
            ids = np.asarray(key_column.fill_null(0)).astype(np.int64)
            for i, j in ((k, min(k + block_docs, j)) for i, j in slices(offs, block_bytes // 4) for k in range(i, j, block_docs)):
                b, o = body[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
                if words:
                    b, o = squeeze_words(b, o)
                held.append((ids[i:j], known[i:j], b.copy(), o))
                size += len(b)
                docs_held += j - i
                if size >= block_bytes * 3 // 4 or docs_held >= block_docs:
                    yield block()
        if held:
            yield block()

    path = scratch_path(spark, name)
    (docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
     .mapInArrow(pack, SCHEMA).write.option("compression", "none").parquet(path))
    return spark.read.schema(SCHEMA).parquet(path)


def unpack_block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, known (False where an id is null), offsets and bytes of a block's documents."""
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    known = np.unpackbits(np.frombuffer(row["known"], dtype=np.uint8), count=len(ids)).astype(bool)
    offs = unpack_ints(row["offs"], np.int64)
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"]), dtype=np.uint8)
    return ids, known, offs, body


def bucket_count(blocks: DataFrame, bucket_bytes: int) -> int:
    """A power of two that grows with the data, so that a bucket's share doesn't."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    return 1 << max(6, int(max(1, total // bucket_bytes) - 1).bit_length())


def with_messages(blocks: DataFrame, messages: DataFrame, names: list[str], to: str = "messages") -> DataFrame:
    """Every block with the messages for it, as one array of structs (null: none)."""
    gathered = messages.groupBy("block").agg(F.collect_list(F.struct(*names)).alias(to))
    return blocks.join(gathered, "block", "left")


def text_column(pieces: np.ndarray, offs: np.ndarray, kind=pa.string()) -> pa.Array:
    """An Arrow column over bytes and offsets, without a Python object a row."""
    return pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int32).tobytes()), pa.py_buffer(pieces.tobytes())])
