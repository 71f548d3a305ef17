"""BPE encoding that encodes chunks shared across documents once.

A rolling hash cuts every text where its content says so, so a passage that
documents share falls into the same chunks in all of them. Chunks found in
two or more places are encoded once, by one document that has them (the one whose
id and text hash smallest), and their tokens are sent to the others. A chunk may begin and end inside a
word, so only its inner part (from its first white space to its last) is
encoded with it. At every join the words across it are encoded again, with a
word of each side: the join agrees when the result begins and ends with the
tokens of those two words, otherwise the stretch grows by a word on both sides
and is encoded again, in the end with both chunks whole.
"""

from __future__ import annotations

import json
import sys
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.llm.textnum import _MULT, _U, BYTE_VALUES, IS_SPACE, powers, slices, string_column, word_hashes
from visitmap.llm.scratch import scratch_path

SPAN = 24
CHUNK_BYTES = 1024
MOST_BYTES = 1 << 16
CACHED = 200_000


def cut_chunks(body: np.ndarray, offs: np.ndarray, average: int = CHUNK_BYTES, most: int = MOST_BYTES, piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends of all documents, ascending, and a hash of every chunk.

    A chunk ends after ``SPAN`` bytes of one document whose hash says so, at the
    latest after ``most`` bytes, and at the document's end. The work goes by pieces, so that its arrays
    don't grow with a text.
    """
    n = len(body)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends, found = offs[1:][offs[1:] > offs[:-1]], []
    for at in range(0, n - SPAN, piece):
        part = body[at: at + piece + SPAN - 1]
        p, q = powers(len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[part] * p[: len(part)], out=total[1:])
        h = (total[SPAN:] - total[:-SPAN]) * q[: len(part) - SPAN + 1]
        h *= _MULT
        found.append(np.flatnonzero((h >> _U(40)) % _U(average) == 0) + SPAN + at)
    if found:
        cut = np.concatenate(found)
        begin = offs[np.searchsorted(offs, cut, side="left") - 1]
        ends = np.union1d(ends, cut[cut - begin >= SPAN])
    starts = np.concatenate(([0], ends[:-1]))
    long = np.flatnonzero(ends - starts > most)
    if len(long):
        ends = np.union1d(ends, np.concatenate([np.arange(starts[i] + most, ends[i], most) for i in long]))
        starts = np.concatenate(([0], ends[:-1]))
    return ends, word_hashes(body, starts, ends, step=piece)


def little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


# The pattern of tokenizers that part a word's closing signs from it before any merge,
# and these signs.
PARTING_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


class Encoder:
    """Tokens of byte strings without white space inside (cached) and of short stretches."""

    def __init__(self, tokenizer_json: str, remember: int = CACHED):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.remember = remember
        self.tokens: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # of the words before those; the ones still in use move up
        table = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.table = [(x or "").encode() for x in table]
        told = json.loads(tokenizer_json)
        steps = lambda part, name: (told.get(part) or {}).get(name) or [told.get(part) or {}]
        self.added = [x["content"].lower().encode() for x in told.get("added_tokens") or ()]
        # Words that differ in what the tokenizer itself undoes first are looked up as one.
        self.lowers = steps("normalizer", "normalizers")[-1].get("type") == "Lowercase"
        self.parts = self.lowers and (steps("pre_tokenizer", "pretokenizers")[0].get("pattern") or {}).get("Regex") == PARTING_PATTERN

    def pieces(self, word: bytes) -> tuple[bytes, bytes]:
        """A word without what doesn't change its tokens, and its closing signs, which are tokens of their own."""
        if not self.lowers:
            return word, b""
        low = word.lower()
        if any(x in low for x in self.added):  # these are looked for before anything is undone
            return word, b""
        word = low
        if not self.parts or word[-1] in PLAIN:
            return word, b""
        head = word.rstrip(SIGNS)
        return (head, word[len(head):]) if head and head[-1] in PLAIN else (word, b"")

    def learn(self, texts) -> None:
        """Have the tokens of all ``texts`` (words) in ``tokens``; words long unused are forgotten."""
        if len(self.tokens) > self.remember:
            self.tokens, self.older = {}, self.tokens
        tokens, older = self.tokens, self.older
        unknown = []
        for x in set(texts).difference(tokens):
            known = older.get(x)
            if known is None:
                unknown.append((x, *self.pieces(x)))
            else:
                tokens[x] = known
        if not unknown:
            return
        fresh = {}
        for _, head, tail in unknown:
            for x in (head, tail) if tail else (head,):
                if x not in tokens:
                    fresh[x] = older.get(x)
        new = [x for x, known in fresh.items() if known is None]
        if new:
            for x, e in zip(new, self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in new], add_special_tokens=False)):
                fresh[x] = little_endian(e.ids)
        tokens.update(fresh)
        for x, head, tail in unknown:
            tokens[x] = tokens[head] + tokens[tail] if tail else tokens[head]

    def words(self, text: bytes) -> bytes:
        words = text.split()
        try:
            return b"".join(map(self.tokens.__getitem__, words))
        except KeyError:
            self.learn(words)
            return b"".join(map(self.tokens.__getitem__, words))

    def decoded(self, ids: bytes) -> bytes:
        """The text of little-endian ids: their tokens with a space between each two."""
        return b" ".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def join(self, left: list[bytes], middle: bytes, right: list[bytes]) -> bytes:
        """Tokens of ``middle``, which stands between two encoded chunks with these words."""
        size = 1
        while True:
            a, b = left[-size:], right[:size]
            stretch = b" ".join([*a, *([middle] if middle else []), *b])
            whole = little_endian(self.tokenizer.encode(stretch.decode("utf-8", "replace"), add_special_tokens=False).ids)
            before, after = self.words(b" ".join(a)), self.words(b" ".join(b))
            inner = whole[len(before): len(whole) - len(after)]
            if whole.startswith(before) and whole.endswith(after) and len(before) + len(after) <= len(whole):
                return inner
            if size >= max(len(left), len(right)):
                raise ValueError("a tokenizer whose words depend on their neighbours can't be used with chunks")
            size *= 2


_encoders: dict[tuple[int, int], Encoder] = {}


def encoder(tokenizer_json: str, remember: int = CACHED) -> Encoder:
    """One a worker process."""
    key = hash(tokenizer_json), remember
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json, remember)
    return _encoders[key]


class Layout:
    """Chunks of a piece of documents: ends, hashes, owner, and the inner part's bounds."""

    def __init__(self, body: np.ndarray, offs: np.ndarray, average: int):
        self.ends, self.hash = cut_chunks(body, offs, average)
        self.starts = np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends
        self.first = np.searchsorted(self.ends, offs, side="right")  # chunk range of each document
        self.first[-1] = len(self.ends)
        spaces = np.flatnonzero(IS_SPACE[body])
        i, j = np.searchsorted(spaces, self.starts), np.searchsorted(spaces, self.ends)
        self.has = j > i
        some = np.concatenate((spaces, [0]))
        self.head = np.where(self.has, some[np.minimum(i, len(spaces))], self.ends)  # first white space
        self.tail = np.where(self.has, some[j - 1], self.ends)  # last white space


def encode_document(enc: Encoder, text: bytes, at: int, layout: Layout, chunks: range, known: dict[int, bytes]) -> bytes:
    """Tokens of one document (little-endian 32-bit), from its chunks' tokens and repaired joins."""
    out, pending, left = [], b"", []
    for c in chunks:
        if not layout.has[c]:
            pending += text[layout.starts[c] - at: layout.ends[c] - at]
            continue
        inner = text[layout.head[c] - at: layout.tail[c] - at]
        pending += text[layout.starts[c] - at: layout.head[c] - at]
        right = inner.split(None, 1)[:1]
        if pending:
            out.append(enc.join(left, pending, right))
        tokens = known.get(int(layout.hash[c]))
        out.append(enc.words(inner) if tokens is None else tokens)
        left = inner.rsplit(None, 1)[-1:] or left[-1:] if not pending or inner.strip() else []
        pending = text[layout.tail[c] - at: layout.ends[c] - at].strip()
    if pending:
        out.append(enc.join(left, pending, []))
    return b"".join(out)


def encode_corpus(spark: SparkSession, docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                  average: int = CHUNK_BYTES, carry: list[str] = (), decode_to: str | None = None, remember: int = CACHED) -> DataFrame:
    """``key``, ``ids`` (little-endian unsigned 32-bit integers) and the ``carry`` columns of every row.

    ``decode_to`` names a column for the decoded text, as ``decode_corpus`` would add it, from the same pass.

    ``remember``: a worker keeps the tokens of up to about twice so many words (some 200 bytes each); with fewer it works longer.

    ``tokenizer`` is the path of a tokenizers JSON file, read by the driver and
    broadcast (its size is the vocabulary's). The result is that of the library
    on the whole text, without special tokens added, truncation or padding. Null
    text: empty, no ids. Null or repeated keys and repeated rows: each row is
    encoded. Empty table: no rows. Long texts are cut into many chunks.

    Rows go by a hash of key and text: only rows alike in both share it, and one of
    them stands for their chunks, so nothing gathered for a row is larger than its
    own text. Two other rows that share it by chance encode their chunks themselves.
    """
    vocabulary = spark.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())
    z = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows = docs.select(F.xxhash64(F.col(key), z).alias("k"), F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([key, *carry])]).alias("row"), z.alias("z"))
    chunk_schema = "k long, h array<long>"

    def list_chunks(batches):
        for batch in batches:
            body, offs = string_column(batch.column(1))
            keys = batch.column(0)
            for i, j in slices(offs, 1 << 20):
                o = offs[i: j + 1] - offs[i]
                layout = Layout(body[offs[i]: offs[j]], o, average)
                yield pa.RecordBatch.from_arrays([keys.slice(i, j - i), pa.ListArray.from_arrays(pa.array(layout.first.astype(np.int32)), pa.array(layout.hash.view(np.int64)))], names=["k", "h"])

    path = scratch_path(spark, "bpe-chunks")
    rows.select("k", "z").mapInArrow(list_chunks, chunk_schema).write.parquet(path)
    listed = spark.read.schema(chunk_schema).parquet(path).where("size(h) > 0")
    listed = listed.groupBy("k").agg(F.count("*").alias("alike"), F.first("h").alias("h"))
    chunks = listed.select("k", "alike", F.explode(F.array_distinct("h")).alias("h"))
    shared = chunks.groupBy("h").agg(F.sum("alike").alias("n"), F.min("k").alias("k")).where("n > 1")
    asked = shared.groupBy("k").agg(F.collect_list("h").alias("asked"))

    def squash(batches):
        z = zstandard.ZstdCompressor(level=1)
        at = None
        for batch in batches:
            at = batch.schema.names.index("z")
            small = pa.array([z.compress(x.as_py()) for x in batch.column(at)], pa.binary())
            yield batch.set_column(at, "z", small)

    # One exchange of the texts by key serves both joins: they take the same columns.
    packed = rows.mapInArrow(squash, rows.schema)

    def documents(batch):
        """First row, texts, their offsets and layout of some documents at a time."""
        z, unz = batch.column(batch.schema.names.index("z")), zstandard.ZstdDecompressor()
        texts, size, first = [], 0, 0
        for i in range(batch.num_rows):
            texts.append(unz.decompress(z[i].as_py()))
            size += len(texts[-1])
            if size >= 1 << 20 or i == batch.num_rows - 1:
                at = np.cumsum([0, *map(len, texts)])
                yield first, texts, at, Layout(np.frombuffer(b"".join(texts), dtype=np.uint8), at, average)
                texts, size, first = [], 0, i + 1

    def encode_shared(batches):
        enc, last = encoder(vocabulary.value, remember), None
        for batch in batches:
            wanted, keys = batch.column(batch.schema.names.index("asked")), batch.column(batch.schema.names.index("k"))
            for i, texts, at, layout in documents(batch):
                found = {}
                for d, text in enumerate(texts):
                    if keys[i + d] == last:  # the join has rows alike next to each other
                        continue
                    last = keys[i + d]
                    ask = set(wanted[i + d].as_py())
                    for c in range(layout.first[d], layout.first[d + 1]):
                        h = int(layout.hash[c].view(np.int64))
                        if h in ask and layout.has[c]:
                            found[h] = enc.words(text[layout.head[c] - at[d]: layout.tail[c] - at[d]])
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["h", "ids"])

    tokens = packed.join(asked, "k").mapInArrow(encode_shared, "h long, ids binary").groupBy("h").agg(F.first("ids").alias("ids"))
    ready = chunks.join(tokens, "h").groupBy("k").agg(F.collect_list(F.struct("h", "ids")).alias("ready"))

    def assemble(batches):
        enc = encoder(vocabulary.value, remember)
        for batch in batches:
            names = batch.schema.names
            ready_column, row_column = batch.column(names.index("ready")), batch.column(names.index("row"))
            for i, texts, at, layout in documents(batch):
                out = []
                for d, text in enumerate(texts):
                    known = {x["h"] & 0xFFFFFFFFFFFFFFFF: x["ids"] for x in ready_column[i + d].as_py() or ()}
                    out.append(encode_document(enc, text, at[d], layout, range(layout.first[d], layout.first[d + 1]), known))
                columns = [row_column.slice(i, len(texts)), pa.array(out, pa.binary())]
                if decode_to:
                    columns.append(pa.array([enc.decoded(x) for x in out], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "ids", "text"][: len(columns)])

    if decode_to:
        check_decoder(vocabulary.value)
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), *([T.StructField("text", T.StringType())] if decode_to else [])])
    done = packed.join(ready, "k", "left").mapInArrow(assemble, schema)
    return done.select(*[F.col("row")[c].alias(c) for c in rows.schema["row"].dataType.names], "ids", *([F.col("text").alias(decode_to)] if decode_to else []))


def check_decoder(tokenizer_json: str) -> None:
    assert '"decoder":null' in tokenizer_json.replace(" ", "").replace("\n", ""), "a decoder step is not supported"


def decode_corpus(spark: SparkSession, encoded: DataFrame, tokenizer: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add ``to``: the text of the ids as the library's decode gives it, special tokens kept.

    For a tokenizer without a decoder step, as here: its tokens with a space
    between each two. Null or empty ids: the empty text.
    """
    vocabulary = spark.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())
    check_decoder(vocabulary.value)
    at = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField(to, T.StringType())])

    def decode(batches):
        enc = encoder(vocabulary.value)
        for batch in batches:
            column = batch.column(at)
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [enc.decoded(x.as_py() or b"") for x in column.slice(i, 256)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, to])

    return encoded.mapInArrow(decode, schema)
