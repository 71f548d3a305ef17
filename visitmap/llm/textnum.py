"""Numpy helpers over UTF-8 text: words, rolling hashes and content-chosen anchors.

All functions work on one in-memory piece (an Arrow batch or a block of
documents) inside a Spark task. Hashes are 64-bit polynomials mod 2**64 over
random symbol values, with a multiplicative finish; equal input always gives
the same hash, on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INV = pow(_BASE, -1, 1 << 64)

# Fixed value: the words' separators, space and the control bytes 9 to 13.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
WORD = r"[^\x20\x09-\x0D]+"

BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(np.uint64) * _U(2) + _U(1)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


KEPT_POWERS = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**j and B**-j for j in 0..n. One table is kept, the largest so far up to ``KEPT_POWERS``."""
    p, q = _powers.get(0, (np.zeros(0), np.zeros(0)))
    if len(p) <= n:
        size = 1 << max(16, int(n).bit_length())
        one = np.full(size, _BASE, dtype=np.uint64)
        inv = np.full(size, _INV, dtype=np.uint64)
        one[0] = inv[0] = 1
        p, q = np.multiply.accumulate(one), np.multiply.accumulate(inv)
        if size <= KEPT_POWERS:
            _powers[0] = p, q
    return p[: n + 1], q[: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = h ^ (h >> _U(32))
    h = h * _MULT
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def string_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    kind = np.int64 if large else np.int32
    offs = np.frombuffer(where, dtype=kind, count=n + 1, offset=column.offset * kind().itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offs - offs[0]
    body = np.frombuffer(data, dtype=np.uint8)[offs[0]: offs[-1]]
    return body, offs - offs[0]


def slices(offs: np.ndarray, size: int):
    """Consecutive row ranges of about ``size`` bytes (a longer row stands alone)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + size, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def word_bounds(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and n + 1 word offsets of the documents."""
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    letter = ~IS_SPACE[body]
    edge = offs[:-1][offs[1:] > offs[:-1]]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    first[edge] = letter[edge]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    tail = offs[1:][offs[1:] > offs[:-1]] - 1
    last[tail] = letter[tail]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False, step: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of every word's bytes; ``fold`` lower-cases A-Z first."""
    out = np.empty(len(starts), dtype=np.uint64)
    starts = np.asarray(starts)
    values = BYTE_VALUES
    if fold:
        values = values.copy()
        values[65:91] = values[97:123]
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + step, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        if b - a > 2 * step:  # one long word: its pieces' sums, each moved to its place
            whole = 0
            for at in range(a, b, step):
                part = values[body[at: min(at + step, b)]]
                whole += int((part * powers(len(part))[0][: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, at - a, 1 << 64)
            out[i] = mix(np.array([(whole + b - a) & ((1 << 64) - 1)], dtype=np.uint64))[0]
            i = j
            continue
        p, q = powers(b - a)
        total = np.empty(b - a + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(values[body[a:b]] * p[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * q[s] + (e - s).astype(np.uint64))
        i = j
    return out


def window_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` symbols (64-bit values), in order of start."""
    n = len(symbols)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    p, q = powers(n)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(symbols * p[:n], out=total[1:])
    return (total[length:] - total[:-length]) * q[: n - length + 1]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    if have < width:
        x = np.minimum(x[: len(x) - (width - have)], x[width - have:])
    return x


class Runs:
    """Anchor occurrences: arrays of equal length, in order of position.

    ``anchor`` hash of the anchor (spread: the hashes that choose it are small ones), ``lo`` and ``hi`` first and last start of the
    windows it owns, ``context`` hash of the symbols from ``lo`` to the end of the
    last window, ``left`` and ``right`` hashes of the anchor with the ``side``
    symbols before or after it (0: the context doesn't have them).
    """

    names = ("anchor", "lo", "hi", "context", "left", "right")

    def __init__(self, **arrays: np.ndarray):
        for k in self.names:
            setattr(self, k, arrays[k])

    def __len__(self) -> int:
        return len(self.lo)


def anchor_runs(symbols: np.ndarray, offs: np.ndarray, length: int, gram: int, step: int = 1 << 16) -> Runs:
    """Windows of ``length`` symbols grouped by the anchor that owns them.

    A window's anchor is its ``gram``-symbol run of smallest hash, the first on a
    tie, so equal windows have equal anchors wherever they stand. A window lies
    in one document. ``symbols`` is uint8 (bytes) or uint64; ``offs`` has the
    documents' offsets. Work goes by pieces of ``step`` starts, so memory doesn't
    depend on a document's length; an anchor at a piece's edge occurs once on
    each side.
    """
    width, found = length - gram + 1, []
    side = (length - gram + 1) // 2
    n = len(symbols)
    for at in range(0, max(0, n - length + 1), step):
        piece = symbols[at: at + step + length - 1]
        values = BYTE_VALUES[piece] if piece.dtype == np.uint8 else piece
        size = len(values)
        p, q = powers(size)
        total = np.empty(size + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(values * p[:size], out=total[1:])
        h = (total[gram:] - total[:-gram]) * q[: size - gram + 1]
        h *= _MULT
        h ^= h >> _U(31)
        h *= _MULT
        key = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        best = (sliding_min(key, width) & _U(0xFFFFFFFF)).astype(np.int64)
        m = len(best)
        # A window is valid when no document starts inside it, past its first symbol.
        inside = np.unique(offs[np.searchsorted(offs, at + 1): np.searchsorted(offs, at + m + length)]) - at
        good = np.ones(m, dtype=bool)
        if len(inside):
            mark = np.zeros(m + 1, dtype=np.int32)
            np.add.at(mark, np.clip(inside - length + 1, 0, m), 1)
            np.add.at(mark, np.clip(inside, 0, m), -1)
            good = np.cumsum(mark[:-1]) == 0
        where = np.flatnonzero(good)
        if not len(where):
            continue
        best = best[where]
        turn = np.flatnonzero(best[1:] != best[:-1]) + 1
        lo = where[np.concatenate(([0], turn))]
        hi = where[np.concatenate((turn, [len(best)])) - 1]
        pos = best[np.concatenate(([0], turn))]
        out = {"anchor": mix(h[pos]), "lo": lo + at, "hi": hi + at}
        part = lambda s, e: mix((total[e] - total[s]) * q[s] + (e - s).astype(np.uint64) * _MULT)
        out["context"] = part(lo, hi + length)
        has = pos - lo >= side
        out["left"] = np.where(has, part(np.maximum(pos - side, 0), pos + gram) | _U(1), _U(0))  # never 0 in its low bytes
        has = hi + length - pos - gram >= side
        out["right"] = np.where(has, part(pos, np.minimum(pos + gram + side, size)) | _U(1), _U(0))
        found.append(out)
    if not found:
        kinds = (np.uint64, np.int64, np.int64, np.uint64, np.uint64, np.uint64)
        return Runs(**{k: np.zeros(0, t) for k, t in zip(Runs.names, kinds)})
    return Runs(**{k: np.concatenate([x[k] for x in found]) for k in Runs.names})


def pack_ints(x: np.ndarray, keep: int | None = None) -> bytes:
    """An integer array by byte planes: equal high bytes stand together and compress.

    ``keep``: only so many bytes of each, the lowest.
    """
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return np.ascontiguousarray(planes[:keep]).tobytes()


def unpack_ints(data: bytes, kind, keep: int | None = None) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not data:
        return np.zeros(0, dtype=kind)
    planes = np.frombuffer(data, dtype=np.uint8).reshape(keep or size, -1)
    out = np.zeros((planes.shape[1], size), dtype=np.uint8)
    out[:, : keep or size] = planes.T
    return out.reshape(-1).view(kind)


def ranges(lo: np.ndarray, length: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... for length[0] values, then those of lo[1], ..."""
    length = np.asarray(length, dtype=np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(length)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(lo, dtype=np.int64) - (ends - length), length)
