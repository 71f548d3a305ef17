"""Fill-in-the-middle: documents cut into prefix, middle and suffix, and put into another order.

A batch of documents is one byte array. Every document's cuts give a few points at
which the distance from a byte's place to its place in the output changes; these
changes are added into a difference array, whose running sum is every byte's
shift, and one numpy scatter writes the batch's outputs. Restoring finds the
three marks, builds the shifts in the same way and gathers the bytes back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmap.llm.blocks import text_column
from visitmap.llm.textnum import slices, string_column

# The marks before prefix, suffix and middle. No mark's end begins
# another mark, so a mark found in an output is one that was put there.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)

PIECE = 1 << 20
CUT = "form string, n long, prefix_chars long, middle_chars long, output string"


def drawn(key: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the hash of ``seed`` and ``key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def find_all(body: np.ndarray, mark: bytes) -> np.ndarray:
    """The places where ``mark`` (three bytes) stands."""
    if len(body) < MARK:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(body[:-2] == mark[0])
    return at[(body[at + 1] == mark[1]) & (body[at + 2] == mark[2])]


def holders(body: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which documents contain a mark."""
    out = np.zeros(len(offs) - 1, dtype=bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = find_all(body, mark)
        doc = np.searchsorted(offs, at, side="right") - 1
        out[doc[at + MARK <= offs[doc + 1]]] = True
    return out


def line_ends(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The end of every line (a last one without a line feed too), and the documents' offsets in that list."""
    after = np.flatnonzero(body == 10) + 1
    stop = offs[1:][offs[1:] > offs[:-1]]
    ends = np.union1d(after, stop)
    return ends, np.searchsorted(ends, offs, side="right")


def moved(places: np.ndarray, shifts: np.ndarray, size: int, piece: int = PIECE):
    """(first byte, target of each byte) a piece at a time, for bytes that keep ``shifts[i]`` from ``places[i]`` on.

    ``places`` are in order; equal ones count with their last shift.
    """
    change = np.diff(shifts, prepend=0)
    for at in range(0, size, piece):
        stop = min(at + piece, size)
        i, j = np.searchsorted(places, [at, stop])
        step = np.zeros(stop - at, dtype=np.int64)
        step[0] = shifts[i - 1] if i else 0
        np.add.at(step, places[i:j] - at, change[i:j])
        np.cumsum(step, out=step)
        step += np.arange(at, stop)
        yield at, step


def char_counts(body: np.ndarray, points: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Code points before each of ``points`` (in order)."""
    out = np.empty(len(points), dtype=np.int64)
    before, i = 0, 0
    for at in range(0, len(body) + 1, piece):
        lead = (body[at: at + piece] & 0xC0) != 0x80
        total = np.concatenate(([0], np.cumsum(lead, dtype=np.int32)))
        j = int(np.searchsorted(points, at + len(lead), side="right"))
        out[i:j] = before + total[points[i:j] - at]
        i, before = j, before + int(total[-1])
    return out


def parts(form: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where prefix, middle and suffix begin in the output (n x 3), and the outputs' offsets.

    ``cuts`` (n x 4): begin, prefix end, middle end and end of each document.
    """
    pre, mid, suf = np.diff(cuts, axis=1).T
    size = pre + mid + suf + np.where(form == PLAIN, 0, 3 * MARK)
    offs = np.concatenate(([0], np.cumsum(size)))
    o = offs[:-1]
    prefix = np.select([form == PSM, form == SPM], [o + MARK, o + 2 * MARK + suf], o)
    middle = np.select([form == PSM, form == SPM], [prefix + pre + MARK + suf + MARK, prefix + pre + MARK], prefix + pre)
    suffix = np.select([form == PSM, form == SPM], [prefix + pre + MARK, o + MARK], middle + mid)
    return np.stack([prefix, middle, suffix], axis=1), offs


def scatter(body: np.ndarray, form: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs' bytes and offsets."""
    begin, offs = parts(form, cuts)
    out = np.empty(int(offs[-1]), dtype=np.uint8)
    places = cuts[:, :3].ravel()
    for at, target in moved(places, (begin - cuts[:, :3]).ravel(), len(body)):
        out[target] = body[at: at + len(target)]
    changed = form != PLAIN
    for k, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        for i in range(MARK):
            out[begin[changed, k] - MARK + i] = mark[i]
    return out, offs


def cut_points(body: np.ndarray, offs: np.ndarray, draw: np.ndarray, rate: int, spm: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Form, number of lines and cuts of every document."""
    ends, first = line_ends(body, offs)
    n = np.diff(first)
    form = np.where(draw[:, 3] % 100 < spm, SPM, PSM)
    form[(n == 0) | holders(body, offs) | (draw[:, 2] % 100 >= rate)] = PLAIN
    units = np.sort(draw[:, :2] % (n + 1)[:, None], axis=1)
    if not len(ends):
        ends = np.zeros(1, np.int64)
    at = np.where(units > 0, ends[np.maximum(first[:-1, None] + units - 1, 0)], offs[:-1, None])
    cuts = np.concatenate((offs[:-1, None], at, offs[1:, None]), axis=1)
    cuts[form == PLAIN, 1:3] = offs[1:, None][form == PLAIN]  # a plain text is all prefix
    return form, n, cuts


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm: int = 50,
                   carry: list[str] | None = None) -> DataFrame:
    """``carry`` (default: ``key``), ``form``, ``n`` lines, ``prefix_chars``, ``middle_chars`` and ``output`` of every document.

    Cuts fall between lines, at places drawn from the hash of ``seed`` and the id, so
    reruns agree and equal ids are cut alike. ``rate`` of a hundred documents are
    changed, ``spm`` of a hundred of those with the suffix first. Null text: empty.
    An empty text and one that holds a mark stay plain (null character counts). Null id: drawn as the empty
    id. Repeated rows: a row each. Empty table: no rows. A carried column called like a new one gives way to it. One text is held whole,
    with its output; the index arrays are a piece at a time.
    """
    new = [x.split()[0] for x in CUT.split(", ")]
    names = [c for c in ([key] if carry is None else carry) if c not in new]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).cast("string").alias("text"),
                       *[h.alias(f"h{i}") for i, h in enumerate(drawn(F.col(f"`{key}`"), seed))])
    row_type = rows.schema["row"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            body, offs = string_column(batch.column(1))
            draw = np.stack([np.asarray(batch.column(2 + i)) for i in range(4)], axis=1) if batch.num_rows else np.zeros((0, 4), np.int64)
            for i, j in slices(offs, PIECE):
                b, o = body[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
                form, n, cuts = cut_points(b, o, draw[i:j], rate, spm)
                out, where = scatter(b, form, cuts)
                chars = np.diff(char_counts(b, cuts.ravel()).reshape(-1, 4), axis=1)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.array(FORMS, dtype=object)[form], pa.string()), pa.array(n, pa.int64()),
                     pa.array(chars[:, 0], pa.int64(), mask=plain), pa.array(chars[:, 1], pa.int64(), mask=plain), text_column(out, where)],
                    names=["row", *new])

    done = rows.mapInArrow(cut, f"row {row_type}, {CUT}")
    return done.select(*[F.col("row")[c].alias(c) for c in names], *new)


def mark_places(body: np.ndarray, offs: np.ndarray, form: np.ndarray) -> np.ndarray:
    """Cuts (n x 4) of the texts that stand in ``body`` as outputs: where their three parts end."""
    size = np.diff(offs)
    changed = form != PLAIN
    first = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = find_all(body, mark)
        at = np.append(at, len(body))
        first[mark] = at[np.searchsorted(at, offs[:-1])] - offs[:-1]
    pre = np.where(form == PSM, first[SUFFIX] - MARK, np.where(form == SPM, first[MIDDLE] - first[PREFIX] - MARK, size))
    suf = np.where(form == PSM, first[MIDDLE] - first[SUFFIX] - MARK, np.where(form == SPM, first[PREFIX] - MARK, 0))
    mid = np.where(changed, size - 3 * MARK - pre - suf, 0)
    begin = np.concatenate(([0], np.cumsum(pre + mid + suf)))
    return np.stack([begin[:-1], begin[:-1] + pre, begin[:-1] + pre + mid, begin[1:]], axis=1)


def gather(body: np.ndarray, offs: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind outputs: bytes and offsets."""
    cuts = mark_places(body, offs, form)
    begin, _ = parts(form, cuts)
    size = int(cuts[-1, 3]) if len(cuts) else 0
    out = np.empty(size, dtype=np.uint8)
    for at, source in moved(cuts[:, :3].ravel(), (begin - cuts[:, :3]).ravel(), size):
        out[at: at + len(source)] = body[source]
    return out, np.append(cuts[:, 0], size)


def restore(formed: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``formed`` with ``restored``: the text rebuilt from its output and form alone. A null output is empty, a null form plain."""
    names = [c for c in formed.columns if c != "restored"]
    rows = formed.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{output}`").alias("output"), F.col(f"`{form}`").alias("form"))
    row_type = rows.schema["row"].dataType.simpleString()

    def back(batches):
        for batch in batches:
            body, offs = string_column(batch.column(1))
            kinds = np.array([FORMS.index(f or "plain") for f in batch.column(2).to_pylist()], dtype=np.int64)
            for i, j in slices(offs, PIECE):
                out, where = gather(body[offs[i]: offs[j]], offs[i: j + 1] - offs[i], kinds[i:j])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), text_column(out, where)], names=["row", "restored"])

    done = rows.mapInArrow(back, f"row {row_type}, restored string")
    return done.select(*[F.col("row")[c].alias(c) for c in names], "restored")


ORACLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS unit,
         sha256('7:' || doc_id) AS h FROM documents
), drawn AS (
  SELECT *, len(unit)::BIGINT AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut
), parts AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                 WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(unit[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS pre,
         array_to_string(unit[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS mid,
         array_to_string(unit[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suf FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""
