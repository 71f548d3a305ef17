"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are runs of letters (characters beyond ASCII count as letters). What is labelled is documents, so the tokens' labels come
from them: word forms and word beginnings that labelled toxic documents have far more often than
clean ones mark tokens in toxic documents as toxic; all other tokens, and every
token of a clean document, are clean. A field with two states is trained on that,
in numpy, on a bounded sample of stretches. Forward-backward over a whole text gives each
token's marginal. A document's number of toxic tokens, their share and the
highest marginal go into a logistic score; tokens above a half are the
offending spans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.fill_middle import char_counts
from visitmap.llm.sampling import smallest_hashes
from visitmap.llm.scratch import scratch_path
from visitmap.llm.textnum import _U, mix, slices, string_column, word_bounds, word_hashes

BITS = 16
SIZE = 1 << BITS
#: Bytes of a word's beginnings and end that are features.
STARTS, END = (4, 5, 6, 7), 4
FIELDS = 1 + len(STARTS) + 4  # word, beginnings, end, length, the words before and after
STRETCH = 32
PIECE = 1 << 20
COLUMNS = 128

FOLD = np.full(256, 0x20, dtype=np.uint8)  # what isn't a letter parts the tokens
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = FOLD[97:123]
FOLD[128:] = np.arange(128, 256)


@dataclass
class Tokens:
    """A batch's tokens: bytes, document offsets, and hashes of a token's features."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    forms: np.ndarray  # (1 + STARTS) x tokens: the word, its beginnings (0: it is no longer than that)
    body: np.ndarray

    @classmethod
    def of(cls, body: np.ndarray, offs: np.ndarray) -> "Tokens":
        low = FOLD[body]
        starts, ends, first = word_bounds(low, offs)
        forms = np.zeros((1 + len(STARTS), len(starts)), dtype=np.uint64)
        if len(starts):
            forms[0] = word_hashes(low, starts, ends)
            for i, k in enumerate(STARTS):
                long = ends - starts > k
                forms[1 + i][long] = mix(word_hashes(low, starts[long], starts[long] + k) + _U(k))
        return cls(starts, ends, first, forms, low)

    def features(self) -> np.ndarray:
        """tokens x FIELDS places in the table of weights; ``SIZE`` where a token hasn't the feature."""
        n = len(self.starts)
        out = np.full((n, FIELDS), SIZE, dtype=np.int32)
        place = lambda h, k: (mix(h + _U(k)) >> _U(64 - BITS)).astype(np.int32)
        if not n:
            return out
        for k, h in enumerate(self.forms):
            out[:, k] = np.where(h > 0, place(h, k), SIZE)
        k = len(self.forms)
        size = self.ends - self.starts
        tail = size > END
        out[tail, k] = place(word_hashes(self.body, self.ends[tail] - END, self.ends[tail]), k)
        out[:, k + 1] = place(np.minimum(size, 15).astype(np.uint64), k + 1)
        inner = np.ones(n, dtype=bool)
        inner[self.first[:-1][self.first[:-1] < n]] = False  # a document's first token has none before it
        after = np.flatnonzero(inner)
        out[after, k + 2] = place(self.forms[0][after - 1], k + 2)
        out[after - 1, k + 3] = place(self.forms[0][after], k + 3)
        return out


class Field:
    """Two states, clean and toxic: weights of features for toxic, transitions, and a start."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.weights, self.move, self.start = weights, move, start  # weights has SIZE + 1 entries, the last 0

    @classmethod
    def untrained(cls) -> "Field":
        return cls(np.zeros(SIZE + 1), np.zeros((2, 2)), np.zeros(2))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        """Log odds of toxic from a token's features alone."""
        return self.weights[features].sum(axis=1)


def normal(x: np.ndarray, axis: int = -1) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def chain_marginals(field: Field, log_odds: np.ndarray, resets: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None,
                    columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginal of toxic for each token, the forward message behind the last and the backward message before the first.

    ``resets`` marks tokens that begin a document. ``before`` and ``after``: messages that come
    in at the ends, when a document goes on there. The tokens stand in rows of ``columns``: first
    every row's product of matrices is formed, column by column over all rows at once, then the rows are
    chained, and then all rows are run through again from their right messages.
    """
    n = len(log_odds)
    after = np.ones(2) / 2 if after is None else after
    before = np.ones(2) / 2 if before is None else before
    if not n:
        return np.zeros(0), before, after
    rows = -(-n // columns)
    odds = np.exp(np.clip(log_odds, -30, 30))
    pad = rows * columns - n
    move, start = np.exp(field.move), np.exp(field.start)
    # A step's matrix: transitions (at a reset: the start, whatever came before) times the token's weights.
    e = np.concatenate((odds, np.ones(pad))).reshape(rows, columns).T
    fresh = np.concatenate((resets, np.zeros(pad, dtype=bool))).reshape(rows, columns).T
    def step(c, x0, x1):
        """Two columns of message or product times a step's matrix."""
        y0, y1 = x0 * move[0, 0] + x1 * move[1, 0], x0 * move[0, 1] + x1 * move[1, 1]
        if some_fresh[c]:
            all_in = x0 + x1
            y0, y1 = np.where(fresh[c], all_in * start[0], y0), np.where(fresh[c], all_in * start[1], y1)
        y1 = y1 * e[c]
        if c >= columns - pad:  # only the last row is not full
            y0[..., -1], y1[..., -1] = x0[..., -1], x1[..., -1]
        return y0, y1

    some_fresh = fresh.any(axis=1)
    # Each row's product: what the row makes of either state.
    p0, p1 = np.repeat([[1.0], [0.0]], rows, axis=1), np.repeat([[0.0], [1.0]], rows, axis=1)
    for c in range(columns):
        p0, p1 = step(c, p0, p1)
        top = np.maximum(p0, p1).max(axis=0)
        p0, p1 = p0 / top, p1 / top
    into, out_of = np.empty((2, rows)), np.empty((2, rows))
    product = np.stack([p0, p1], axis=2).transpose(1, 0, 2)  # rows x from x to
    state = before
    for r in range(rows):
        into[:, r] = state
        state = normal(state @ product[r])
    last = state
    state = after
    for r in range(rows - 1, -1, -1):
        out_of[:, r] = state
        state = normal(product[r] @ state)
    first = state
    forward = np.empty((columns, 2, rows))
    x0, x1 = into
    for c in range(columns):
        x0, x1 = step(c, x0, x1)
        total = x0 + x1
        x0, x1 = x0 / total, x1 / total
        forward[c, 0], forward[c, 1] = x0, x1
    toxic = np.empty((columns, rows))
    b0, b1 = out_of
    for c in range(columns - 1, -1, -1):
        x0, x1 = forward[c, 0] * b0, forward[c, 1] * b1
        toxic[c] = x1 / (x0 + x1)
        y0, y1 = move[0, 0] * b0 + move[0, 1] * e[c] * b1, move[1, 0] * b0 + move[1, 1] * e[c] * b1
        if some_fresh[c]:
            alike = start[0] * b0 + start[1] * e[c] * b1
            y0, y1 = np.where(fresh[c], alike, y0), np.where(fresh[c], alike, y1)
        if c >= columns - pad:
            y0[-1], y1[-1] = b0[-1], b1[-1]
        total = y0 + y1
        b0, b1 = y0 / total, y1 / total
    return toxic.T.reshape(-1)[:n], last, first


def log_likelihood(field: Field, features: np.ndarray, labels: np.ndarray, lengths: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean log likelihood of labelled stretches, and its gradient.

    ``features`` is FIELDS x width x stretches, ``labels`` width x stretches. The gradient is given as the
    tokens' label less marginal, and for transitions and start.
    """
    width, s = labels.shape
    odds = np.zeros((width, s))
    for one in features:
        odds += field.weights[one]
    inside = np.arange(width)[:, None] < lengths[None]
    e = np.exp(np.where(inside, np.clip(odds, -30, 30), 0.0))
    move, start = np.exp(field.move), np.exp(field.start)
    # Messages (clean, toxic) scaled to a sum of one; the scales give the likelihood.
    clean, toxic, scale = np.empty((width, s)), np.empty((width, s)), np.ones((width, s))
    for t in range(width):
        if t:
            c, x = clean[t - 1], toxic[t - 1]
            c, x = c * move[0, 0] + x * move[1, 0], (c * move[0, 1] + x * move[1, 1]) * e[t]
            on = inside[t]
            c, x = np.where(on, c, clean[t - 1]), np.where(on, x, toxic[t - 1])
        else:
            c, x = np.full(s, start[0]), start[1] * e[0]
        scale[t] = c + x
        clean[t], toxic[t] = c / scale[t], x / scale[t]
    true = labels.astype(np.int64)
    found = field.start[true[0]] + np.where(inside & (true == 1), np.clip(odds, -30, 30), 0.0).sum(axis=0)
    pair_on = inside[1:]
    found = found + np.where(pair_on, field.move[true[:-1], true[1:]], 0.0).sum(axis=0)
    moves = np.zeros((2, 2))
    np.add.at(moves, (true[:-1][pair_on], true[1:][pair_on]), 1)
    marginal = np.empty((width, s))
    bc, bx = np.ones(s), np.ones(s)
    for t in range(width - 1, -1, -1):
        c, x = clean[t] * bc, toxic[t] * bx
        marginal[t] = x / (c + x)
        if t:
            on = inside[t]
            vc, vx = bc, bx * e[t]
            each = on / scale[t]
            for i, a in enumerate((clean[t - 1], toxic[t - 1])):
                moves[i] -= move[i] * np.array([(a * vc * each).sum(), (a * vx * each).sum()])
            nc, nx = move[0, 0] * vc + move[0, 1] * vx, move[1, 0] * vc + move[1, 1] * vx
            bc, bx = np.where(on, nc / scale[t], bc), np.where(on, nx / scale[t], bx)
    error = np.where(inside, labels - marginal, 0.0)
    first = np.bincount(true[0], minlength=2) - np.array([(1 - marginal[0]).sum(), marginal[0].sum()])
    return float((found - np.log(scale).sum(axis=0)).mean()), error / s, moves / s, first / s


def train(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, steps: int = 60, rate: float = 0.4, decay: float = 1e-4) -> Field:
    """The field by gradient ascent with a step size of its own for each weight. Stretches come first in the arrays."""
    field = Field.untrained()
    if not len(labels):
        return field
    # Only the weights of features that occur are worked on.
    used, place = np.unique(features, return_inverse=True)
    place = np.ascontiguousarray(place.reshape(features.shape).transpose(2, 1, 0)).astype(np.int32)
    part = Field(np.zeros(len(used)), field.move, field.start)
    labels = np.ascontiguousarray(labels.T)
    squares = [np.full(len(used), 1e-12), np.full((2, 2), 1e-12), np.full(2, 1e-12)]
    for _ in range(steps):
        _, error, moves, start = log_likelihood(part, place, labels, lengths)
        weight = sum(np.bincount(one.ravel(), weights=error.ravel(), minlength=len(used)) for one in place)
        weight[used == SIZE] = 0
        for x, g, q in zip((part.weights, part.move, part.start), (weight, moves, start), squares):
            g = g - decay * x
            q += g * g
            x += rate * g / np.sqrt(q)
    field.weights[used] = part.weights
    field.weights[SIZE] = 0
    return field


def token_lexicon(counts: list, toxic_docs: int, clean_docs: int, least: float, ratio: float) -> np.ndarray:
    """Hashes of forms whose share of toxic documents is ``ratio`` times that of clean ones, with a likelihood ratio of ``least``."""
    out = []
    for r in counts:
        a, b = r["toxic"], r["clean"]
        if association(a, b, toxic_docs, clean_docs) >= least and a * clean_docs >= ratio * b * toxic_docs:
            out.append(r["form"])
    return np.sort(np.array(out, dtype=np.int64).view(np.uint64))


def association(a: int, b: int, of_a: int, of_b: int) -> float:
    """Likelihood ratio statistic of a form in ``a`` of ``of_a`` and ``b`` of ``of_b`` documents."""
    if not of_a or not of_b:
        return 0.0
    part = lambda x, n, m: x * math.log(x * (of_a + of_b) / (n * m)) if x else 0.0
    has, lacks = a + b, of_a + of_b - a - b
    return 2 * (part(a, has, of_a) + part(b, has, of_b) + part(of_a - a, lacks, of_a) + part(of_b - b, lacks, of_b))


def known(forms: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """Which tokens have one of the lexicon's forms."""
    if not len(lexicon):
        return np.zeros(forms.shape[1], dtype=bool)
    at = np.minimum(np.searchsorted(lexicon, forms), len(lexicon) - 1)
    return ((lexicon[at] == forms) & (forms > 0)).any(axis=0)


def sums(tokens: np.ndarray, toxic: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row a document: tokens, expected toxic tokens, highest marginal."""
    out = np.zeros((len(first) - 1, 3))
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[:, 0] = np.diff(first)
        out[full, 1] = np.add.reduceat(toxic, first[full])
        out[full, 2] = np.maximum.reduceat(toxic, first[full])
    return out


def measures(rows: np.ndarray) -> np.ndarray:
    """What the document score is fitted on, from ``sums``."""
    n, expected, top = rows.T
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(len(rows)), np.log(expected + 0.01), np.log((expected + 0.01) / (n + 10)), np.log(top / (1 - top)) / 4,
                     np.log1p(n)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 0.05, steps: int = 30) -> np.ndarray:
    """Weights by Newton's method; one class alone gives its (bounded) share whatever x is."""
    w = np.zeros(x.shape[1])
    if not len(y) or len(set(y.tolist())) < 2:
        share = min(max(y.mean(), 0.01), 0.99) if len(y) else 0.0
        w[0] = math.log(share / (1 - share)) if share else -math.log(99)
        return w
    keep = decay * np.ones(len(w))
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
    return w


def pieces(body: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """A long text's pieces: each ends behind a byte that isn't of a letter, or else between characters."""
    out, at = [], 0
    while at < len(body):
        stop = min(at + piece, len(body))
        if stop < len(body):
            gap = np.flatnonzero(FOLD[body[at + piece // 2: stop]] == 0x20)
            if len(gap):
                stop = at + piece // 2 + int(gap[-1]) + 1
            else:
                while (body[stop] & 0xC0) == 0x80:
                    stop += 1
        out.append((at, stop))
        at = stop
    return out


def spans_of(starts: np.ndarray, ends: np.ndarray, toxic: np.ndarray, begins: np.ndarray, least: float = 0.5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of toxic tokens: place of the first token, byte start and end, highest marginal."""
    on = toxic > least
    opens = on.copy()
    opens[1:] &= ~on[:-1] | begins[1:]
    at = np.flatnonzero(opens)
    if not len(at):
        return at, at, at, np.zeros(0)
    closes = on.copy()
    closes[:-1] &= ~on[1:] | begins[1:]
    stop = np.flatnonzero(closes)
    return at, starts[at], ends[stop], np.maximum.reduceat(np.where(on, toxic, 0), at)


def tag(field: Field, body: np.ndarray, offs: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, list]:
    """``sums`` of every document, and (document, start, end, marginal) of its toxic spans in code points.

    A text above ``piece`` goes through in pieces: forwards once for the messages at their
    edges, then backwards for the marginals, as exact as in one go over the same tokens. A span ends at a piece's edge.
    """
    total, spans = np.zeros((len(offs) - 1, 3)), []
    for i, j in slices(offs, piece):
        b, o = body[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        if len(b) <= piece:
            t = Tokens.of(b, o)
            begins = np.zeros(len(t.starts), dtype=bool)
            begins[t.first[:-1][t.first[:-1] < len(begins)]] = True
            toxic, _, _ = chain_marginals(field, field.emissions(t.features()), begins)
            total[i:j] = sums(t.starts, toxic, t.first)
            at, s, e, top = spans_of(t.starts, t.ends, toxic, begins)
            if len(at):
                doc = np.searchsorted(t.first, at, side="right") - 1
                count = char_counts(b, np.sort(np.concatenate((o[doc], s, e))))
                place = dict(zip(np.sort(np.concatenate((o[doc], s, e))).tolist(), count.tolist()))
                spans += [(i + int(d), place[int(x)] - place[int(o[d])], place[int(y)] - place[int(o[d])], float(p)) for d, x, y, p in zip(doc, s, e, top)]
            continue
        parts = pieces(b, piece)
        into, state = [], None
        for x, y in parts:
            into.append(state)
            t = Tokens.of(b[x:y], np.array([0, y - x]))
            begins = np.zeros(len(t.starts), dtype=bool)
            if state is None and len(begins):
                begins[0] = True
            if len(begins):
                _, state, _ = chain_marginals(field, field.emissions(t.features()), begins, state)
        chars = np.concatenate(([0], np.cumsum([int(((b[x:y] & 0xC0) != 0x80).sum()) for x, y in parts])))
        later, found = None, []
        for k in range(len(parts) - 1, -1, -1):
            x, y = parts[k]
            t = Tokens.of(b[x:y], np.array([0, y - x]))
            if not len(t.starts):
                continue
            begins = np.zeros(len(t.starts), dtype=bool)
            begins[0] = into[k] is None
            toxic, _, later = chain_marginals(field, field.emissions(t.features()), begins, into[k], later)
            one = sums(t.starts, toxic, t.first)[0]
            total[i] += [one[0], one[1], 0]
            total[i, 2] = max(total[i, 2], one[2])
            at, s, e, top = spans_of(t.starts, t.ends, toxic, begins)
            if len(at):
                edges = np.sort(np.concatenate((s, e)))
                place = dict(zip(edges.tolist(), char_counts(b[x:y], edges).tolist()))
                found.append([(i, int(chars[k]) + place[int(u)], int(chars[k]) + place[int(v)], float(p)) for u, v, p in zip(s, e, top)])
        spans += [z for part in reversed(found) for z in part]
    return total, spans


class ToxicSpans:
    """The field and the document score, fitted; ``score`` applies them.

    ``labels`` has ``key`` and ``label`` (0 or 1; others are left out, and keys whose labels
    disagree). ``learn`` (a condition on a column ``key``) says which keys may be learned from; by default all.
    Learned from are at most ``sample`` labelled rows, those with the smallest hash of their key, and of these at
    most ``stretches`` stretches of 32 tokens of each of four kinds. Ids,
    languages and sources are no features.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                 learn: Column | None = None, sample: int = 20_000, stretches: int = 3_000, lexicon: int = 4_096, least: float = 18.0, ratio: float = 4.0):
        self.spark, self.key, self.text = spark, key, text
        marks = labels.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{label}`").cast("int").alias("y")).where("key is not null and y in (0, 1)")
        marks = marks.groupBy("key").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
        if learn is not None:
            marks = marks.where(learn)
        chosen = smallest_hashes(marks.select("key", "y", F.xxhash64("key").alias("h")), "h", sample).select("key", "y")
        rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        # At most ``sample`` keys: bounded, so they go to the texts and not the texts to them.
        # They are dealt anew, as a large scan would leave a file a task.
        found = rows.join(F.broadcast(chosen), "key").repartition(32, "key", "text")
        self.rows = self._write(found, "toxic-sample")
        sizes = {r["y"]: r["n"] for r in self.rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
        self.lexicon = self._lexicon(sizes.get(1, 0), sizes.get(0, 0), lexicon, least, ratio)
        self.field = self._field(stretches)
        fitted = self._sums(self.rows, ["y"], "text").select("y", "sums").collect()
        x = np.array([r["sums"] for r in fitted]).reshape(-1, 3)
        self.weights = logistic(measures(x), np.array([r["y"] for r in fitted], dtype=np.float64))

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _lexicon(self, toxic: int, clean: int, most: int, least: float, ratio: float) -> np.ndarray:
        """Forms by the number of sampled documents that have them: counted by Spark, at most ``most`` to the driver."""
        def forms(batches):
            for batch in batches:
                body, offs = string_column(batch.column(0))
                y = np.asarray(batch.column(1))
                for i, j in slices(offs, PIECE):
                    found, marks = [], []
                    for d in range(i, j):
                        b = body[offs[d]: offs[d + 1]]
                        own = [np.unique(Tokens.of(b[s:e], np.array([0, e - s])).forms) for s, e in pieces(b, PIECE)]
                        own = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
                        found.append(own[own > 0])
                        marks.append(np.full(len(found[-1]), y[d]))
                    form, at = np.unique(np.concatenate(found), return_inverse=True)
                    mark = np.concatenate(marks)
                    yield pa.RecordBatch.from_arrays([pa.array(form.view(np.int64)), pa.array(np.bincount(at, mark == 1, len(form)).astype(np.int64)),
                                                      pa.array(np.bincount(at, mark == 0, len(form)).astype(np.int64))], names=["form", "toxic", "clean"])

        counts = self.rows.select("text", "y").mapInArrow(forms, "form long, toxic long, clean long")
        counts = counts.groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") * clean > F.col("clean") * toxic)
        few = counts.orderBy(F.desc(F.col("toxic") * clean - F.col("clean") * toxic), "form").limit(most).collect()
        return token_lexicon(few, toxic, clean, least, ratio)

    def _field(self, most: int) -> Field:
        """Trained on stretches: with toxic tokens, of clean texts with the same forms, and other ones of both kinds of text."""
        lexicon = self.lexicon

        def stretches(batches):
            for batch in batches:
                body, offs = string_column(batch.column(0))
                y = np.asarray(batch.column(1))
                out = {"kind": [], "h": [], "features": [], "labels": []}
                for d in range(batch.num_rows):
                    b = body[offs[d]: offs[d + 1]]
                    for s, e in pieces(b, PIECE):
                        t = Tokens.of(b[s:e], np.array([0, e - s]))
                        n = len(t.starts)
                        if not n:
                            continue
                        x, seen = t.features(), known(t.forms, lexicon)
                        begin = np.arange(0, n, STRETCH)
                        has = np.logical_or.reduceat(seen, begin)
                        h = mix(np.add.reduceat(t.forms[0], begin))
                        # Of stretches without such forms the four smallest hashes of a piece will do.
                        take = has.copy()
                        take[np.argsort(h)[:4]] = True
                        for k in np.flatnonzero(take):
                            part = slice(begin[k], begin[k] + STRETCH)
                            out["kind"].append(2 * int(y[d]) + int(has[k]))
                            out["h"].append(int(h[k] >> _U(1)))
                            out["features"].append(x[part].tobytes())
                            out["labels"].append((seen[part] & (y[d] == 1)).astype(np.uint8).tobytes())
                        if len(out["h"]) >= 4096:
                            yield pa.RecordBatch.from_pydict(out, schema=shape)
                            out = {k: [] for k in out}
                yield pa.RecordBatch.from_pydict(out, schema=shape)

        shape = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("features", pa.binary()), ("labels", pa.binary())])
        # Copies of a stretch count once.
        found = self.rows.select("text", "y").mapInArrow(stretches, "kind int, h long, features binary, labels binary").dropDuplicates(["kind", "h"])
        found = self._write(found, "toxic-stretches")
        rows = [r for kind in range(4) for r in smallest_hashes(found.where(F.col("kind") == kind), "h", most).collect()]
        x = np.full((len(rows), STRETCH, FIELDS), SIZE, dtype=np.int32)
        y, size = np.zeros((len(rows), STRETCH)), np.zeros(len(rows), dtype=np.int64)
        for i, r in enumerate(rows):
            one = np.frombuffer(r["labels"], np.uint8)
            size[i] = len(one)
            y[i, : len(one)] = one
            x[i, : len(one)] = np.frombuffer(r["features"], np.int32).reshape(len(one), FIELDS)
        return train(x, y, size)

    def _sums(self, docs: DataFrame, carry: list[str], text: str) -> DataFrame:
        """``carry``, ``sums`` and ``spans`` of every document."""
        field = self.spark.sparkContext.broadcast(self.field)
        kept = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
        kind = kept.schema["row"].dataType.simpleString()

        def apply(batches):
            for batch in batches:
                body, offs = string_column(batch.column(1))
                for i, j in slices(offs, PIECE):
                    total, spans = tag(field.value, body[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                    doc = np.array([s[0] for s in spans], dtype=np.int64)
                    order = np.argsort(doc, kind="stable")
                    column = lambda k, t: pa.array([spans[x][k] for x in order], t)  # noqa: E731,B023
                    value = pa.StructArray.from_arrays([column(1, pa.int64()), column(2, pa.int64()), column(3, pa.float64())], names=["start", "end", "p"])
                    where = pa.array(np.searchsorted(doc[order], np.arange(j - i + 1)), pa.int32())
                    three = pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * (j - i) + 1, 3), pa.int32()), pa.array(total.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), three, pa.ListArray.from_arrays(where, value)], names=["row", "sums", "spans"])

        done = kept.mapInArrow(apply, f"row {kind}, sums array<double>, spans array<struct<start:bigint,end:bigint,p:double>>")
        return done.select(*[F.col("row")[c].alias(c) for c in carry if c not in ("sums", "spans")], "sums", "spans")

    def score(self, docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
        """``carry`` (default: the key), ``score`` (0 to 1) and ``spans`` (start, end in code points, highest marginal) of every document.

        Null or empty text: no tokens, scored like another. Repeated rows: a row each.
        Empty table: no rows. Carried columns called score, spans or sums give way.
        """
        names = [c for c in ([self.key] if carry is None else carry) if c not in ("score", "spans", "sums")]
        found = self._sums(docs, names, self.text)
        n, expected, top = F.col("sums")[0], F.col("sums")[1], F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("sums")[2]))
        terms = [F.lit(1.0), F.log(expected + 0.01), F.log((expected + 0.01) / (n + 10)), F.log(top / (1 - top)) / 4, F.log1p(n)]
        logit = sum((F.lit(float(w)) * t for w, t in zip(self.weights, terms)), F.lit(0.0))
        return found.select(*[F.col(f"`{c}`") for c in names], (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))).alias("score"), "spans")


def held_out(key: Column) -> Column:
    """Keys that aren't learned from: crc32 of the key as text leaves 1 when divided by 3. A null key is none of them."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))
