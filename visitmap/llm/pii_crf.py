"""Personal data by base patterns and a semi-Markov conditional random field.

The base patterns find e-mail addresses, IP numbers, card numbers and phone
numbers as written; their spans always stay. The field adds what the patterns
miss (a phone number without its plus, "name (at) host dot com"). It scores
whole candidate segments of up to ``MOST_TOKENS`` tokens by features of the
segment (digit counts and groups, separators, checksum, edges), and dynamic
programming chooses boundaries and kinds together. Candidates exist only
near a digit or an at sign (or its spelling), so the rest of a text, where all is outside, needs
no programming: the best labelling of the whole text is that of its regions.
The weights are learned here, by maximum likelihood, from a bounded sample of the
corpus labelled by the base patterns, together with altered copies.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.llm.sampling import smallest_hashes

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 24
REGION_CHARS = 48
SPAN = "struct<kind:string,start:int,end:int,base:boolean>"

# ---- base patterns ----------------------------------------------------------

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MAY_HOLD = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = x * 2 - 9 * (x > 4)
        total += x
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Leftmost matches, from the at signs outwards: linear however long the words are."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base patterns' spans, by kind as listed and then start."""
    if not _MAY_HOLD.search(text):
        return []
    found = [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = digits_of(m.group()) if m.end() - m.start() < 64 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


# ---- tokens, regions, candidates ----------------------------------------------

_TOKEN = re.compile(r"[0-9]{1,32}|[^\W\d_]{1,64}|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9@]|\b[aA][tT]\b")
_SPACE = re.compile(r"\s")
# Token classes: letters, digits, space, then single signs, then the rest.
SIGNS = ".@+-()_%"
LETTER, DIGIT, SPACE, REST = 0, 1, 2, 3 + len(SIGNS)
CLASSES = REST + 1


def regions(text: str) -> list[tuple[int, int]]:
    """Parts of the text near a trigger, widened to white space."""
    out: list[list[int]] = []
    at = 0

    def close() -> int:
        """The last region's end, at white space or the text's end."""
        if out and out[-1][1] < len(text) and not text[out[-1][1]].isspace():
            m = _SPACE.search(text, out[-1][1])
            out[-1][1] = m.start() if m else len(text)
        return out[-1][1] if out else 0

    while m := _TRIGGER.search(text, at):
        lo, hi = max(0, m.start() - REGION_CHARS), min(len(text), m.end() + REGION_CHARS)
        if out and (lo <= out[-1][1] or lo <= close()):
            out[-1][1] = max(out[-1][1], hi)
        else:
            least = close()
            while lo > least and not text[lo - 1].isspace():
                lo -= 1
            out.append([lo, hi])
        at = m.end()
    close()
    return [(a, b) for a, b in out]


def tokenize(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, lo, hi)]


def token_classes(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    out = np.empty(len(tokens), dtype=np.int64)
    for i, (s, e) in enumerate(tokens):
        c = text[s]
        out[i] = DIGIT if "0" <= c <= "9" else LETTER if c.isalpha() else SPACE if c.isspace() else 3 + SIGNS.index(c) if c in SIGNS else REST
    return out


def one_of(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """One column a range of values: below edges[0], ... , from the last edge on."""
    return np.eye(len(edges) + 1, dtype=np.float32)[np.searchsorted(edges, x, side="right")]


def candidates(text: str, tokens: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First token, token after the last, and features of every candidate segment."""
    n = len(tokens)
    kind = token_classes(text, tokens)
    size = np.array([e - s for s, e in tokens], dtype=np.int64)
    prefix = lambda x: np.concatenate(([0], np.cumsum(x)))
    is_digit = kind == DIGIT
    digits, groups = prefix(size * is_digit), prefix(is_digit)
    large = prefix([k == DIGIT and (e - s > 3 or int(text[s:e]) > 255) for k, (s, e) in zip(kind, tokens)])
    count = {c: prefix(kind == c) for c in range(CLASSES)}
    spelled = prefix([k == LETTER and text[s:e].lower() in ("at", "dot") for k, (s, e) in zip(kind, tokens)])
    at_word = prefix([k == LETTER and text[s:e].lower() == "at" for k, (s, e) in zip(kind, tokens)])
    first = np.repeat(np.arange(n), MOST_TOKENS)
    after = first + np.tile(np.arange(1, MOST_TOKENS + 1), n)
    first, after = first[after <= n], after[after <= n]
    of = lambda p: p[after] - p[first]
    mail = (of(count[3 + SIGNS.index("@")]) + of(at_word) > 0) & (of(count[LETTER]) > 1)
    number = (of(digits) >= 4) & (of(digits) <= 24)
    good = (mail | number) & (kind[first] != SPACE) & (kind[after - 1] != SPACE)
    first, after = first[good], after[good]
    parts = [np.ones((len(first), 1), dtype=np.float32), one_of(of(digits), [1, 4, 7, 8, 10, 11, 12, 13, 16, 17, 20]), one_of(of(groups), [1, 2, 3, 4, 5, 6])]
    parts += [one_of(of(count[c]), [1, 2, 3, 4]) for c in (LETTER, SPACE, *(3 + i for i in range(len(SIGNS))))]
    parts += [one_of(of(count[REST]), [1, 3]), one_of(of(large), [1]), one_of(of(spelled), [1, 2])]
    edge = np.concatenate((kind, [CLASSES]))  # the region's edge is a class of its own
    for at in (first, after - 1, np.where(first > 0, first - 1, n), np.minimum(after, n)):
        parts.append(np.eye(CLASSES + 1, dtype=np.float32)[edge[at]])
    check = np.zeros((len(first), 2), dtype=np.float32)
    plain = (of(digits) >= 13) & (of(digits) <= 19) & (of(count[LETTER]) == 0)
    for i in np.flatnonzero(plain):
        check[i, int(luhn(digits_of(text[tokens[first[i]][0]: tokens[after[i] - 1][1]])))] = 1
    four = (of(groups) == 4) & (of(count[3]) == 3) & (after - first == 7) & (of(large) == 0)
    return first, after, np.concatenate([*parts, check, four[:, None].astype(np.float32)], axis=1)


N_FEATURES = candidates("a 1", [(0, 1), (1, 2), (2, 3)])[2].shape[1]


def best_segments(n: int, first: np.ndarray, after: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, int, float]]:
    """The best non-overlapping segments (first, after, kind, score); outside tokens score 0."""
    keep = scores.max(axis=1) > 0  # others never improve a labelling
    first, after, scores = first[keep], after[keep], scores[keep]
    order = np.argsort(after, kind="stable")
    best, back = np.zeros(n + 1), np.full(n + 1, -1)
    kind, score = scores.argmax(axis=1), scores.max(axis=1)
    at = 0
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        while at < len(order) and after[order[at]] == j:
            i = order[at]
            if best[first[i]] + score[i] > best[j]:
                best[j], back[j] = best[first[i]] + score[i], i
            at += 1
    out, j = [], n
    while j > 0:
        i = back[j]
        if i < 0:
            j -= 1
        else:
            out.append((int(first[i]), int(after[i]), int(kind[i]), float(score[i])))
            j = int(first[i])
    return out[::-1]


# ---- learning -----------------------------------------------------------------

def log_likelihood(regions_: list[tuple], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over labelled regions, and its gradient, by forward and backward sums over segments."""
    total, grad = 0.0, np.zeros_like(weights)
    for n, first, after, feats, gold in regions_:
        scores = feats @ weights
        alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
        by_end = np.argsort(after, kind="stable")
        cut = np.searchsorted(after[by_end], np.arange(n + 2))
        for j in range(1, n + 1):
            c = by_end[cut[j]: cut[j + 1]]
            alpha[j] = np.logaddexp(alpha[j - 1], np.logaddexp.reduce((alpha[first[c]][:, None] + scores[c]).ravel())) if len(c) else alpha[j - 1]
        by_start = np.argsort(first, kind="stable")
        cut = np.searchsorted(first[by_start], np.arange(n + 2))
        for i in range(n - 1, -1, -1):
            c = by_start[cut[i]: cut[i + 1]]
            beta[i] = np.logaddexp(beta[i + 1], np.logaddexp.reduce((beta[after[c]][:, None] + scores[c]).ravel())) if len(c) else beta[i + 1]
        p = np.exp(alpha[first][:, None] + scores + beta[after][:, None] - alpha[n])
        grad -= feats.T @ p
        for i, k in gold:
            total += scores[i, k]
            grad[:, k] += feats[i]
        total -= alpha[n]
    return total, grad


def fit(regions_: list[tuple], steps: int = 400, some: int = 48, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Weights by adaptive gradient steps, each over ``some`` regions, from a start that prefers outside."""
    weights = np.zeros((N_FEATURES, len(KINDS)))
    weights[0] = -2.0
    square = np.full_like(weights, 1e-4)
    rng = np.random.default_rng(11)
    for _ in range(steps if regions_ else 0):
        part = [regions_[i] for i in rng.integers(0, len(regions_), some)]
        _, grad = log_likelihood(part, weights)
        grad = grad / some - decay * weights
        square += grad * grad
        weights += rate * grad / np.sqrt(square)
    return weights


def labelled_regions(text: str, spans: list[tuple[str, int, int]], most: int = 160) -> list[tuple]:
    """Regions with candidates and the candidates that are spans; of overlapping spans the longest counts."""
    chosen: list[tuple[str, int, int]] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1] - x[2], x[1])):
        if all(e <= a or s >= b for _, a, b in chosen):
            chosen.append((k, s, e))
    out = []
    for lo, hi in regions(text):
        tokens = tokenize(text, lo, hi)
        if not 0 < len(tokens) <= most:
            continue
        first, after, feats = candidates(text, tokens)
        place = {(tokens[i][0], tokens[j - 1][1]): c for c, (i, j) in enumerate(zip(first, after))}
        inside = [(k, s, e) for k, s, e in chosen if s < hi and e > lo]
        if len(first) and all((s, e) in place for _, s, e in inside):
            out.append((len(tokens), first, after, feats, [(place[s, e], KINDS.index(k)) for k, s, e in inside]))
    return out


def made_up(count: int, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Sentences with one entity each, plain or altered so that the base patterns miss it, and some with plain numbers."""
    rng = random.Random(seed)
    word = lambda a=2, b=9: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(a, b)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        d = number(15)
        return d + next(x for x in "0123456789" if luhn(d + x))

    def entity(kind, altered):
        if kind == "email":
            at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("(at)", ".")]) if altered else ("@", ".")
            return word() + rng.choice(["", "." + number(2)] if not altered else [""]) + at + word(3) + rng.choice(["", number(1)]) + dot + rng.choice(["com", "org", "net"])
        if kind == "ip":
            return ".".join(str(rng.randint(1, 255)) for _ in range(4))
        if kind == "card":
            d = card()
            return ".".join(d[i: i + 4] for i in range(0, 16, 4)) if altered else rng.choice([d, *(s.join(d[i: i + 4] for i in range(0, 16, 4)) for s in " -")])
        tail = rng.choice([f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}"])
        return tail if altered else f"+{rng.randint(1, 99)} " + tail

    out = []
    for i in range(count):
        before, behind = " ".join(word() for _ in range(rng.randint(1, 6))), " ".join(word() for _ in range(rng.randint(1, 6)))
        kind = (*KINDS, "")[i % 5]
        if kind:
            e = entity(kind, i % 2 == 1)
            spans = [(kind, len(before) + 1, len(before) + 1 + len(e))]
        else:  # years, amounts, versions, identifiers
            e, spans = rng.choice([number(4), number(6), number(9), f"{number(1)}.{number(1)}.", f"{number(2)}.{number(2)}", word() + number(3) + word(), number(8) + word(1, 3) + number(6),
                                   f"{number(4)}-{number(2)}-{number(2)}", "at the", "at " + word() + " dot", f"{number(3)}-{number(3)}", number(16), number(20)]), []
        out.append((f"{before} {e}{rng.choice(['', '.', ','])} {behind}", spans))
    return out


def learn(spark: SparkSession, docs: DataFrame, text: str = "text", sample: int = 400, most_chars: int = 20_000, made: int = 400) -> np.ndarray:
    """Weights from at most ``sample`` documents of at most ``most_chars`` characters that
    hold a digit or an at sign, those with the smallest hash of their text, and
    ``made`` made-up sentences (with an empty corpus, from these alone)."""
    t = F.col(text)
    some = docs.select(t.alias("text"), F.xxhash64(t).alias("h")).where((F.length("text") <= most_chars) & F.col("text").rlike("[0-9@]"))
    rows = smallest_hashes(some, "h", sample).collect()
    found = [x for r in rows for x in labelled_regions(r["text"], base_spans(r["text"]))]
    found += [x for t_, spans in made_up(made) for x in labelled_regions(t_, spans)]
    return fit(found)


# ---- the operator ---------------------------------------------------------------

def added_spans(text: str, weights: np.ndarray, base: list[tuple[str, int, int]], least: float) -> list[tuple[str, int, int]]:
    """The field's segments of score ``least`` or more that touch no base span."""
    out = []
    for lo, hi in regions(text):
        tokens = tokenize(text, lo, hi)
        for i in range(0, len(tokens), 2048):  # long regions in parts, each with room for a segment before and after
            part = tokens[max(0, i - MOST_TOKENS): i + 2048 + MOST_TOKENS]
            first, after, feats = candidates(text, part)
            if not len(first):
                continue
            own = tokens[i][0], tokens[min(len(tokens), i + 2048) - 1][1]
            for a, b, k, score in best_segments(len(part), first, after, feats @ weights):
                s, e = part[a][0], part[b - 1][1]
                if score >= least and own[0] <= s < own[1] and all(e <= x or s >= y for _, x, y in base):
                    out.append((KINDS[k], s, e))
    return out


def searched_rows(spark: SparkSession, docs: DataFrame, text: str, names: list[str], weights: np.ndarray | None, least: float) -> DataFrame:
    """``row`` (a struct of ``names`` without ``text``, which goes to Python once), ``text`` and ``spans`` of every document."""
    weights = learn(spark, docs, text) if weights is None else weights
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names if c != text]).alias("row"), F.col(text).alias("text"))
    kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def search(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part, out = batch.slice(i, 512), []
                for x in part.column(1):
                    t = x.as_py() or ""
                    base = base_spans(t)
                    spans = [(k, s, e, True) for k, s, e in base]
                    if _TRIGGER.search(t):
                        spans += [(k, s, e, False) for k, s, e in added_spans(t, weights, base, least)]
                    spans.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
                    out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in spans])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.list_(kinds))], names=["row", "text", "spans"])

    schema = T.StructType([*rows.schema.fields, *spark.createDataFrame([], f"spans array<{SPAN}>").schema.fields])
    return rows.mapInArrow(search, schema)


def find_personal_data(spark: SparkSession, docs: DataFrame, text: str = "text", carry: list[str] | None = None,
                       weights: np.ndarray | None = None, least: float = 2.0) -> DataFrame:
    """``carry`` columns (default: all) and ``spans``: kind, start and end in code points, and
    whether a base pattern found it; by kind as listed, then start.

    Null or empty text: no spans. Null values, repeated rows: a row each. Texts are
    searched whole; the time grows with their length. Empty table: no rows. An
    input column called ``spans`` gives way to the new one.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c != "spans"]
    return searched_rows(spark, docs, text, names, weights, least).select(*[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in names], "spans")


def mask_documents(spark: SparkSession, docs: DataFrame, text: str = "text", weights: np.ndarray | None = None, least: float = 2.0) -> DataFrame:
    """The documents with every span replaced by its kind; an ``n_chars`` column follows. Null text stays null."""
    rows = searched_rows(spark, docs, text, docs.columns, weights, least).select("row", mask_text(F.col("text"), F.col("spans")).alias("new"), F.size("spans").alias("n"))
    out = []
    for c in docs.columns:
        value = F.col("new") if c == text else F.col("row")[c]
        if c == "n_chars" and c != text:
            value = F.when(F.col("n") > 0, F.length("new").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_text(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans
    become one mark, the first one's."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    masked = F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(masked)
