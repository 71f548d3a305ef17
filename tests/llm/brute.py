"""Plain versions of the operators' definitions, for small inputs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def cover(n, starts, length):
    gone = [False] * n
    for i in starts:
        gone[i: i + length] = [True] * length
    return gone


def repeated_words(rows, length):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i: i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = cover(len(w), [i for i in range(len(w) - length + 1) if count[tuple(w[i: i + length])] > 1], length)
        out.append((key, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def repeated_bytes(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    rank = [1 << 62 if k is None else k for k, _ in rows]
    least = {}
    for k, b in zip(rank, bodies):
        for i in range(len(b) - length + 1):
            least[b[i: i + length]] = min(least.get(b[i: i + length], 1 << 63), k)
    out = []
    for (key, _), k, b in zip(rows, rank, bodies):
        gone = cover(len(b), [i for i in range(len(b) - length + 1) if least[b[i: i + length]] < k], length)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((key, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    window = Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7))
    again = cover(len(w), [i for i in range(len(w) - 7) if window[tuple(w[i: i + 8])] > 1], 8)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(again))


def shingles(text, size):
    w = WORD.findall(lower(text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i: i + size]) for i in range(len(w) - size + 1)}


def jaccard_components(rows, size, percent):
    sets, parent = [shingles(t, size) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def turns_digest(rows):
    """rows: (conv, turn, role, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_data(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum((x * 2 - 9 * (x > 4)) if i % 2 else x for i, x in enumerate(map(int, reversed(digits))))
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn % 10 == 0 or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def passages(seed=3, count=90):
    """Documents built of shared passages, edits and odd rows: (key, text)."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "ar", "été", "x", "foo", "barbaz"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", " "]) for _ in range(n))
    shared = [text(30) for _ in range(10)]
    rows = []
    for i in range(count):
        t = ""
        for _ in range(rng.randint(0, 6)):
            t += rng.choice(shared) if rng.random() < 0.5 else text(rng.randint(0, 40))
            if rng.random() < 0.2:
                t = t[: len(t) // 2] + "q" + t[len(t) // 2:]
        rows.append((i, t))
    rows += [(200, None), (None, shared[0] * 3), (None, shared[0] * 3), (5, rows[5][1]), (201, ""), (202, "a " * 300), (203, "zz" * 100), (204, "  lone ")]
    rows += [(300 + k, text(3) + shared[1] + text(3)) for k in range(40)]
    rng.shuffle(rows)
    return rows
