"""Chat formatting in windows of bounded size.

Prefix sums of the turns' tokens decide the windows: a window takes whole turns
while they fit its budget beside the system turn and the history, the last
turns before it, repeated up to their own smaller budget. Only turns that are new in a
window carry loss, so each assistant text is a target once. A conversation of
any length is dealt out by its prefix sums in stretches of some windows, each a
unit of work of bounded size; windows end at a stretch's end.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.mixing import running_total, word_array

# The template's marks for each role.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[:]", "[/ROLE]")
NO_ROLE = ("[NONE]", "[/NONE]")
CONTROL = [*(x for pair in MARKS.values() for x in pair), *OTHER, *NO_ROLE]

MARK_TOKENS = 2
_ANY = re.compile("|".join(re.escape(x) for x in CONTROL))
_BACK = re.compile(r"\\(\\?)", re.S)
WINDOWS = "conv_id long, first long, formatted string, n_tokens long, new_from int, loss array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    """Double every backslash and put one behind the first sign of every control string."""
    return _ANY.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def open_close(role: str | None) -> tuple[str, str]:
    if role is None:
        return NO_ROLE
    if role in MARKS:
        return MARKS[role]
    return OTHER[0] + escape(role) + OTHER[1], OTHER[2]


def parse(formatted: str) -> list[tuple[str | None, str]]:
    """The turns of a formatted text."""
    opens = {v[0]: k for k, v in MARKS.items()}
    out, at = [], 0
    while at < len(formatted):
        m = _ANY.match(formatted, at)
        mark = m.group()
        at = m.end()
        if mark == OTHER[0]:
            stop = formatted.index(OTHER[1], at)
            role, at, close = unescape(formatted[at:stop]), stop + len(OTHER[1]), OTHER[2]
        elif mark == NO_ROLE[0]:
            role, close = None, NO_ROLE[1]
        else:
            role = opens[mark]
            close = MARKS[role][1]
        stop = formatted.index(close, at)
        out.append((role, unescape(formatted[at:stop])))
        at = stop + len(close)
    return out


class Windows:
    """Collects one stretch's turns into windows."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.start(None, None, [])

    def start(self, conv, system, before):
        self.conv, self.system, self.past, self.new = conv, system, before, []

    def add(self, turn):
        """A new turn (role, text, tokens, prefix sum); a finished window or None."""
        done = None
        if self.new and self.size() + turn[2] > self.budget:
            done = self.finish()
        self.new.append(turn)
        return done

    def repeated(self):
        # No more history than fits beside the system turn and the window's first new turn.
        taken = (self.system[2] if self.system else 0) + (self.new[0][2] if self.new else 0)
        room, kept = min(self.history, max(0, self.budget - taken)), []
        for t in reversed(self.past):
            if t[2] > room:
                break
            room -= t[2]
            kept.append(t)
        return kept[::-1]

    def head(self):
        """Turns in front of the new ones; the system turn only where it isn't among them."""
        kept = self.repeated()
        if self.system and not (self.new and self.new[0][3] == 0) and not any(t[3] == 0 for t in kept):
            kept.insert(0, self.system)
        return kept

    def size(self):
        return sum(t[2] for t in self.head()) + sum(t[2] for t in self.new)

    def finish(self):
        """The window of the new turns; they become history."""
        text, loss, at = [], [], 0
        head = self.head()
        for i, (role, body, _, _) in enumerate([*head, *self.new]):
            if i == len(head):
                new_from = at
            left, right = open_close(role)
            inner = escape(body)
            if i >= len(head) and role == "assistant":
                loss.append({"start": at + len(left), "end": at + len(left) + len(inner)})
            text += (left, inner, right)
            at += len(left) + len(inner) + len(right)
        row = (self.conv, self.new[0][3], "".join(text), self.size(), new_from, loss)
        tail, room = [], self.history
        for t in reversed([*self.past, *self.new]):
            if t[2] > room:
                break
            room -= t[2]
            tail.append(t)
        self.past, self.new = tail[::-1], []
        return row


def format_conversations(spark: SparkSession, turns: DataFrame, budget: int = 1024, history: int = 192, stretch: int = 64,
                         conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Windows of every conversation: ``conv_id``, ``first`` (tokens before its first new turn,
    which orders a conversation's windows), ``formatted``, ``n_tokens``, ``new_from``
    (where the new turns start) and ``loss`` (parts of ``formatted`` that are targets).

    A turn's tokens are its words and two marks. A turn larger than the budget is never
    cut; its window is larger. Null text: empty. Null role: a role of its own. Null
    conversation ids are one conversation. Turns stand by number, null first, then role
    and text; repeated rows are turns of their own. Empty table: no rows. Other
    columns are not read.
    """
    size = F.size(word_array(F.col(text))).cast("long") + MARK_TOKENS
    rows = turns.select(F.col(conv).isNull().alias("conv_null"), F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("ck"), F.col(turn).alias("turn"),
                        F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"), size.alias("tokens"),
                        F.floor(F.coalesce(F.col(turn), F.lit(0)) / 1024).cast("long").alias("part"))
    keys = ["conv_null", "ck"]
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.col("text")]
    placed = running_total(rows, keys, "part", order, "tokens", "first").drop("part", "turn")
    width = stretch * budget
    placed = placed.withColumn("stretch", F.expr(f"first div {width}"))
    cut = (F.col("stretch") + 1) * width
    columns = [*keys, "stretch", "role", "text", "tokens", "first"]
    # kind 0: the system turn; 1: turns of the stretch before; 2: the stretch's own turns.
    own = placed.select(*columns, F.lit(2).alias("kind"))
    late = placed.where(F.col("first") + F.col("tokens") + history >= cut).select(*keys, (F.col("stretch") + 1).alias("stretch"), "role", "text", "tokens", "first", F.lit(1).alias("kind"))
    later = placed.where("stretch > 0").select(*keys, "stretch").distinct()
    system = placed.where("first = 0 and role = 'system'").drop("stretch").join(later, keys).select(*columns, F.lit(0).alias("kind"))
    dealt = own.unionByName(late).unionByName(system).repartition(*keys, "stretch").sortWithinPartitions(*keys, "stretch", "kind", "first")

    def build(batches):
        w, group, out = Windows(budget, history), None, []

        def batch():
            nonlocal out
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            got = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in WINDOWS.split(", ")])
            out = []
            return got

        for rows in batches:
            for r in rows.to_pylist():
                mine = (r["conv_null"], r["ck"], r["stretch"])
                if mine != group:
                    if w.new:
                        out.append(w.finish())
                    group = mine
                    w.start(None if r["conv_null"] else r["ck"], None, [])
                t = (r["role"], r["text"], r["tokens"], r["first"])
                if r["kind"] == 0:
                    w.system = t
                elif r["kind"] == 1:
                    w.past.append(t)
                else:
                    if t[3] == 0 and t[0] == "system":
                        w.system = t
                    if done := w.add(t):
                        out.append(done)
                if len(out) >= 512:
                    yield batch()
        if w.new:
            out.append(w.finish())
        if out:
            yield batch()

    return dealt.mapInArrow(build, WINDOWS)


def read_back(spark: SparkSession, windows: DataFrame) -> DataFrame:
    """Digest of every conversation from its windows alone, streamed in order."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    dealt = windows.select("conv_id", "first", "formatted", "new_from", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "first")

    def read(batches):
        conv, state, out = None, None, []

        def close():
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            got = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in schema.split(", ")])
            out.clear()
            return got

        for rows in batches:
            for r in rows.to_pylist():
                if state is None or r["conv_id"] != conv:
                    if state is not None:
                        close()
                    conv, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                f = r["formatted"]
                for role, text in parse(f[r["new_from"]:]):
                    state[0] += 1
                    state[1].update(f"{role or ''}\n{text}\n".encode())
                for part in r["loss"]:
                    text = unescape(f[part["start"]: part["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(f)
            if len(out) > 4096:
                yield batch()
        if state is not None:
            close()
        if out:
            yield batch()

    return dealt.mapInArrow(read, schema)
