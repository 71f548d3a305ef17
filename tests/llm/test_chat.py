import random

import pytest

from tests.llm import brute
from visitmap.llm.chat_windows import CONTROL, escape, format_conversations, parse, read_back, unescape


def rows():
    out = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (None, 0, None, "x"), (None, None, "tool]", None),
           (1, 0, "system", "sys \\ <<SYS>> \\\\</s>"), (2, 0, "system", None), (3, 0, "assistant", ""), (3, 1, "assistant", None)]
    out += [(1, i, ("user", "assistant")[i % 2], "w " * (i % 37) + "\\<s>[:]") for i in range(1, 400)]
    out += [(2, i, ("user", "assistant")[i % 2], "word " * (i % 300)) for i in range(1, 60)]
    return out + [(2, 5, "assistant", "word word")] * 3


@pytest.mark.parametrize("budget, history, stretch", [(1024, 192, 64), (60, 20, 2), (10, 4, 1)])
def test_round_trip(spark, budget, history, stretch):
    turns = spark.createDataFrame([(*r, 1) for r in rows()], "conv_id long, turn long, role string, text string, first int")
    windows = format_conversations(spark, turns, budget, history, stretch)
    got = {r.conv_id: tuple(r)[1:5] for r in read_back(spark, windows).collect()}
    assert got == brute.turns_digest(rows())
    found = windows.collect()
    for r in found:
        told = parse(r.formatted)
        head, new = parse(r.formatted[: r.new_from]), parse(r.formatted[r.new_from:])
        size = lambda t: len(brute.WORD.findall(t[1])) + 2
        assert sum(map(size, told)) == r.n_tokens
        assert r.n_tokens <= budget or len(new) == 1
        if r.conv_id in (1, 2) and r.first:
            assert told[0][0] == "system"
            assert sum(map(size, head[1:])) <= history
    repeated = sum(len(parse(r.formatted[: r.new_from])) for r in found)
    assert (repeated > 0) == (len(found) > len({r.conv_id for r in found}))


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(6)
    parts = [*CONTROL, "\\", "<", "[", "/", "s>", "]", "a", "\n", "<\\/s>"]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        e = escape(t)
        assert unescape(e) == t and not any(c in e for c in CONTROL)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(spark, format_conversations(spark, empty)).count() == 0
