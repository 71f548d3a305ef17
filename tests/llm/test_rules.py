from tests.llm import brute
from visitmap.llm.quality_rules import judge_documents, keep_documents

SCHEMA = "doc_id long, text string, lang string, source string, counts int, `row` int"


def rows():
    out = [(i, f"text {r[1]}" if r[1] else r[1], "en", "s", 1, 2) for i, r in enumerate(brute.passages(count=40))]
    out += [(900, None, None, None, 1, 2), (901, "", "en", "s", 1, 2), (902, " \x0b\n a", "en", None, 1, 2), (903, "a b " * 40 + "\n\nx\nx\n x\nx", None, "s", 1, 2),
            (904, "é$ été||  x y", None, "s", 1, 2), (904, "é$ été||  x y", None, "s", 1, 2), (905, "w" * 100_000 + " b", "en", "s", 1, 2)]
    return out


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = judge_documents(spark, docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "row", "counts", "base_failed", "kept"]
    found = got.collect()
    assert len(found) == len(rows())
    for r in found:
        c = r.counts
        want = brute.counts(r.text)
        assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_thresholds_follow_the_group(spark):
    word = lambda i: " ".join(f"word{(i * 7 + k) % 97}x{k}" for k in range(60))
    plain = [(i, word(i), "en", f"s{i % 2}", 1, 2) for i in range(200)]
    # In the third source a symbol after each word is the rule, elsewhere it isn't.
    signs = [(1000 + i, word(i).replace(" ", "# "), "en", "code", 1, 2) for i in range(100)]
    odd = [(2000 + i, word(i).replace(" ", "# "), "en", "s0", 1, 2) for i in range(3)]
    kept = {r.doc_id for r in keep_documents(spark, spark.createDataFrame(plain + signs + odd, SCHEMA)).collect()}
    assert kept == {r[0] for r in plain + signs}


def test_bounds_come_from_the_groups_own_spread(spark):
    words = lambda i, m: [f"{chr(97 + i % 26)}{k:03d}" + "x" * ((i + k) % m) for k in range(200)]
    rows = [(i, " ".join(words(i, 3)), "en", "s", 1, 2) for i in range(300)]
    again = words(7, 3)
    rows += [(1000, " ".join(again[:150] + again[:25]), "en", "s", 1, 2),  # a quarter of its words repeat, here none do
             (1001, " ".join(w + "x" for w in words(8, 3)), "en", "s", 1, 2),  # a sign longer than the others, which vary by less
             (1002, "\n".join([" ".join(words(9, 3)[:30]), "a", "a"]), "en", "s", 1, 2),  # a third of its lines
             (1003, " ".join(words(10, 3)[:100]) + " & " + " ".join(words(10, 3)[100:]), "en", "s", 1, 2)]  # one symbol among 200 words
    found = {r.doc_id: r for r in judge_documents(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert {k for k, r in found.items() if not r.kept} == {1000, 1001, 1002}


def test_empty_table(spark):
    assert judge_documents(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    judge_documents(spark, spark.createDataFrame(rows(), SCHEMA).coalesce(1)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
