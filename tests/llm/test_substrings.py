import pytest

from tests.llm import brute
from visitmap.llm.bwt_dedup import dedup_by_merged_transforms
from visitmap.llm.rlz_dedup import dedup_by_parsing

ROWS = brute.passages()
SCHEMA = "doc_id long, text string, kept_text int, status string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in ROWS], SCHEMA).cache()


# Small blocks and buckets: many of both; no hot anchors, some, only hot ones.
@pytest.mark.parametrize("hot, block", [(1024, 1500), (3, 1 << 20), (0, 1500)])
def test_parsing_removes_exactly_the_repeated_windows(docs, spark, hot, block):
    out = dedup_by_parsing(spark, docs, length=12, gram=3, hot_contexts=hot, block_bytes=block, bucket_bytes=400)
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect()], key=str)
    assert got == sorted(brute.repeated_words(ROWS, 12), key=str)


@pytest.mark.parametrize("hot, block", [(1024, 1500), (3, 1 << 20), (0, 1500)])
def test_merged_transforms_remove_exactly_the_earlier_strings(docs, spark, hot, block):
    out = dedup_by_merged_transforms(spark, docs, length=25, gram=9, hot_contexts=hot, block_bytes=block, bucket_bytes=400)
    got = sorted([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in out.collect()], key=str)
    assert got == sorted(brute.repeated_bytes(ROWS, 25), key=str)


def test_a_passage_at_every_offset_and_in_one_text_twice(spark):
    words = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(words)), (2, "q " + " ".join(words[:36])), (3, " ".join(["r"] * 10 + words[14:])), (4, " ".join(words[:34])),
            (5, " ".join(["s"] + words[5:45] + ["t"] + words[5:45]))]
    out = dedup_by_parsing(spark, spark.createDataFrame(rows, "doc_id long, text string"), length=35)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect())
    assert got == brute.repeated_words(rows, 35)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_by_parsing(spark, empty).count() == 0
    assert dedup_by_merged_transforms(spark, empty).count() == 0


def test_windows_longer_than_an_anchors_mask(spark):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = []
    for i in range(12):  # copies with other ends; the first words and the last ones decide which windows repeat
        shared = words(f"p{i}x", 450).split()
        rows += [(4 * i + j, " ".join([words(f"own{i}y{j}z", 30), *shared[7 * j: 450 - 11 * j], words(f"end{i}y{j}z", 30)])) for j in range(4)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    for length in (100, 400):
        got = dedup_by_parsing(spark, docs, length=length, gram=8).collect()
        assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got], key=str) == sorted(brute.repeated_words(rows, length), key=str)
    got = dedup_by_merged_transforms(spark, docs, length=400, gram=20).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got], key=str) == sorted(brute.repeated_bytes(rows, 400), key=str)
