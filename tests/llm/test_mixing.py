import duckdb
from pyspark.sql import functions as F

from visitmap.llm.mixing import ORACLE, Mix, mix_documents, van_der_corput, word_array

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, `row` int"


def test_equals_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Mix(spark, docs, block_words=100).taken().select("doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(ORACLE).df()
    key = lambda d: d.sort_values("doc_id").reset_index(drop=True)
    assert key(got).equals(key(want))


def test_odd_rows_and_targets(spark):
    rows = [(1, "a b c", None, "x", 1, 1, 1)] * 2 + [(2, "w " * 5000, None, "y", 1, 1, 1), (None, None, None, "y", 0, 1, 1), (3, " \n ", None, "empty", 0, 1, 1),
            (4, "d e", None, None, 1, 1, 1), (None, "f", None, None, 1, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    mix = Mix(spark, docs, block_words=7)
    got = mix.taken().collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 3 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(int(t) == n for t, n in by.values())
    assert by["x"][0] == 18.0 and by["empty"][0] == 0.0 and by[None][0] == 9.0  # three times their size
    assert sum(t for t, _ in by.values()) == 5009
    out = mix_documents(spark, docs, block_words=7)
    assert out.columns == docs.columns
    assert out.agg(F.sum(F.size(word_array(F.col("text"))))).first()[0] == 5009
    again = Mix(spark, docs.repartition(3), block_words=7).taken()
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_null_ids_are_spread_and_copies_have_places_of_their_own(spark):
    texts = [f"word{i} " * (i % 7) for i in range(3000)]
    rows = [(i if i % 3 else None, t, None, "x", 1, 1, 1) for i, t in enumerate(texts)] + [(None, "a copy", None, "x", 1, 1, 1)] * 2000
    mix = Mix(spark, spark.createDataFrame(rows, SCHEMA), block_words=10)
    lines = mix.lines.collect()
    assert len(lines) == len(rows)
    places = sorted((r.start, r.start + r.size) for r in lines if r["size"])
    assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:]))
    by = mix.lines.where("doc_id is null and size not in (0, 2)").groupBy("h", "tie").count().agg(F.max("count"), F.count("*")).first()
    assert by[0] <= 30 and by[1] > 200
    taken = mix.taken().agg(F.sum("taken"), F.count("*")).first()
    assert tuple(taken) == (sum(len(t.split()) for _, t, *_ in rows), len(rows))
    out = mix_documents(spark, spark.createDataFrame(rows, SCHEMA), block_words=10)
    assert out.agg(F.sum(F.size(word_array(F.col("text"))))).first()[0] == taken[0]


def test_every_stretch_of_the_schedule_holds_the_weights(spark):
    docs = spark.createDataFrame([(i, "w " * 50, None, f"s{i % 3}", 1, 1, 1) for i in range(300)], SCHEMA)
    mix = Mix(spark, docs, block_words=10)
    slots = mix.slots().orderBy("slot").collect()
    need = {r.src: r.need for r in mix.plan.collect()}
    for end in (64, 200, 700, len(slots)):
        for s, n in need.items():
            assert abs(sum(1 for r in slots[:end] if r.src == s) - end * n / len(slots)) <= 8
    assert mix.schedule().agg(F.sum(F.col("to_word") - F.col("from_word"))).first()[0] == mix.taken().agg(F.sum("taken")).first()[0]


def test_points(spark):
    got = [r[0] for r in spark.range(8).select(van_der_corput(F.col("id"), F.lit(8))).collect()]
    assert got == [0, 4, 2, 6, 1, 5, 3, 7]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Mix(spark, empty).taken().count() == 0 and mix_documents(spark, empty).count() == 0


def test_the_driver_follows_few_shuffles_at_a_time(spark):
    docs = spark.createDataFrame([(i, "w " * 50, None, f"s{i % 3}", 1, 1, 1) for i in range(300)], SCHEMA)
    for out in (Mix(spark, docs, block_words=10).taken(), mix_documents(spark, docs, block_words=10)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") <= 5
