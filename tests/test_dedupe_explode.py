from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.testing import assertSchemaEqual

from tests.cases import LINKED_ROWS, LINKED_SCHEMA
from visitmap.operators import dedupe, distinct_sql, explode_ids, group_by_all_sql

ARR = T.StructType([T.StructField("id", T.StringType()), T.StructField("visit_guids", T.ArrayType(T.StringType()))])


def test_dedupe_with_arrays_and_nulls(spark):
    df = spark.createDataFrame(LINKED_ROWS[::-1] + LINKED_ROWS, LINKED_SCHEMA)
    out = dedupe(df)
    assertSchemaEqual(out.schema, df.schema)
    assert sorted(out.collect(), key=str) == sorted(spark.createDataFrame(LINKED_ROWS, LINKED_SCHEMA).collect(), key=str)


def test_nulls_equal_and_array_order_matters(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", None), ("b", ["x", "y"]), ("b", ["y", "x"]), ("c", [None]), ("c", [None])], ARR)
    out = dedupe(df).collect()
    assert len(out) == 4


def test_sql_forms_equal_dataframe_form(spark):
    df = spark.createDataFrame(LINKED_ROWS[2:] + LINKED_ROWS, LINKED_SCHEMA)
    a = sorted(dedupe(df).collect(), key=str)
    assert sorted(distinct_sql(spark, df).collect(), key=str) == a
    assert sorted(group_by_all_sql(spark, df).collect(), key=str) == a


def test_explode_null_empty_and_repeats(spark):
    df = spark.createDataFrame([("n", None), ("e", []), ("r", ["a", "a", None])], ARR)
    out = explode_ids(df)
    assert out.columns == ["id", "visit_guid"]
    got = sorted(((r.id, r.visit_guid) for r in out.collect()), key=str)
    assert got == sorted([("n", None), ("e", None), ("r", "a"), ("r", "a"), ("r", None)], key=str)
    assert dedupe(out).where(F.col("id") == "r").count() == 2


def test_array_order_equal_after_explode(spark):
    df = spark.createDataFrame([("k", ["a", "b"]), ("k", ["b", "a"])], ARR)
    assert dedupe(df).count() == 2
    assert dedupe(explode_ids(df)).count() == 2


def test_rows_after_explode_and_dedupe_commutes(spark):
    data = [("k1", ["a", "b", "a"]), ("k1", ["a", "b", "a"]), ("k2", None), ("k3", []), ("k4", ["z", None])]
    df = spark.createDataFrame(data, ARR)
    assert explode_ids(df).count() == sum(max(1, len(g or [])) for _, g in data)
    once = sorted(dedupe(explode_ids(df)).collect(), key=str)
    twice = sorted(dedupe(explode_ids(dedupe(df))).collect(), key=str)
    assert once == twice
    assert sorted(dedupe(dedupe(df)).collect(), key=str) == sorted(dedupe(df).collect(), key=str)
