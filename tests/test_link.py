from pyspark.sql import functions as F

from pyspark.testing import assertSchemaEqual

from tests.cases import CUS_ROWS, CUS_SCHEMA, LINKED_ROWS, LINKED_SCHEMA, MSG_ROWS, MSG_SCHEMA
from visitmap.functions.keys import contact_key
from visitmap.operators import link, link_on, rename_app_id


def test_inner_join_builds_contact_key(spark):
    cus = spark.createDataFrame(CUS_ROWS, CUS_SCHEMA)
    msg = spark.createDataFrame(MSG_ROWS, MSG_SCHEMA)
    out = link(cus, msg)
    expected = spark.createDataFrame(LINKED_ROWS, LINKED_SCHEMA)
    assertSchemaEqual(out.schema, expected.schema)
    assert sorted(out.collect(), key=str) == sorted(expected.collect(), key=str)


def test_white_space_in_an_id_is_kept(spark):
    cus = spark.createDataFrame(CUS_ROWS, CUS_SCHEMA)
    msg = spark.createDataFrame(MSG_ROWS, MSG_SCHEMA)
    rows = link(cus, msg).where(F.col("parent_contact_id") == "46-talk:006").collect()
    assert [r.visit_guids for r in rows] == [["g6\t", "g 6"]] * 2


def test_null_key_dropped_and_null_account_gives_null_key(spark):
    cus = spark.createDataFrame(
        [(None, "a", "b", "c", ["x"]), ("k", "a", "b", "c", ["y"])], CUS_SCHEMA)
    msg = spark.createDataFrame(
        [(None, 1, "app", "SMS", None), ("k", None, "app", "SMS", None)], MSG_SCHEMA)
    rows = link(cus, msg).collect()
    assert len(rows) == 1
    assert rows[0].parent_contact_id is None
    assert rows[0].visit_guids == ["y"]


def test_duplicate_keys_multiply(spark):
    cus = spark.createDataFrame([("k", "a", "b", "c", ["x"])], CUS_SCHEMA)
    msg = spark.createDataFrame([("k", 1, "app", "SMS", None)] * 3 + [("k", 2, "app", "SMS", None)], MSG_SCHEMA)
    assert link(cus, msg).count() == 4


def test_on_form_keeps_both_keys(spark):
    cus = spark.createDataFrame(CUS_ROWS, CUS_SCHEMA)
    msg = spark.createDataFrame(MSG_ROWS, MSG_SCHEMA)
    out = link_on(cus, msg)
    assert out.columns[:3] == ["cus_conversation_id", "msg_conversation_id", "parent_contact_id"]
    rows = out.collect()
    assert len(rows) == len(LINKED_ROWS)
    assert all(r.cus_conversation_id == r.msg_conversation_id for r in rows)
    using = link(cus, msg)
    assert sorted(out.drop("cus_conversation_id", "msg_conversation_id").collect(), key=str) == sorted(using.collect(), key=str)


def test_rename_and_key_types(spark):
    msg = spark.createDataFrame(MSG_ROWS, MSG_SCHEMA)
    renamed = rename_app_id(msg)
    assert "app_id" in renamed.columns and "visitor_app_id" not in renamed.columns
    keys = msg.select(contact_key(F.col("account_id"), F.col("conversation_id")).alias("k"))
    want = [None if r[1] is None else f"{r[1]}-{r[0]}" for r in MSG_ROWS]
    assert sorted((r.k for r in keys.collect()), key=str) == sorted(want, key=str)
