"""Messaging laid out by conversation: the same visit map, no shuffle of the history, row groups that aren't read."""

import logging
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import cases
from visitmap import DateWindow, build_visit_map
from visitmap.job import parse_args
from visitmap.plans import layout as lay
from visitmap.plans import scheduled_visit_map
from visitmap.session import scratch_path
from visitmap.sources import load_inputs

SF = "/root/testdata/sf0.001"
W = DateWindow("1997-01-01", "1998-12-31")
STAMP = "2024-02-01 00:00:00"


@pytest.fixture
def laid_out(spark):
    made = []

    def make(msg, buckets=8, **kwargs):
        found = lay.create_layout(spark, msg, f"lay_{uuid.uuid4().hex}", scratch_path(spark, "layout"), buckets, **kwargs)
        made.append(found)
        return found

    yield make
    for found in made:
        for name in (found.name, found.hot_name):
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


def rows(df):
    return sorted(map(str, df.collect()))


def initial_plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def read_rows(df):
    """Rows that the scans of a plan without shuffles gave: those of the row groups and pages that were read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_messaging_is_not_shuffled(spark, laid_out):
    cus, msg = load_inputs(spark, SF)
    found = laid_out(msg)
    assert spark.table(found.hot_name).isEmpty()
    df = build_visit_map(cus, found, W, build_ts=STAMP)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", initial_plan(df))
    # The customer side's, and the one wide dedupe after the explode; messaging is deduped and joined where it lies.
    assert exchanges.count("conversation_id") == 1 and len(exchanges) == 2
    assert rows(df) == rows(build_visit_map(cus, msg, W, build_ts=STAMP))


def test_too_few_buckets_are_told(spark, laid_out, caplog):
    cus, msg = load_inputs(spark, SF)
    found = laid_out(msg, buckets=2)
    with caplog.at_level(logging.WARNING, logger="visitmap"):
        df = build_visit_map(cus, found, W, build_ts=STAMP)
    assert "fewer buckets" in caplog.text
    assert rows(df) == rows(build_visit_map(cus, msg, W, build_ts=STAMP))


def file_rows(spark, found):
    return [r[1] for r in spark.table(found.name).groupBy(F.input_file_name()).count().collect()]


def test_buckets_follow_the_rows(spark, laid_out, caplog):
    cus, _ = load_inputs(spark, SF)
    # Two rows a conversation, and a crowded one, whose rows don't count.
    msg = spark.range(6000).select(
        (F.col("id") % 3000).cast("string").alias("conversation_id"), F.col("id").alias("account_id"), F.lit("a").alias("visitor_app_id"),
        F.lit("web").alias("conversation_source"), F.lit(None).cast("string").alias("visitor_device_type"))
    crowd = spark.range(3000).select(F.lit("3").alias("conversation_id"), F.col("id").alias("account_id"), *[F.lit("b").alias(c) for c in msg.columns[2:]])
    one = msg.where("account_id < 3000").unionByName(crowd)
    found = laid_out(one, buckets=2, hot_rows=100, bucket_rows=300)
    assert lay.bucket_number(spark, found) == 10  # 2,999 rows, 300 each
    assert max(file_rows(spark, found)) < 600
    with caplog.at_level(logging.WARNING, logger="visitmap"):
        lay.append_layout(spark, found, msg, hot_rows=100, bucket_rows=300)
        assert "anew" not in caplog.text
        # An append of twice as much a bucket as one task writes; then the layout has outgrown its buckets.
        assert lay.bucket_number(spark, found) == 10 and max(file_rows(spark, found)) < 600
        lay.append_layout(spark, found, msg.withColumn("visitor_app_id", F.lit("c")), hot_rows=100, bucket_rows=300)
    assert "anew" in caplog.text
    everything = one.unionByName(msg).unionByName(msg.withColumn("visitor_app_id", F.lit("c")))
    assert rows(build_visit_map(cus, found, None, build_ts=STAMP)) == rows(build_visit_map(cus, everything, None, build_ts=STAMP))


@pytest.mark.parametrize("prededupe", ["auto", "both", "none"])
def test_crowded_conversations_on_both_sides(spark, laid_out, prededupe):
    cus, msg = load_inputs(spark, SF)
    key = F.col("conversation_id")
    some = [r[0] for r in msg.select(key).distinct().orderBy(key).limit(2).collect()]
    many = msg.where(key.isin(some)).crossJoin(spark.range(40).withColumnRenamed("id", "n")).withColumn("visitor_app_id", F.concat("visitor_app_id", "n")).drop("n")
    lots = cus.where(key.isin(some)).crossJoin(spark.range(30).withColumnRenamed("id", "n")).withColumn("visit_guids", F.array(F.concat(F.lit("g"), "n"))).drop("n")
    cus, msg = cus.unionByName(lots), msg.unionByName(many).unionByName(many)
    found = laid_out(msg, hot_rows=20)
    hot = {r[0] for r in spark.table(found.hot_name).select(key).distinct().collect()}
    assert hot == set(some) and spark.table(found.name).where(key.isin(some)).isEmpty()
    narrow = found.for_slice(cus, hot_rows=10)
    assert set(narrow.keys.crowded) == set(some)
    expect = rows(build_visit_map(cus, msg, None, build_ts=STAMP))
    for messaging in (found, narrow):
        assert rows(build_visit_map(cus, messaging, None, build_ts=STAMP, prededupe=prededupe)) == expect


def test_rows_that_are_appended_late_and_twice(spark, laid_out):
    cus, msg = load_inputs(spark, SF)
    key = F.col("conversation_id").cast("bigint")
    found = laid_out(msg.where(key % 3 != 0), hot_rows=6)
    for _ in range(2):  # an append that was cut off is run again
        lay.append_layout(spark, found, msg.where(key % 3 != 1), hot_rows=4)
    df, _ = scheduled_visit_map(spark, cus, found, W, build_ts=STAMP)
    assert rows(df) == rows(build_visit_map(cus, msg, W, build_ts=STAMP))


def test_hand_made_rows_nulls_and_extra_columns(spark, laid_out):
    cus = spark.createDataFrame([*cases.CUS_ROWS, (None, cases.BEGAN, cases.ENDED, cases.DAY, ["g"])], cases.CUS_SCHEMA)
    msg = spark.createDataFrame([*cases.MSG_ROWS, *cases.MSG_ROWS, (None, 1, "shop", "web", None), ("talk:003", None, None, None, None)], cases.MSG_SCHEMA)
    found = laid_out(msg.withColumn("rows", F.lit(1)).withColumn("visit_guids", F.lit("x")))
    assert spark.table(found.name).where("conversation_id IS NULL").isEmpty()
    assert spark.table(found.name).count() == len(cases.MSG_ROWS) + 1  # distinct
    expect = rows(build_visit_map(cus, msg, None, build_ts=STAMP))
    assert rows(build_visit_map(cus, found.for_slice(cus), None, build_ts=STAMP)) == expect


def test_empty_sides(spark, laid_out):
    cus, msg = load_inputs(spark, SF)
    empty = laid_out(msg.limit(0))
    assert build_visit_map(cus, empty, W, build_ts=STAMP).isEmpty()
    found = laid_out(msg)
    none = found.for_slice(cus.limit(0))
    assert none.keys.low is None
    assert build_visit_map(cus.limit(0), none, W, build_ts=STAMP).isEmpty()
    lay.append_layout(spark, empty, msg)
    assert rows(build_visit_map(cus, empty, W, build_ts=STAMP)) == rows(build_visit_map(cus, msg, W, build_ts=STAMP))


def test_keys_of_another_type_are_not_narrowed(spark, laid_out):
    cus, msg = load_inputs(spark, SF)
    found = laid_out(msg.withColumn("conversation_id", F.col("conversation_id").cast("bigint")))
    assert found.for_slice(cus).keys is None
    assert rows(build_visit_map(cus, found.for_slice(cus), W, build_ts=STAMP)) == rows(build_visit_map(cus, msg, W, build_ts=STAMP))


def test_row_groups_that_a_slice_cannot_meet_are_not_read(spark, laid_out):
    # Even numbers only: an odd one is in the range of some row group, and in no bloom filter.
    number = 400_000
    msg = spark.range(number).select(
        F.lpad((F.col("id") * 2).cast("string"), 10, "0").alias("conversation_id"), F.lit(1).alias("account_id"), F.lit("a").alias("visitor_app_id"),
        F.lit("web").alias("conversation_source"), F.sha2(F.col("id").cast("string"), 256).alias("visitor_device_type"))
    found = laid_out(msg)

    def read(numbers, **kwargs):
        keys = spark.createDataFrame([(f"{n:010d}",) for n in numbers], T.StructType([T.StructField("conversation_id", T.StringType())]))
        narrow = lay.MessagingLayout(found.name, lay.slice_keys(keys, **kwargs))
        (part,) = narrow.parts(spark)[:1]
        return read_rows(part), part.count()

    assert read_rows(spark.table(found.name)) == number
    assert read([300_001]) == (0, 0)                        # the bloom filters
    few, met = read([20_000, 20_001, 700_000])
    assert met == 2 and few < number / 2                    # listed conversations
    span, met = read(range(20_000, 40_000), listed=10)
    assert met == 10_000 and span < number                  # their range alone


def test_arguments(spark, laid_out):
    cus, msg = load_inputs(spark, SF)
    found = laid_out(msg)
    assert lay.bucket_number(spark, found) == 8
    with pytest.raises(ValueError, match="no end dates"):
        build_visit_map(cus, found, W, sides="both")
    base = ["--customer", "a", "--target-path", "/x"]
    for wrong in ([], ["--messaging", "b", "--messaging-layout", "c"], ["--messaging-layout", "c", "--sides", "both"],
                  ["--messaging-layout", "c", "--places-path", "/p"]):
        with pytest.raises(SystemExit):
            parse_args(base + wrong)
    assert parse_args([*base, "--messaging-layout", "c"]).messaging_layout == "c"
