"""Compaction after the writes, and a contract that grows."""

import os
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.schemas import output_schema
from visitmap.session import scratch_path
from visitmap.sinks import compact, create_target_table, insert_overwrite_by_name, overwrite_partitions
from visitmap.sinks.drift import compare_schemas, evolve_table, read_evolved
from visitmap.sources import read_target

NTZ = T.TimestampNTZType()


def target_rows(spark, days, each):
    out = []
    for d in days:
        ts = datetime(2024, 1, d, 12)
        out += [(f"7-{d}-{i}", ts, ts, ts, None if i % 5 == 0 else "app", "web", None, f"g{i}", ts + timedelta(days=9), date(2024, 1, d)) for i in range(each)]
    return spark.createDataFrame(out, output_schema(NTZ))


def files(path):
    path = path.removeprefix("file:")
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if d.startswith("rpt_mst_date=")}


def contents(spark, path):
    return sorted(map(str, read_target(spark, path, NTZ).collect()))


def fragmented(spark, name):
    path = scratch_path(spark, name)
    overwrite_partitions(target_rows(spark, [1, 2], 60).repartition(6), path, rebalance=False)
    overwrite_partitions(target_rows(spark, [3, 4], 60), path)
    return path


def test_only_fragmented_dates_are_written_anew(spark):
    path = fragmented(spark, "compact")
    before, rows = files(path), contents(spark, path)
    assert {len(v) for d, v in before.items() if d[-1] in "12"} == {6}
    assert compact.compact_dates(spark, path) == [date(2024, 1, 1), date(2024, 1, 2)]
    after = files(path)
    assert contents(spark, path) == rows
    assert all(len(v) == 1 for v in after.values())
    assert all(after[d] == before[d] for d in after if d[-1] in "34")
    assert compact.compact_dates(spark, path) == [] and files(path) == after
    assert not [n for n in os.listdir(path.removeprefix("file:")) if n.startswith("_compact")]


def test_a_killed_compaction_loses_nothing(spark, monkeypatch):
    path = fragmented(spark, "compact-killed")
    rows, moves, move = contents(spark, path), [], compact._move

    def dying(spark, here, there):
        moves.append(here)
        if len(moves) == 2:
            raise KeyboardInterrupt
        move(spark, here, there)

    monkeypatch.setattr(compact, "_move", dying)
    with pytest.raises(KeyboardInterrupt):
        compact.compact_dates(spark, path)
    assert len(files(path)) == 3  # one date is away
    monkeypatch.setattr(compact, "_move", move)
    compact.compact_dates(spark, path)
    assert contents(spark, path) == rows and all(len(v) == 1 for v in files(path).values())


def test_a_target_without_small_files_or_rows(spark):
    path = scratch_path(spark, "compact-none")
    overwrite_partitions(target_rows(spark, [5], 3), path)
    before = files(path)
    assert compact.compact_dates(spark, path) == [] and files(path) == before
    assert compact.fragmented_dates(spark, path, at_least=1) == [date(2024, 1, 5)]
    assert compact.fragmented_dates(spark, path, small_bytes=1, at_least=1) == []


def test_compacted_dates_of_different_columns_keep_them(spark):
    path = scratch_path(spark, "compact-drift")
    overwrite_partitions(target_rows(spark, [1], 40).repartition(5), path, rebalance=False)
    more = target_rows(spark, [2], 40).withColumn("more", F.lit(1)).repartition(5)
    more.write.mode("append").partitionBy("rpt_mst_date").parquet(path)
    assert len(compact.compact_dates(spark, path)) == 2
    got = spark.read.option("mergeSchema", "true").parquet(path).groupBy("rpt_mst_date").agg(F.count("*"), F.count("more")).collect()
    assert sorted(map(tuple, got)) == [(date(2024, 1, 1), 40, 0), (date(2024, 1, 2), 40, 40)]


def grown(*fields):
    base = output_schema(NTZ).fields
    return T.StructType([*base[:-1], *fields, base[-1]])


def test_old_and_new_partitions_are_read_together(spark):
    table, path = f"drift_{uuid.uuid4().hex}", scratch_path(spark, "drift")
    create_target_table(spark, table, path, time_type=NTZ)
    insert_overwrite_by_name(spark, target_rows(spark, [1], 10), table)
    first = grown(T.StructField("chars", T.IntegerType()))
    assert [f.name for f in evolve_table(spark, table, first).added] == ["chars"]
    insert_overwrite_by_name(spark, target_rows(spark, [2], 10).withColumn("chars", F.length("visit_guid")), table)
    second = grown(T.StructField("chars", T.LongType()), T.StructField("amount", T.DecimalType(20, 2)))
    drift = evolve_table(spark, table, second)
    assert [f.name for f in drift.widened] == ["chars"] and [f.name for f in drift.added] == ["amount"]
    big = target_rows(spark, [3], 10).withColumn("chars", F.lit(1 << 40)).withColumn("amount", F.lit(1).cast("decimal(20,2)"))
    insert_overwrite_by_name(spark, big, table)
    want = [(date(2024, 1, 1), 10, 0, None, 0), (date(2024, 1, 2), 10, 10, 2, 0), (date(2024, 1, 3), 10, 10, 1 << 40, 10)]
    for df in (spark.table(table), read_evolved(spark, path, second)):
        got = df.groupBy("rpt_mst_date").agg(F.count("*"), F.count("chars"), F.max("chars"), F.count("amount")).collect()
        assert sorted(map(tuple, got)) == want
    assert not evolve_table(spark, table, second)
    insert_overwrite_by_name(spark, big.where("visit_guid = 'g1'"), table)  # still date by date
    assert spark.table(table).count() == 21
    spark.sql(f"DROP TABLE {table}")


def test_types_that_clash_change_nothing(spark):
    table, path = f"drift_{uuid.uuid4().hex}", scratch_path(spark, "drift-clash")
    create_target_table(spark, table, path, time_type=NTZ)
    before = spark.table(table).schema
    wrong = T.StructType([T.StructField("app_id", T.IntegerType()), T.StructField("new", T.StringType())])
    with pytest.raises(ValueError, match="app_id: string stored, int asked"):
        evolve_table(spark, table, wrong)
    assert spark.table(table).schema == before
    spark.sql(f"DROP TABLE {table}")


def test_what_counts_as_wider():
    have = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("B", T.DateType()), T.StructField("c", T.DecimalType(10, 2)), T.StructField("d", T.LongType())])
    want = T.StructType([T.StructField("d", T.IntegerType()), T.StructField("c", T.DecimalType(10, 4)), T.StructField("b", NTZ), T.StructField("e", T.StringType())])
    drift = compare_schemas(have, want)
    assert [f.name for f in drift.widened] == ["B"] and [f.name for f in drift.added] == ["e"]
    assert drift.only_stored == ["a"] and [x.split(":")[0] for x in drift.clashing] == ["d", "c"]
    assert not compare_schemas(have, have)
