"""What is kept beside the target: places of conversations, date prints, the ledger, the reject table, export versions."""

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.prints import add_prints
from visitmap.functions.timefns import parsed_wall_clock, report_date
from visitmap.functions.window import DateWindow
from visitmap.job import parse_args, run
from visitmap.operators import difference_count, differences
from visitmap.plans.ledger import Ledger, slices
from visitmap.plans.moves import Places
from visitmap.plans.rerun import backfill_run, run_window
from visitmap.schemas import OUTPUT_COLS, customer_schema, messaging_schema, output_schema
from visitmap.session import scratch_path
from visitmap.sinks import create_target_table, export_orc, publish_export_table
from visitmap.sinks.files import stored_dates
from visitmap.sinks.prints import DatePrints
from visitmap.sinks.tables import table_location
from visitmap.sinks.target import TableTarget
from visitmap.sources import read_target
from visitmap.sources.rejects import Rejects

NTZ = T.TimestampNTZType()
FIRST = date(2024, 1, 1)


def inputs(spark, days, accounts=None):
    """Conversations by their day (a list: several rows), each with one messaging row; account None where ``accounts`` says so."""
    cus, msg = [], []
    for key, at in days.items():
        for day in at if isinstance(at, list) else [at]:
            ts = datetime(2024, 1, 1, 12) + timedelta(days=day)
            cus.append((key, ts, ts, ts, [f"g{key}"[:2]]))
        msg.append((key, None if accounts and accounts.get(key, 0) is None else 7, "app", "web", None, None))
    return spark.createDataFrame(cus, customer_schema(NTZ)), spark.createDataFrame(msg, messaging_schema(NTZ))


def window(a, b):
    return DateWindow(FIRST + timedelta(days=a), FIRST + timedelta(days=b), "report_days")


def rows(spark, path):
    return sorted((tuple(r)[:8] + (r.rpt_mst_date,) for r in read_target(spark, path, NTZ).collect()), key=repr)


def whole(spark, days, accounts, a, b):
    path = scratch_path(spark, "whole")
    run_window(*inputs(spark, days, accounts), window(a, b), path, build_ts="2024-02-01")
    return rows(spark, path)


def test_moved_conversations_go_from_their_old_date(spark):
    old = {"c1": 0, "c2": 0, "c3": 1, "c4": 20, "c5": [0, 21], "n1": 0, "n2": 0, "n3": 2}
    new = {"c1": 20, "c2": 0, "c3": 21, "c4": 20, "c5": [0, 22], "n1": 23, "n2": 0, "n3": 23}
    accounts = {"n1": None, "n2": None, "n3": None}
    path, places = scratch_path(spark, "moved"), Places(scratch_path(spark, "places"))
    run_window(*inputs(spark, old, accounts), window(0, 25), path, build_ts="2024-02-01", places=places)
    done = run_window(*inputs(spark, new, accounts), window(15, 25), path, build_ts="2024-02-02", places=places)
    assert rows(spark, path) == whole(spark, new, accounts, 0, 25)
    # c2 and n2 (whose row equals n1's old one) stay on day 0 with their stamp; days 1 and 2 are empty now.
    day0 = read_target(spark, path, NTZ).where(F.col("rpt_mst_date") == FIRST).collect()
    assert {r.etl_build_mst_ts for r in day0} == {datetime(2024, 2, 1)} and len(day0) == 3
    assert done.emptied == [FIRST + timedelta(days=d) for d in (1, 2)] and FIRST in done.written
    kept = {(r.conversation_id, r.rpt_mst_date) for r in places.read(spark).collect()}
    assert kept == {(k, FIRST + timedelta(days=d)) for k, at in new.items() for d in (at if isinstance(at, list) else [at])}
    # Nothing moves in a second run of the same input.
    run_window(*inputs(spark, new, accounts), window(15, 25), path, build_ts="2024-02-03", places=places)
    assert rows(spark, path) == whole(spark, new, accounts, 0, 25)


def test_random_moves_equal_one_run_over_the_last_input(spark):
    rng = random.Random(11)
    days = {f"c{i}": rng.randint(0, 12) for i in range(25)}
    accounts = {f"c{i}": None for i in range(0, 25, 6)}
    path, places, prints = scratch_path(spark, "moves"), Places(scratch_path(spark, "places")), DatePrints(scratch_path(spark, "prints"))
    run_window(*inputs(spark, days, accounts), window(0, 12), path, build_ts="2024-02-01", places=places, prints=prints)
    for a in (4, 8):
        # Into the window from anywhere; out of it only to a later day, which its own run covers.
        days = {k: rng.randint(a, a + 4) if rng.random() < 0.4 else d for k, d in days.items()}
        run_window(*inputs(spark, days, accounts), window(a, a + 4), path, build_ts="2024-02-02", places=places, prints=prints)
        assert rows(spark, path) == whole(spark, days, accounts, 0, 12)


def test_places_with_a_catalog_target(spark):
    table = f"moved_{uuid.uuid4().hex}"
    create_target_table(spark, table, scratch_path(spark, "moved-table"), time_type=NTZ)
    places = Places(scratch_path(spark, "places"))
    run_window(*inputs(spark, {"a": 0, "b": 1}), window(0, 5), TableTarget(table), places=places)
    run_window(*inputs(spark, {"a": 4, "b": 1}), window(3, 5), TableTarget(table), places=places)
    assert sorted((r.parent_contact_id, r.rpt_mst_date) for r in spark.table(table).collect()) == [("7-a", FIRST + timedelta(days=4)), ("7-b", FIRST + timedelta(days=1))]
    assert stored_dates(spark, table_location(spark, table)) == [FIRST + timedelta(days=1), FIRST + timedelta(days=4)]


def files_of(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def test_an_unchanged_rerun_writes_no_file(spark):
    days = {f"c{i}": i % 4 for i in range(12)}
    path, prints = scratch_path(spark, "same"), DatePrints(scratch_path(spark, "prints"))
    first = run_window(*inputs(spark, days), window(0, 5), path, build_ts="2024-02-01", prints=prints)
    before = files_of(spark, path)
    again = run_window(*inputs(spark, days), window(0, 5), path, build_ts="2024-02-02", prints=prints)
    assert len(first.written) == 4 and again.written == [] and again.emptied == [] and again.unchanged == first.written
    assert files_of(spark, path) == before
    days["c1"], days["c2"] = 0, 0
    days.pop("c3"), days.pop("c7"), days.pop("c11")
    third = run_window(*inputs(spark, days), window(0, 5), path, build_ts="2024-02-03", prints=prints)
    assert third.emptied == [FIRST + timedelta(days=3)] and set(third.written) == {FIRST + timedelta(days=d) for d in (0, 1, 2)}
    assert rows(spark, path) == whole(spark, days, None, 0, 5)


def test_a_date_without_its_print_is_written_again(spark):
    days = {"a": 0, "b": 1}
    path, prints = scratch_path(spark, "cut"), DatePrints(scratch_path(spark, "prints"))
    run_window(*inputs(spark, days), window(0, 2), path, build_ts="2024-02-01", prints=prints)
    prints.forget(spark, [FIRST])  # as a run leaves it that is cut off while it writes
    assert run_window(*inputs(spark, days), window(0, 2), path, build_ts="2024-02-02", prints=prints).written == [FIRST]


def test_prints_tell_nulls_and_nested_values_apart(spark):
    df = spark.createDataFrame([("a", None, ["x", None]), (None, "a", ["x", None]), ("a", None, ["x"]), ("a", None, None), ("a", None, [])], "a string, b string, c array<string>")
    assert add_prints(df, ["a", "b", "c"]).select("print_a", "print_b").distinct().count() == 5


def test_resumed_backfill(spark):
    days = {f"c{i}": i for i in range(10)}
    cus, msg = inputs(spark, days)
    path, ledger = scratch_path(spark, "history"), Ledger(scratch_path(spark, "ledger"))
    end = FIRST + timedelta(days=10)

    class Cut(Ledger):
        def done(self, *a):
            super().done(*a)
            if self.read(spark).count() == 2:
                raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        backfill_run(cus, msg, path, as_of=end, start=FIRST, ledger=Cut(ledger.path), slice_days=3, build_ts="2024-02-01")
    assert stored_dates(spark, path) == [FIRST + timedelta(days=i) for i in range(6)]
    backfill_run(cus, msg, path, as_of=end, start=FIRST, ledger=ledger, slice_days=4, build_ts="2024-02-02")
    assert rows(spark, path) == whole(spark, days, None, 0, 9)
    stamps = {r.rpt_mst_date: r.etl_build_mst_ts for r in read_target(spark, path, NTZ).collect()}
    # Slices of another length: those wholly done are left out, the one that isn't is written as a whole.
    assert [stamps[FIRST + timedelta(days=i)].day for i in range(10)] == [1] * 4 + [2] * 6
    before = files_of(spark, path)
    backfill_run(cus, msg, path, as_of=end, start=FIRST, ledger=ledger, slice_days=4)
    assert files_of(spark, path) == before
    assert [(w.start.day, w.end.day) for w in slices(window(0, 9), 4)] == [(1, 4), (5, 8), (9, 10)]


def text_inputs(spark):
    good = "2024-01-02 12:00:00"
    cus = [("a", good, good, good, ["x"]), ("b", good, good, "n/a", []), ("c", "soon", "", good, None), ("d", None, good, "2024-01-02T21:30:00-07:00", None),
           ("e", "bad but outside", good, "2024-03-01", None), ("f", good, good, None, None)]
    msg = [(k, 1, "app", "web", None) for k in "abcdef"]
    return (spark.createDataFrame(cus, T.StructType([T.StructField(f.name, T.StringType() if f.dataType == NTZ else f.dataType) for f in customer_schema(NTZ)])),
            spark.createDataFrame(msg, T.StructType(messaging_schema(NTZ).fields[:5])))


def test_bad_times_go_to_the_reject_table(spark):
    cus, msg = text_inputs(spark)
    path, rejects = scratch_path(spark, "good"), Rejects(scratch_path(spark, "rejects"))
    for _ in range(2):  # a second run replaces its rows
        run_window(cus, msg, window(0, 5), path, rejects=rejects)
        found = sorted((r.conversation_id, r.column, r.value, r.run_date) for r in rejects.read(spark).collect())
        day = FIRST + timedelta(days=5)
        assert found == [("b", "conversation_end_utc_date", "n/a", day), ("c", "conversation_end_utc_ts", "", day), ("c", "conversation_start_utc_ts", "soon", day)]
    assert rejects.counts["customer"] == {"good": 2, "bad": 2, "conversation_start_utc_ts": 1, "conversation_end_utc_ts": 1, "conversation_end_utc_date": 1}
    assert sorted((r.parent_contact_id, r.rpt_mst_date) for r in read_target(spark, path, NTZ).collect()) == [("1-a", FIRST + timedelta(days=1)), ("1-d", FIRST + timedelta(days=1))]
    good = cus.where("conversation_id in ('a', 'd')")
    run_window(good, msg, window(0, 5), path, rejects=rejects)  # no bad rows: the old ones go
    assert rejects.read(spark).count() == 0
    with pytest.raises(Exception, match="not a time: n/a"):
        run_window(cus, msg, window(0, 5), scratch_path(spark, "strict"))


def test_typed_times_are_passed_through(spark):
    cus, msg = inputs(spark, {"a": 0})
    rejects = Rejects(scratch_path(spark, "none"))
    assert rejects.sort_out(cus, "customer", window(0, 1)).count() == 1 and rejects.counts == {"customer": {}}


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_window_and_report_date_agree_for_every_type(spark, zone, kind):
    texts = ["2024-01-10 06:59:59", "2024-01-10 07:00:00", "2024-01-11 06:59:59.999", "2024-01-11 10:00:00+09:00", "2024-01-10 01:00:00-07:00",
             "2024-01-10 23:30:00-07:00", "2024-01-10T08:00:00Z", "2024-01-11 08:00:00 Asia/Tokyo", "2024-01-10", "2024-01-11", None]
    for tz in ("UTC", "Asia/Tokyo", "America/New_York"):
        with zone(tz):
            df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parsed_wall_clock(F.col("t")).alias("v"))
            value = F.col("t") if kind == "string" else F.col("v").cast("date") if kind == "date" else F.col("v") if kind == "timestamp_ntz" else F.to_utc_timestamp(
                F.col("v").cast("timestamp"), "UTC")
            df = df.select(value.alias("x"))
            kind_of = df.schema["x"].dataType
            day = date(2024, 1, 10)
            got = df.select(DateWindow(day, day, "report_days").predicate(F.col("x"), kind_of).alias("inside"), report_date(F.col("x"), kind_of).alias("d")).collect()
            assert all(bool(r.inside) == (r.d == day) for r in got)


def sample_rows(spark, n):
    ts = datetime(2024, 1, 1, 12)
    return spark.createDataFrame([(f"k{i}", ts, ts, ts, "app", "SMS", None, f"v{i}", ts, ts.date()) for i in range(n)], output_schema(NTZ))


def test_a_failing_export_leaves_the_old_one(spark):
    path, table, root = scratch_path(spark, "orc"), f"x_{uuid.uuid4().hex}", scratch_path(spark, "versions")
    failing = sample_rows(spark, 3).withColumn("visit_guid", F.raise_error(F.lit("stop")).cast("string"))
    export_orc(sample_rows(spark, 3), path)
    with pytest.raises(Exception, match="stop"):
        export_orc(failing, path)
    assert spark.read.orc(path).count() == 3
    export_orc(sample_rows(spark, 5), path)
    assert spark.read.orc(path).count() == 5 and spark.read.orc(path).columns == OUTPUT_COLS
    with pytest.raises(Exception, match="stop"):
        publish_export_table(spark, failing, table, root)
    assert not spark.catalog.tableExists(table)
    first = publish_export_table(spark, sample_rows(spark, 3), table, root)
    with pytest.raises(Exception, match="stop"):
        publish_export_table(spark, failing, table, root)
    assert spark.table(table).count() == 3 and table_location(spark, table).endswith(first.rsplit("/", 1)[-1])
    second = publish_export_table(spark, sample_rows(spark, 4), table, root)
    assert spark.table(table).count() == 4 and spark.read.orc(first).count() == 3  # the last version stays for its readers
    publish_export_table(spark, sample_rows(spark, 2), table, root)
    assert spark.table(table).count() == 2 and spark.read.orc(second).count() == 4
    with pytest.raises(Exception):
        spark.read.orc(first).count()


def test_differences_count_rows(spark):
    kind = "a int, b string, c array<int>"
    left = spark.createDataFrame([(1, "x", [1]), (1, "x", [1]), (2, None, None), (3, "y", [None]), (4, "z", [])], kind)
    right = spark.createDataFrame([(1, "x", [1]), (2, None, None), (3, "y", []), (4, "z", [])], kind).select("c", "b", "a")
    got = sorted((r.a, r.b, r.c, r.n_left, r.n_right) for r in differences(left, right).collect())
    assert got == [(1, "x", [1], 2, 1), (3, "y", [], 0, 1), (3, "y", [None], 1, 0)]
    assert difference_count(left, right) == 3 and difference_count(left, left) == 0 and difference_count(left.limit(0), left.limit(0)) == 0
    for wrong in (right.drop("a"), right.withColumn("a", F.col("a").cast("long"))):
        with pytest.raises(ValueError):
            differences(left, wrong)
    with pytest.raises(ValueError):
        differences(left.withColumn("n_left", F.lit(1)), right.withColumn("n_left", F.lit(1)))


def test_job_with_everything_kept(spark):
    cus, msg = text_inputs(spark)
    cus_path, msg_path, target = (scratch_path(spark, x) for x in ("j-cus", "j-msg", "j-target"))
    cus.write.parquet(cus_path)
    msg.write.parquet(msg_path)
    kept = {x: scratch_path(spark, x) for x in ("places", "prints", "rejects", "ledger")}
    argv = ["--customer", cus_path, "--messaging", msg_path, "--target-path", target, "--as-of", "2024-01-07", "--build-ts", "2024-02-01", "--backfill", "--history-start", "2024-01-01",
            "--places-path", kept["places"], "--prints-path", kept["prints"], "--reject-path", kept["rejects"], "--ledger-path", kept["ledger"], "--slice-days", "3"]
    run(spark, parse_args(argv))
    assert read_target(spark, target, NTZ).count() == 2 and Ledger(kept["ledger"]).read(spark).count() == 2
    for wrong in (["--window-mode", "closed"], ):
        with pytest.raises(SystemExit):
            parse_args(argv + wrong)
    with pytest.raises(SystemExit):
        parse_args([a for a in argv if a != "--backfill"])
