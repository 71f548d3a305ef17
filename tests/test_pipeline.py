from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import brute
from visitmap import DateWindow, build_visit_map
from visitmap.schemas import OUTPUT_COLS
from visitmap.sources import load_inputs

SF = "/root/testdata/sf0.001"
NTZ = T.TimestampNTZType()
W = DateWindow("1997-01-01", "1998-12-31")

CUS = T.StructType([
    T.StructField("conversation_id", T.StringType()),
    T.StructField("conversation_start_utc_ts", NTZ),
    T.StructField("conversation_end_utc_ts", NTZ),
    T.StructField("conversation_end_utc_date", NTZ),
    T.StructField("visit_guids", T.ArrayType(T.StringType())),
])
MSG = T.StructType([
    T.StructField("conversation_id", T.StringType()),
    T.StructField("account_id", T.IntegerType()),
    T.StructField("visitor_app_id", T.StringType()),
    T.StructField("conversation_source", T.StringType()),
    T.StructField("visitor_device_type", T.StringType()),
    T.StructField("conversation_end_utc_date", NTZ),
])
KEY_COLS = OUTPUT_COLS[:8] + ["rpt_mst_date"]


def _as_set(df):
    return {tuple(r) for r in df.select(*KEY_COLS).collect()}


def test_output_contract(spark):
    cus, msg = load_inputs(spark, SF)
    out = build_visit_map(cus, msg, W, build_ts="2024-02-01")
    assert out.columns == OUTPUT_COLS
    assert out.schema["rpt_mst_date"].dataType == T.DateType()
    assert out.schema["etl_build_mst_ts"].dataType == NTZ


def test_one_sided_contains_two_sided(spark):
    cus, msg = load_inputs(spark, SF)
    left = build_visit_map(cus, msg, W, sides="left", build_ts="2024-02-01")
    both = build_visit_map(cus, msg, W, sides="both", build_ts="2024-02-01")
    assert both.count() < left.count()
    assert both.exceptAll(left).count() == 0


def test_prededupe_is_exact(spark):
    cus, msg = load_inputs(spark, SF)
    base = build_visit_map(cus, msg, W, build_ts="2024-02-01", prededupe="none")
    for mode in ("auto", "messaging", "both", True, False):
        other = build_visit_map(cus, msg, W, build_ts="2024-02-01", prededupe=mode)
        assert other.exceptAll(base).count() == 0 and base.exceptAll(other).count() == 0, mode


def test_runtime_bloom_filter_prunes_messaging_scan(spark):
    """Default plan: the windowed customer keys filter the messaging scan."""
    cus, msg = load_inputs(spark, SF)
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        small = DateWindow("1997-01-01", "1997-01-11")
        plan = build_visit_map(cus, msg, small)._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan          # "auto" keeps the customer side a plain scan here
        plan = build_visit_map(cus, msg, small, prededupe="both")._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_slice_run_filters_whatever_the_customer_tables_size_estimate(spark):
    """The scheduled run over its slice plans the filter with the gate far under the table's estimate."""
    from visitmap.plans import scheduled_visit_map
    from visitmap.session import apply

    cus, msg = load_inputs(spark, SF)
    df, sized = scheduled_visit_map(spark, cus, msg, DateWindow("1997-01-01", "1997-01-11"), build_ts="2024-02-01")
    gate = {"spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "30k"}
    table = cus._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(table)) > 30 * 1024
    with apply(spark, {**sized, **gate}):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "might_contain" in plan
    n = df.where("parent_contact_id is not null").count()
    assert n and int(sized["spark.sql.optimizer.runtime.bloomFilter.expectedNumItems"]) < 400
    other = build_visit_map(cus, msg, DateWindow("1997-01-01", "1997-01-11"), build_ts="2024-02-01")
    assert df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0


def test_slice_run_with_many_copies_on_both_sides(spark):
    """Copies times distinct rows of one conversation are never built: the slice has each row once."""
    from visitmap.plans import scheduled_visit_map

    t = datetime(2024, 1, 10, 12)
    cus = spark.createDataFrame([("hot", t, t, t, ["a"])] * 400, CUS)
    msg = spark.createDataFrame([("hot", i, "app", "SMS", None, t) for i in range(400)], MSG)
    df, sized = scheduled_visit_map(spark, cus, msg, DateWindow("2024-01-01", "2024-01-31"), build_ts="2024-02-01")
    assert sized["spark.sql.optimizer.runtime.bloomFilter.expectedNumItems"] == "1"
    assert df.count() == 400


def test_only_matched_conversations_appear(spark):
    cus, msg = load_inputs(spark, SF)
    out = build_visit_map(cus, msg, W, build_ts="2024-02-01")
    ids = out.select(F.split("parent_contact_id", "-", 2).getItem(1).alias("conversation_id")).distinct()
    assert ids.join(msg.select("conversation_id").distinct(), "conversation_id", "left_anti").count() == 0
    assert ids.join(W.apply(cus, "conversation_end_utc_date").select("conversation_id"),
                    "conversation_id", "left_anti").count() == 0


def test_hot_key_of_copies(spark):
    """A third of each side is copies of one conversation; the answer stays exact and small."""
    t = datetime(2024, 1, 10, 12)
    cus_rows = [("hot", t, t, t, ["a", "b"])] * 300 + [(f"c{i}", t, t, t, [f"g{i}"]) for i in range(600)]
    msg_rows = [("hot", 1, "app", "SMS", None, t)] * 300 + [(f"c{i}", 2, "app", "SMS", "Desktop", t)
                                                              for i in range(600)]
    cus = spark.createDataFrame(cus_rows, CUS)
    msg = spark.createDataFrame(msg_rows, MSG)
    expected = brute.visit_map(cus_rows, msg_rows)
    for mode in ("auto", "messaging", "both"):
        out = build_visit_map(cus, msg, None, build_ts="2024-02-01", prededupe=mode)
        assert _as_set(out) == expected
        assert out.count() == len(expected)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # Deduped inputs are partial-aggregated in the map task before their shuffle.
        assert plan.count("HashAggregate") >= (4 if mode == "messaging" else 6)


def test_window_sides_against_brute_force(spark):
    cus, msg = load_inputs(spark, SF)
    cus_rows = [tuple(r) for r in cus.collect()]
    msg_rows = [tuple(r) for r in msg.collect()]
    lo, hi = datetime(1997, 1, 1), datetime(1998, 12, 31)
    for sides in ("left", "both"):
        out = build_visit_map(cus, msg, W, sides=sides, build_ts="2024-02-01")
        assert _as_set(out) == brute.visit_map(cus_rows, msg_rows, lo, hi, both=sides == "both"), sides


_ids = st.sampled_from(["c1", "c2", "c3", None])
_guid = st.sampled_from(["a", "b", " a", None])
_day = st.sampled_from([datetime(2024, 1, 8, 23), datetime(2024, 1, 9), datetime(2024, 1, 9, 6, 59),
                        datetime(2024, 1, 9, 7), datetime(2024, 1, 11, 23), datetime(2024, 1, 12),
                        datetime(2024, 1, 12, 10), datetime(2024, 1, 13, 6, 59), datetime(2024, 1, 13, 7),
                        None])
_cus_row = st.tuples(_ids, st.just(datetime(2024, 1, 1)), st.just(datetime(2024, 1, 2)), _day,
                     st.one_of(st.none(), st.lists(_guid, max_size=3)))
_msg_row = st.tuples(_ids, st.sampled_from([1, 22, None]), st.sampled_from(["app", "web"]),
                     st.just("SMS"), st.sampled_from(["Desktop", None]), _day)


# (mode, low bound, high bound, high inclusive) of the window 2024-01-09 .. 2024-01-12
_MODES = {
    "closed": (datetime(2024, 1, 9), datetime(2024, 1, 12), True),
    "whole_days": (datetime(2024, 1, 9), datetime(2024, 1, 13), False),
    "report_days": (datetime(2024, 1, 9, 7), datetime(2024, 1, 13, 7), False),
}


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cus_rows=st.lists(_cus_row, max_size=8), msg_rows=st.lists(_msg_row, max_size=8),
       both=st.booleans(), mode=st.sampled_from(sorted(_MODES)),
       prededupe=st.sampled_from(["auto", "messaging", "both", "none"]))
def test_random_inputs_against_brute_force(spark, cus_rows, msg_rows, both, mode, prededupe):
    cus = spark.createDataFrame(cus_rows, CUS)
    msg = spark.createDataFrame(msg_rows, MSG)
    w = DateWindow("2024-01-09", "2024-01-12", mode)
    out = build_visit_map(cus, msg, w, sides="both" if both else "left", build_ts="2024-02-01",
                          prededupe=prededupe)
    lo, hi, hi_closed = _MODES[mode]
    assert _as_set(out) == brute.visit_map(cus_rows, msg_rows, lo, hi, both, hi_closed)
    assert out.count() == len(_as_set(out))


def test_sql_form_equals_dataframe_form(spark):
    from pyspark.testing import assertDataFrameEqual, assertSchemaEqual

    from visitmap.plans import build_visit_map_sql

    cus, msg = load_inputs(spark, SF)
    a = build_visit_map(cus, msg, W, build_ts="2024-02-01")
    b = build_visit_map_sql(spark, cus, msg, W, build_ts="2024-02-01")
    assertSchemaEqual(a.schema, b.schema)
    assertDataFrameEqual(a, b)
    # Auto-named views are not left behind in the session.
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("visitmap_") and t.isTemporary]
