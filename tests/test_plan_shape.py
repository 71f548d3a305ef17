"""Guards on the physical plan of the job: shuffles, pruning, pushdown."""

import re

from visitmap import DateWindow, build_visit_map
from visitmap.sources import load_inputs

SF = "/root/testdata/sf0.001"
W = DateWindow("1997-01-01", "1998-12-31")


def _initial_plan(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")    # no "..." in scan metadata
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    return re.sub(r"#\d+L?", "", plan)


def _exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)


def test_scheduled_run_shuffles(spark):
    cus, msg = load_inputs(spark, SF)
    plan = _initial_plan(build_visit_map(cus, msg, W, build_ts="2024-02-01"))
    ex = _exchanges(plan)
    # customer -> join, messaging -> dedupe -> join, exploded rows -> dedupe
    assert len(ex) == 4, ex
    assert sum(e == "conversation_id" for e in ex) == 2
    assert sum(e.count(",") == 7 for e in ex) == 1                 # the one wide dedupe, 8 keys
    # Every shuffle of the job is fed by a partial aggregate or is a join input: no
    # dedupe before the explode, no shuffle after the final aggregate.
    assert plan.count("Generate explode") == 1


def test_scans_are_pruned_and_filtered(spark):
    cus, msg = load_inputs(spark, SF)
    plan = _initial_plan(build_visit_map(cus, msg, W, sides="both", build_ts="2024-02-01"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert ("ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double,"
            "l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>") in plan
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan
    assert "LessThanOrEqual(l_shipdate,1998-12-31T00:00)" in plan


def test_no_python_in_the_job(spark):
    cus, msg = load_inputs(spark, SF)
    plan = _initial_plan(build_visit_map(cus, msg, W, build_ts="2024-02-01"))
    assert "Python" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan


def test_sql_form_has_the_same_shuffles(spark):
    from visitmap.plans import build_visit_map_sql

    cus, msg = load_inputs(spark, SF)
    df_plan = _initial_plan(build_visit_map(cus, msg, W, build_ts="2024-02-01"))
    sql_plan = _initial_plan(build_visit_map_sql(spark, cus, msg, W, build_ts="2024-02-01"))
    def keysets(plan):
        return sorted(tuple(sorted(e.split(", "))) for e in _exchanges(plan))

    assert keysets(sql_plan) == keysets(df_plan)
