"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from tools.check_oracles import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._ORACLES)
    assert set(E._QUERIES) <= set(E.queries())


def test_query_time_clock_is_read_when_the_plan_runs(spark):
    import time

    from visitmap.operators import add_query_clock

    df = add_query_clock(spark.range(3).repartition(3))
    # Two queries on one plan.
    first = {r.query_ts for r in df.where("id >= 0").collect()}
    time.sleep(0.01)
    second = {r.query_ts for r in df.where("id >= 0").collect()}
    assert len(first) == len(second) == 1 and first.pop() < second.pop()


@pytest.mark.parametrize("name", sorted(E._ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["cols"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows"] == r["oracle_rows"]
    assert r["values"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "parent_contact_id"
    assert df.count() > 0


@pytest.mark.parametrize("name", ["q17_visit_map_left_window", "q30_scheduled_window"])
def test_flagship_matches_oracle_at_gate_scale(spark, name):
    """The driver's correctness gate runs at sf0.01; check the flagship there too."""
    sf = "/root/testdata/sf0.01"
    r = compare(spark, duck(sf), name, E.queries()[name], E.oracle_sql()[name], sf)
    assert r["cols"] and r["values"] and r["rows"] == r["oracle_rows"] > 0
