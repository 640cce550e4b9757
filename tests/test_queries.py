"""Every registered query on the smallest tables, against its SQL where there is one."""

import pytest

from oracle_compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    if name in ORACLE:
        assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF, need_rows=False) is None
    else:
        assert QUERIES[name](spark, SF).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["src1_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate" in text


def test_versions_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["ded1_latest"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["cre5_windows", "cre6_video_category", "tag15_vote", "liv19_recommend", "mon2_debut"])
def test_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["mkt2_merge", "qc1_drift", "mon1_undefined", "mon3_drift", "mon4_platform"])
def test_market_periods_reach_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
