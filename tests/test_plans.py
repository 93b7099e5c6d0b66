"""Physical-plan properties the design relies on at scale: pruned scans,
pushed filters, partial aggregation and partial top-k before shuffles,
broadcast only where bounded."""

import re

import __spark_entry__ as E


def _plan(df):
    """The executed plan; with AQE only its final part (the string also
    carries the initial plan)."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _scan_schemas(plan):
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan)


def test_rate_more_prunes_columns_and_aggregates_partially(spark, sf_dir):
    df = E.queries()["rate_more"](spark, sf_dir)
    df.collect()
    plan = _plan(df)
    for cols in _scan_schemas(plan):
        assert "l_extendedprice" not in cols and "l_comment" not in cols and "o_totalprice" not in cols
    assert "partial_count" in plan


def test_event_filters_are_pushed_to_the_scan(spark, sf_dir):
    df = E.queries()["recent_ratings"](spark, sf_dir)
    df.collect()
    plan = _plan(df)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,click\)", plan)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_genre_top10_limits_before_the_shuffle(spark, sf_dir):
    df = E.queries()["genre_top10"](spark, sf_dir)
    df.collect()
    plan = _plan(df)
    part = plan.find("WindowGroupLimit")
    assert part >= 0 and ", Partial" in plan and ", Final" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_similarity_runs_one_kernel_and_never_a_cartesian(spark, sf_dir):
    df = E.queries()["item_similarity"](spark, sf_dir)
    df.collect()
    plan = _plan(df)
    assert plan.count("FlatMapCoGroupsInPandas") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_factor_top10_has_no_cartesian(spark, sf_dir):
    df = E.queries()["factor_top10_unseen"](spark, sf_dir)
    df.collect()
    plan = _plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
