"""Plan properties that matter at scale, checked on every registered query."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_cross_or_nested_loop_join(spark, key):
    plan = plan_of(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["kpi_region_month", "kpi_segment_month", "kpi_host_region_month"])
def test_kpi_plans_have_no_expand_and_read_few_columns(spark, key):
    plan = plan_of(E.queries()[key](spark, SF))
    assert "Expand" not in plan  # distinct host counts are plain counts at level 2
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas
    for unused in ("neighbourhood_cleansed", "beds", "minimum_nights", "calendar_last_scraped", "number_of_reviews"):
        assert all(unused not in line for line in schemas)


def test_active_filter_is_pushed_to_the_scan(spark):
    plan = plan_of(E.queries()["active_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(has_availability), EqualTo(has_availability,t)]" in plan


@pytest.mark.parametrize("key", ["load_snapshots", "star_fact", "star_owner", "first_per_key"])
def test_first_per_key_is_an_aggregate_not_a_window(spark, key):
    plan = plan_of(E.queries()[key](spark, SF))
    assert "Window" not in plan
    assert "partial_min" in plan  # combined map-side before the shuffle


def test_moved_set_is_a_two_level_hash_aggregate(spark):
    plan = plan_of(E.queries()["exclude_moved"](spark, SF))
    assert "LeftAnti" in plan
    assert "partial_count(distinct" in plan


def test_median_counts_exchange_is_reused(spark):
    from pyspark.sql import functions as F

    from staykit.operators.median import exact_median

    df = spark.range(2000).select((F.col("id") % 7).alias("g"), (F.col("id") % 101).cast("decimal(12,2)").alias("x"))
    m = exact_median(df, ["g"], "x")
    m.collect()  # run through the frame's own execution, so its final adaptive plan is available
    final = m._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "ReusedExchange" in final
