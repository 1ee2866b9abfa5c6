"""What the plans must and must not contain."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.views import view
from tidewright.operators import enrich, profile
from tidewright.sources import grid

SF = "/root/testdata/sf0.001"
RUNS_AT_ONCE = [n for n in entry.queries() if n.startswith("stream_")] + ["schema_upgrade"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in RUNS_AT_ONCE])
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_statistics_scan_once(static):
    """Counts by value are read twice, from one shuffle."""
    rows = profile.metrics_long(view(static, SF, "catch"), ["species"], ["count", "weight"])
    text = plan(profile.summary(rows, ["species", "metric"]))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_box_is_pushed_to_the_scan(static):
    rows = static.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_acctbal").alias("lat"), F.col("c_custkey").alias("lon"))
    text = plan(grid.in_box(rows, {"lat": (0.0, 10.0)}).select("lon"))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in text and "LessThanOrEqual(c_acctbal,10.0)" in text


def test_large_sides_are_not_broadcast(static):
    """Without a size below the threshold, an enrichment is a shuffled join on both keys."""
    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catch = view(static, SF, "catch")
        daily = catch.groupBy("day", "point").agg(F.max("weight").alias("v"))
        text = plan(enrich.with_conditions(catch, daily, "day", "point", "day", "point", {"v": "v"}))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        static.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_do_not_depend_on_broadcasts(spark):
    """The same rows when every join is shuffled and skewed partitions are split early."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"}
    names = ["enrich_left", "dup_near", "merge_replace", "suitability_30d"]
    usual = {n: sorted(map(str, entry.queries()[n](spark, SF).collect())) for n in names}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for name in names:
            assert sorted(map(str, entry.queries()[name](spark, SF).collect())) == usual[name], name
    finally:
        for key in settings:
            spark.conf.unset(key)
