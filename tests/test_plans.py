"""Physical plans: pruning, pushdown, joins, skew."""

import glob

import pytest
from pyspark.sql import functions as F

from tallyfield.catalog import QUERIES
from tallyfield.operators import explore, series, shares
from tallyfield.sources import files

from conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def facts(spark, tables):
    path = f"{files.scratch_dir(spark)}/facts"
    files.write_partitioned(tables.facts(), path, ["year", "district"])
    return files.read_table(spark, path)


def explained(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_equality_on_partition_keys_prunes(facts, capsys):
    chosen = facts.filter((F.col("year") == 1998) & (F.col("district") == 11)).select("crime_id", "year")
    text = explained(chosen, capsys)
    assert "PartitionFilters: [isnotnull(year" in text and "district" in text.split("PartitionFilters")[1]
    assert "ReadSchema: struct<crime_id:bigint>" in text


def test_range_on_year_prunes_and_flags_are_pushed(facts, capsys):
    kept = facts.filter(F.col("has_valid_community_area") & F.col("year").between(1997, 1998)).select("crime_id")
    text = explained(kept, capsys)
    assert "(year" in text.split("PartitionFilters")[1].split("\n")[0]
    assert "EqualTo(has_valid_community_area,true)" in text


def test_period_prunes_partitions_by_year(facts, tables, capsys):
    bounds = series.period(tables.series_days(), "weather_date")
    text = explained(series.within_period(facts, "incident_timestamp", bounds, "year").select("crime_id"), capsys)
    filters = [line for line in text.split("\n") if "PartitionFilters" in line]
    assert any("year" in line and "Subquery" in line for line in filters)


def test_small_lookup_join_is_broadcast(facts, tables, capsys):
    joined = series.enrich(facts.select("community_area"), tables.lookup(), "community_area")
    assert "BroadcastHashJoin" in explained(joined, capsys)


def test_building_a_lookup_join_starts_no_job(spark):
    context = spark.sparkContext
    context.setJobGroup("lookup", "build only")
    joined = series.enrich(spark.range(50), spark.range(20), "id")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup("lookup") and "ResolvedHint" not in plan(joined)


def test_spatial_shares_need_no_window(spark):
    assert "Window" not in plan(QUERIES["a15_spatial_profile"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["w1_rolling_mean", "a14_area_summary", "a10_effect_sizes", "e3_threshold_metrics",
                                  "e4_roc_curve", "j4_spine", "a2_quality_row", "a18_flag_hotspots"])
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_running_sum_reads_the_steps_once(tables):
    df = shares.prefix_sum(tables.scored().withColumn("n", F.lit(1)), "score", ["n"])
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_share_reads_the_counts_once(tables):
    df = shares.distribution(tables.facts(), "arrest", "share")
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_python_workers_are_not_used(spark):
    for name in ("p13_clean", "a8_condition_impact", "w1_rolling_mean", "e3_threshold_metrics"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "Pandas" not in text


def test_area_summary_aggregates_before_the_join(facts, tables):
    bounds = series.period(tables.series_days(), "weather_date")
    df = explore.area_summary(facts, tables.lookup(), bounds, "community_area", "has_valid_community_area",
                              "incident_timestamp", (1997, 1998), "arrest", ["community_name"], "crime_count")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.index("avg(cast(arrest")


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16kb",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    key = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 4)
    text = F.md5(F.col("id").cast("string"))
    rows = spark.range(0, 200000, 1, 16).select("id", text.alias("text"), key.alias("k"))
    path = str(tmp_path / "hot")
    files.write_partitioned(rows, path, ["k"])
    for key, value in before.items():
        spark.conf.set(key, value)
    sizes = {k: len(glob.glob(f"{path}/k={k}/*.parquet")) for k in range(4)}
    assert sizes[0] > 4 and files.read_table(spark, path).count() == 200000
