"""The jobs from raw files to exported tables."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyfield.catalog import QUERIES
from tallyfield.operators import clusters, quality
from tallyfield.plans import jobs, schemas as S
from tallyfield.sources import files


@pytest.fixture(scope="module")
def folders(spark, tables, tmp_path_factory):
    """Run all jobs once on tables made from ``orders`` and ``nation``."""
    base = str(tmp_path_factory.mktemp("jobs"))
    raw = tables.raw_incidents()
    raw.write.option("header", True).csv(f"{base}/raw_incidents")
    tables.raw_lookup().write.option("header", True).csv(f"{base}/raw_census")
    weather = tables.read("orders").selectExpr(
        "'cell' AS weather_location",
        "date_format(o_orderdate + make_dt_interval(0, cast(o_custkey % 24 as int)), \"yyyy-MM-dd'T'HH:mm\") AS weather_timestamp",
        "string(o_custkey % 90) AS temperature_2m",
        "'0.1' AS precipitation",
        "'50' AS relative_humidity_2m",
        "string(o_orderkey % 20) AS wind_speed_10m",
        "CASE WHEN o_orderkey % 9 = 0 THEN '61' WHEN o_orderkey % 9 = 1 THEN '71' ELSE '0' END AS weather_code",
    )
    weather.write.option("header", True).csv(f"{base}/raw_weather")
    jobs.prepare_incidents(
        spark,
        f"{base}/raw_incidents",
        f"{base}/facts",
        f"{base}/processed/crime_quality",
        f"{base}/quarantine",
        f"{base}/processed/data_dictionary",
    )
    counts = jobs.prepare_references(
        spark,
        f"{base}/raw_census",
        f"{base}/processed/cleaned_census",
        f"{base}/raw_weather",
        f"{base}/weather",
        f"{base}/processed/weather_quality",
    )
    assert tuple(counts.first()) == (51, 24)
    jobs.explore_job(spark, f"{base}/facts", f"{base}/weather", f"{base}/processed/cleaned_census", f"{base}/explored")
    jobs.cluster_job(spark, f"{base}/facts", f"{base}/clustered")
    jobs.model_job(spark, f"{base}/facts", f"{base}/predicted")
    return base


def read(spark, folders, name):
    return files.read_table(spark, f"{folders}/{name}")


def test_prepared_tables_add_up(spark, folders, tables):
    row = read(spark, folders, "processed/crime_quality").first()
    facts = read(spark, folders, "facts")
    assert row.raw_record_count == tables.raw_incidents().count()
    assert row.clean_record_count == facts.count() == row.distinct_crime_id_count
    assert facts.columns[-2:] == ["year", "district"] and set(facts.columns) == set(S.INCIDENTS.columns)
    quarantine = read(spark, folders, "quarantine")
    rejected = quarantine.filter("rejection_reason LIKE '%invalid_timestamp%'").count()
    assert rejected == row.raw_invalid_timestamp_count
    assert "raw_latitude" in quarantine.columns
    assert read(spark, folders, "processed/data_dictionary").count() == 9


def test_staged_tables_are_gone(spark, folders):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert not any(os.path.exists(f"{shared}/{name}/prepared") for name in os.listdir(shared))


def test_existing_output_is_refused_on_request(spark, folders):
    with pytest.raises(AnalysisException):
        jobs.prepare_incidents(spark, f"{folders}/raw_incidents", f"{folders}/facts", overwrite=False)


def test_weather_quality(spark, folders, tables):
    row = read(spark, folders, "processed/weather_quality").first()
    assert row.raw_weather_record_count == tables.read("orders").count()
    assert row.clean_hourly_weather_count == read(spark, folders, "weather").count()


def test_exploration_tables(spark, folders):
    daily = read(spark, folders, "explored/daily_crime_weather")
    facts = read(spark, folders, "facts")
    assert read(spark, folders, "explored/temporal_patterns").agg(F.sum("crime_count")).first()[0] == facts.count()
    impact = read(spark, folders, "explored/weather_impact")
    assert impact.agg(F.sum("day_count")).first()[0] == daily.count()
    rolling = read(spark, folders, "explored/community_area_rolling")
    assert rolling.count() == 24 * daily.count()
    assert rolling.columns == [
        "weather_date", "community_area", "community_name", "hardship_index", "crime_count",
        "rolling_7_day_crime_average",
    ]
    spatial = read(spark, folders, "explored/community_spatial_patterns")
    counts = [row.crime_count for row in spatial.collect()]
    assert counts == sorted(counts, reverse=True)
    for name in ("weather_correlations", "seasonal_weather_impact", "weekday_weekend_patterns"):
        assert read(spark, folders, f"explored/{name}").count() > 0


def test_cluster_tables(spark, folders):
    facts = read(spark, folders, "facts").filter("has_valid_coordinates")
    summary = read(spark, folders, "clustered/cluster_summary")
    assert summary.agg(F.sum("incident_count")).first()[0] == facts.count()
    assert read(spark, folders, "clustered/stability_scores").count() == 15
    assert read(spark, folders, "clustered/silhouette_scores").count() == 5
    main = read(spark, folders, "clustered/district_alignment")
    assert main.filter("district IS NULL").count() > 0
    assert read(spark, folders, "clustered/district_alignment_k6").filter("district IS NULL").count() == 0
    for name in ("clustered_records", "clustered_records_k6"):
        assert read(spark, folders, f"clustered/{name}").count() == facts.count()


def test_prediction_tables(spark, folders):
    predictions = read(spark, folders, "predicted/predictions")
    assert predictions.columns == ["crime_id", "label", "prediction", "arrest_probability"]
    assert read(spark, folders, "predicted/threshold_metrics").count() == 7
    assert len(read(spark, folders, "predicted/model_comparison").columns) == 14
    for name in ("random_forest_model", "weighted_logistic_regression_model", "weighted_gradient_boosted_trees_model"):
        assert os.path.isdir(f"{folders}/predicted/{name}/stages")


def test_export(spark, folders):
    out = f"{folders}/evidence"
    places = (f"{folders}/processed", f"{folders}/explored", f"{folders}/clustered", f"{folders}/predicted")
    written = jobs.export_job(spark, out, ["task1", "task2", "task3", "task4"], *places)
    assert len(written) == 4 + 9 + 5 + 7
    census = files.read_raw_csv(spark, f"{out}/task1_cleaned_census")
    assert [int(r.community_area) for r in census.collect()] == list(range(1, 25))


def test_exported_results_hold_the_whole_sweep(spark, tmp_path, monkeypatch):
    """Every K and seed of the study is fitted before its scores are exported; the prediction tables are made up."""

    def made_up(spark, facts, folder):
        columns = ["label", "prediction", "model_name", "validation_strategy", "threshold", "importance", "feature"]
        table = spark.range(1).selectExpr(*[f"1 AS {c}" for c in [*columns, "count", "primary_type"]])
        for name in jobs.MODEL_TABLES:
            files.write_table(table, f"{folder}/{name}")

    monkeypatch.setattr(jobs, "model_job", made_up)
    orders = spark.range(1500).selectExpr(
        "id AS o_orderkey",
        "id * 7 % 290 AS o_custkey",
        "element_at(array('F', 'O', 'P'), int(id * 11 % 13 % 3) + 1) AS o_orderstatus",
        "timestamp_ntz '1995-01-01 00:00:00' + make_dt_interval(cast(id * 17 % 2000 as int)) AS o_orderdate",
        "concat(id % 5 + 1, '-KIND') AS o_orderpriority",
    )
    nation = spark.range(25).selectExpr("int(id) AS n_nationkey", "concat('N', id) AS n_name", "int(id % 5) AS n_regionkey")
    customer = spark.range(290).selectExpr("id AS c_custkey", "int(id % 25) AS c_nationkey")
    for name, table in (("orders", orders), ("nation", nation), ("customer", customer)):
        files.write_table(table, f"{tmp_path}/{name}.parquet")
    found = {row.name: row for row in QUERIES["b6_export_results"](spark, str(tmp_path)).collect()}
    assert len(found) == 21 and all(row.same for row in found.values())
    assert found["task3_silhouette_scores"].records == len(clusters.CANDIDATES) == 5
    assert found["task3_stability_scores"].records == len(clusters.CANDIDATES) * len(clusters.SEEDS) == 15


def test_count_rows(spark):
    assert quality.count_rows(spark.range(5), "n").first().n == 5
