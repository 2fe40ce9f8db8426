"""Queries that run a whole job on derived raw files and compare every table it wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.digest import table_digest
from ..plans import jobs, schemas as S
from ..sources import files
from .clustering import INPUT_SQL
from .explore import (
    AREA_BODY,
    CORRELATION_BODY,
    DENSE_SQL,
    EFFECT_BODY,
    PATTERNS_BODY,
    ROLLING_BODY,
    SEASONAL_BODY,
    SPATIAL_BODY,
    WEEKDAY_BODY,
)
from .modeling import COMPARED_SQL, SPEC, recomputed, sums_to_one
from .prepare import DICTIONARY_SQL, PREPARED_COLUMNS, QUALITY_BODY, REASON_SQL, SERIES_QUALITY_BODY
from .registry import query
from .standins import (
    CONDITIONS_SQL,
    FACTS_SQL,
    HOURLY_WEATHER_SQL,
    JOINED_DAYS_SQL,
    LOOKUP_SQL,
    PREPARED_SQL,
    Tables,
    digest_sql,
)


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def prepared_incidents(t: Tables, folder: str) -> str:
    raw = _write_csv(t.raw_incidents(), f"{folder}/raw_incidents")
    jobs.prepare_incidents(
        t.spark,
        raw,
        f"{folder}/facts",
        f"{folder}/processed/crime_quality",
        f"{folder}/processed/quarantine",
        f"{folder}/processed/data_dictionary",
    )
    return f"{folder}/facts"


def prepared_references(t: Tables, folder: str, raw_weather: DataFrame) -> DataFrame:
    return jobs.prepare_references(
        t.spark,
        _write_csv(t.raw_lookup(), f"{folder}/raw_census"),
        f"{folder}/processed/cleaned_census",
        _write_csv(raw_weather, f"{folder}/raw_weather"),
        f"{folder}/weather",
        f"{folder}/processed/weather_quality",
    )


def order_weather(t: Tables) -> DataFrame:
    """All-text observations at the hours of ``facts``; rain and snow by order key."""
    return t.read("orders").selectExpr(
        "'cell' AS weather_location",
        """date_format(o_orderdate + make_dt_interval(0, cast(o_custkey % 24 as int)), "yyyy-MM-dd'T'HH:mm")
           AS weather_timestamp""",
        "string(o_custkey % 90) AS temperature_2m",
        "CASE WHEN o_orderkey % 9 = 0 THEN '0.1' ELSE '0.0' END AS precipitation",
        "string(o_custkey % 100) AS relative_humidity_2m",
        "string(o_orderkey % 20) AS wind_speed_10m",
        """CASE WHEN o_orderkey % 9 = 0 THEN '61' WHEN o_orderkey % 9 = 1 THEN '71' ELSE '0' END AS weather_code""",
    )


def digests(spark, tables: dict[str, DataFrame]) -> DataFrame:
    """The digests of some tables, one row each."""
    return reduce(DataFrame.unionByName, [table_digest(df, name) for name, df in tables.items()])


def digests_sql(ctes: str, tables: dict[str, str]) -> str:
    """SQL twin of ``digests``, from common table expressions and a query for each table."""
    return f"WITH {ctes} " + " UNION ALL ".join(digest_sql(name, sql) for name, sql in tables.items())


FACT_COLUMNS = ", ".join(S.INCIDENTS.columns)
PREPARED_TABLES = {
    "facts": f"SELECT {FACT_COLUMNS} FROM cleaned",
    "crime_quality": QUALITY_BODY,
    "quarantine": f"""SELECT {PREPARED_COLUMNS}, {REASON_SQL} AS rejection_reason FROM prepared
                      WHERE NOT (has_valid_crime_id AND has_valid_timestamp)""",
    "data_dictionary": DICTIONARY_SQL,
}
HOURLY_SELECT = f"SELECT {', '.join(S.HOURLY_COLUMNS)} FROM hourly"
LOOKUP_SELECT = f"SELECT {', '.join(S.AREAS.columns)} FROM lookup"
REFERENCE_TABLES = {
    "cleaned_census": LOOKUP_SELECT,
    "weather": HOURLY_SELECT,
    "weather_quality": SERIES_QUALITY_BODY,
    "counts": """SELECT (SELECT 2 * count(*) + 1 FROM nation) AS raw_census_record_count,
                 (SELECT count(*) FROM lookup) AS clean_community_area_count""",
}


@query("b1_prepare_incidents", digests_sql(PREPARED_SQL, PREPARED_TABLES))
def b1_prepare_incidents(t: Tables):
    """All written tables; of the quarantine the typed columns and the reason."""
    folder = files.scratch_dir(t.spark)
    prepared_incidents(t, folder)
    read = lambda name: files.read_table(t.spark, f"{folder}/{name}")
    return digests(
        t.spark,
        {
            "facts": read("facts").select(*S.INCIDENTS.columns),
            "crime_quality": read("processed/crime_quality"),
            "quarantine": read("processed/quarantine").select(*PREPARED_COLUMNS.split(", "), "rejection_reason"),
            "data_dictionary": read("processed/data_dictionary"),
        },
    )


@query("b2_prepare_references", digests_sql(f"{HOURLY_WEATHER_SQL}, {LOOKUP_SQL}", REFERENCE_TABLES))
def b2_prepare_references(t: Tables):
    """All written tables, and the counts that the job returns."""
    folder = files.scratch_dir(t.spark)
    counts = prepared_references(t, folder, t.raw_weather())
    tables = {
        name: files.read_table(t.spark, f"{folder}/{path}")
        for name, path in (
            ("cleaned_census", "processed/cleaned_census"), ("weather", "weather"), ("weather_quality", "processed/weather_quality"),
        )
    }
    return digests(t.spark, {**tables, "counts": counts})


ORDER_HOURLY_SQL = """
hourly AS (
  SELECT (o_orderdate + to_hours((o_custkey % 24)::INTEGER))::DATE AS weather_date,
         (o_custkey % 24)::INTEGER AS weather_hour, 'cell' AS weather_station,
         avg(o_custkey % 90) AS average_temperature_f, max((o_orderkey % 9 = 0)::INTEGER) / 10 AS hourly_precipitation_inches,
         avg(o_custkey % 100) AS average_relative_humidity, avg(o_orderkey % 20) AS average_wind_speed_mph,
         max((o_orderkey % 9 IN (0, 1))::INTEGER) AS has_reported_weather_event, max((o_orderkey % 9 = 0)::INTEGER) AS has_rain,
         max((o_orderkey % 9 = 1)::INTEGER) AS has_snow, 0 AS has_thunderstorm,
         max((o_orderkey % 9 = 0)::INTEGER) AS has_precipitation
  FROM orders GROUP BY 1, 2)"""
EXPLORED_SQL = f"""{FACTS_SQL}, {LOOKUP_SQL}, {ORDER_HOURLY_SQL}, {JOINED_DAYS_SQL}, {CONDITIONS_SQL}, {DENSE_SQL},
located AS (SELECT * FROM facts WHERE has_valid_community_area
            AND incident_timestamp::DATE BETWEEN (SELECT min(weather_date) FROM daily) AND (SELECT max(weather_date) FROM daily))"""
EXPLORED_TABLES = {
    "daily_crime_weather": "SELECT * FROM daily",
    "temporal_patterns": PATTERNS_BODY,
    "weather_impact": "SELECT * FROM impact",
    "seasonal_weather_impact": SEASONAL_BODY,
    "weather_effect_sizes": EFFECT_BODY,
    "weekday_weekend_patterns": WEEKDAY_BODY,
    "weather_correlations": CORRELATION_BODY,
    "community_area_rolling": ROLLING_BODY,
    "community_socioeconomic": AREA_BODY.format(*S.CENSUS_YEARS),
    "community_spatial_patterns": SPATIAL_BODY,
}


def explored(t: Tables, folder: str) -> str:
    files.write_partitioned(t.facts(), f"{folder}/facts", ["year", "district"])
    prepared_references(t, folder, order_weather(t))
    jobs.explore_job(
        t.spark, f"{folder}/facts", f"{folder}/weather", f"{folder}/processed/cleaned_census", f"{folder}/explored"
    )
    return f"{folder}/explored"


@query("b3_explore", digests_sql(EXPLORED_SQL, EXPLORED_TABLES))
def b3_explore(t: Tables):
    """All ten written tables."""
    path = explored(t, files.scratch_dir(t.spark))
    return digests(t.spark, {name: files.read_table(t.spark, f"{path}/{name}") for name in EXPLORED_TABLES})


@query(
    "b4_cluster",
    f"""WITH {INPUT_SQL}, counts AS (SELECT count(*) AS records, count(district) AS known FROM input)
        SELECT unnest(['clustered_records', 'clustered_records_k6', 'cluster_summary', 'district_alignment']) AS name,
               records FROM counts
        UNION ALL SELECT 'district_alignment_k6', known FROM counts
        UNION ALL SELECT 'silhouette_scores', 5 UNION ALL SELECT 'stability_scores', 15""",
)
def b4_cluster(t: Tables):
    """Every written table with the incidents it holds, or its rows where they are no incidents."""
    folder = files.scratch_dir(t.spark)
    files.write_table(t.facts(), f"{folder}/facts")
    jobs.cluster_job(t.spark, f"{folder}/facts", f"{folder}/clustered")
    held = {
        "clustered_records": F.count("*"),
        "clustered_records_k6": F.count("*"),
        "cluster_summary": F.sum("incident_count"),
        "district_alignment": F.sum("incident_count"),
        "district_alignment_k6": F.sum("incident_count"),
        "silhouette_scores": F.count("*"),
        "stability_scores": F.count("*"),
    }
    rows = [
        files.read_table(t.spark, f"{folder}/clustered/{name}").agg(value.alias("records")).withColumn("name", F.lit(name))
        for name, value in held.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# What SQL can know of tables that rest on fitted models.
PREDICTED_TABLES = {
    "predictions": "SELECT crime_id, label FROM test",
    "confusion_matrix": "SELECT label, count(*) AS records FROM test GROUP BY label",
    "metrics": "SELECT * FROM holdout WHERE model_name = 'weighted_random_forest'",
    "model_comparison": "SELECT * FROM holdout UNION ALL SELECT * FROM temporal",
    "class_distribution": """SELECT label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 4) AS class_share
                             FROM model_rows GROUP BY label""",
    "crime_type_distribution": """SELECT primary_type, count(*) AS count,
                                  round(count(*) / sum(count(*)) OVER (), 4) AS type_share FROM model_rows GROUP BY primary_type""",
    "threshold_metrics": """SELECT unnest([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS threshold,
                            (SELECT count(*) FROM test WHERE label = 1) AS positives""",
    "feature_importance": f"SELECT unnest({[*SPEC.numbers, SPEC.category]}) AS feature, true AS sums_to_one",
    "roc_curve": """SELECT 0.0::DOUBLE AS least_x, 1.0::DOUBLE AS most_x, 0.0::DOUBLE AS least_y, 1.0::DOUBLE AS most_y,
                    true AS rises""",
}


@query("b5_predict", digests_sql(COMPARED_SQL, PREDICTED_TABLES))
def b5_predict(t: Tables):
    """What SQL can know of all nine written tables."""
    folder = files.scratch_dir(t.spark)
    files.write_table(t.facts(), f"{folder}/facts")
    jobs.model_job(t.spark, f"{folder}/facts", f"{folder}/predicted")
    read = {name: files.read_table(t.spark, f"{folder}/predicted/{name}") for name in PREDICTED_TABLES}
    x, y = F.col("false_positive_rate"), F.col("true_positive_rate")
    known = {
        "predictions": read["predictions"].select("crime_id", "label"),
        "confusion_matrix": read["confusion_matrix"].groupBy("label").agg(F.sum("count").alias("records")),
        "metrics": recomputed(read["metrics"]),
        "model_comparison": recomputed(read["model_comparison"]),
        "threshold_metrics": read["threshold_metrics"].select(
            "threshold", (F.col("true_positive") + F.col("false_negative")).alias("positives")
        ),
        "feature_importance": sums_to_one(read["feature_importance"]),
        "roc_curve": read["roc_curve"].agg(
            F.min(x).alias("least_x"), F.max(x).alias("most_x"), F.min(y).alias("least_y"), F.max(y).alias("most_y"),
            F.bool_and(x.between(0, 1) & y.between(0, 1)).alias("rises"),
        ),
    }
    return digests(t.spark, {name: known.get(name, read[name]) for name in PREDICTED_TABLES})


SIZES = "(SELECT count(*) FROM ({})) AS records"
EXPORTED = {
    **{f"task1_{name}": SIZES.format(sql) for name, sql in {
        "cleaned_census": LOOKUP_SELECT, "crime_quality": QUALITY_BODY, "data_dictionary": DICTIONARY_SQL,
    }.items()},
    "task1_weather_quality": "1 AS records",
}


@query(
    "b6_export",
    f"""WITH {PREPARED_SQL}, {LOOKUP_SQL.strip()} """
    + " UNION ALL ".join(f"SELECT '{name}' AS name, {records}, true AS same FROM (SELECT 1)" for name, records in EXPORTED.items()),
)
def b6_export(t: Tables):
    """Every exported file of the first stage with its rows, and whether it holds the text of its table."""
    folder = files.scratch_dir(t.spark)
    prepared_incidents(t, folder)
    prepared_references(t, folder, t.raw_weather())
    return exported(t, folder, ["task1"], f"{folder}/processed", "-", "-", "-").filter("name LIKE 'task1%'")


def exported(t: Tables, folder: str, stages: list[str], *places: str) -> DataFrame:
    """``name``, ``records`` and ``same`` of every exported file: whether the text of its rows is that of its table."""
    jobs.export_job(t.spark, f"{folder}/evidence", stages, *places)
    tables = jobs.evidence_tables(*places)
    rows = []
    for stage in stages:
        for name, (path, _) in tables[stage].items():
            table = files.read_table(t.spark, path)
            text = table.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in table.columns])
            file = files.read_raw_csv(t.spark, f"{folder}/evidence/{stage}_{name}")
            both = table_digest(text, "table").unionByName(table_digest(file, "file"))
            same = (F.count_distinct("digest") == 1) & (F.count_distinct("records") == 1)
            rows.append(both.agg(F.max("records").alias("records"), same.alias("same")).withColumn("name", F.lit(f"{stage}_{name}")))
    return reduce(DataFrame.unionByName, rows)


LATER_STAGES = {
    **{f"task2_{name}": SIZES.format(EXPLORED_TABLES[name]) for name in EXPLORED_TABLES if name != "community_area_rolling"},
    "task3_silhouette_scores": "5 AS records",
    "task3_stability_scores": "15 AS records",
    **{f"task4_{name}": SIZES.format(PREDICTED_TABLES[name]) for name in (
        "class_distribution", "crime_type_distribution", "metrics", "model_comparison", "threshold_metrics", "feature_importance",
    )},
}


@query(
    "b6_export_results",
    f"WITH {COMPARED_SQL}, {EXPLORED_SQL.replace(FACTS_SQL + ',', '', 1)} "
    + " UNION ALL ".join(f"SELECT '{name}' AS name, {records}, true AS same FROM (SELECT 1)" for name, records in LATER_STAGES.items())
    + " UNION ALL SELECT unnest(['task3_cluster_summary', 'task3_district_alignment', 'task3_district_alignment_k6',"
    " 'task4_confusion_matrix']), -1, true",
)
def b6_export_results(t: Tables):
    """The same for the three stages of results, on the outputs of their jobs.

    How many clusters, parts of them and cells of the confusion matrix there are is not known to SQL: -1.
    """
    folder = files.scratch_dir(t.spark)
    explored(t, folder)
    jobs.cluster_job(t.spark, f"{folder}/facts", f"{folder}/clustered")
    jobs.model_job(t.spark, f"{folder}/facts", f"{folder}/predicted")
    places = (f"{folder}/processed", f"{folder}/explored", f"{folder}/clustered", f"{folder}/predicted")
    found = exported(t, folder, ["task2", "task3", "task4"], *places)
    unknown = F.col("name").rlike("cluster_summary|district_alignment|confusion_matrix")
    return found.withColumn("records", F.when(unknown, F.lit(-1).cast("long")).otherwise(F.col("records")))
