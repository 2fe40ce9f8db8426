"""The jobs a user runs: prepare, explore, cluster, predict and export."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.labels import priority_label
from ..functions.parsing import parse_timestamp
from ..operators import clusters, contracts, evaluate, explore, fitting, models, quality, sampling, series, shares
from ..operators.ordering import ordered
from ..operators.scalars import at_least
from ..sources import files
from . import schemas as S


def condition() -> Column:
    """Weather condition of a day."""
    return priority_label(S.CONDITIONS, S.NO_EVENT)


def prepare_incidents(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    quality_path: str | None = None,
    quarantine_path: str | None = None,
    dictionary_path: str | None = None,
    overwrite: bool = True,
) -> None:
    """Raw CSV to clean partitioned facts, quality row, quarantine and data dictionary.

    The text is parsed once: the prepared rows are staged as Parquet, with the raw text of rejected rows, and every
    output reads its columns from there. Keys are counted first, and only rows with a repeated one are compared.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    raw = files.read_raw_csv(spark, input_path)
    with files.scratch(spark) as folder:
        parsed = contracts.blank_accepted_text(contracts.prepare(raw, S.INCIDENTS), S.INCIDENTS)
        prepared = files.stage(parsed, folder, "prepared")
        cleaned = contracts.clean(prepared, S.INCIDENTS, lambda keys: files.stage(keys, folder, "repeats"))
        files.write_partitioned(cleaned, output_path, ["year", "district"], mode)
        if quality_path:
            written = files.read_table(spark, output_path)
            row = quality.quality_row(prepared, written, S.SOURCE_DEFECTS, S.CLEAN_DEFECTS, "crime_id")
            files.write_table(row, quality_path, mode)
        if quarantine_path:
            files.write_quarantine(prepared, S.INCIDENT_REASONS, quarantine_path, mode)
    if dictionary_path:
        files.write_table(contracts.data_dictionary(spark, S.DICTIONARY), dictionary_path, mode)


def weather_time(raw_column: str = S.WEATHER.timestamp) -> Column:
    """Parsed observation time of the raw weather table."""
    return parse_timestamp(F.col(raw_column), S.WEATHER.timestamp_formats)


def hourly_weather(raw: DataFrame) -> DataFrame:
    """Raw observations to one typed row per hour."""
    observations = series.prepare_series(raw, S.WEATHER)
    return series.hourly_rollup(observations, S.HOURLY_WEATHER).select(*S.HOURLY_COLUMNS)


def prepare_references(
    spark: SparkSession,
    census_input: str,
    census_output: str,
    weather_input: str,
    weather_output: str,
    weather_quality_output: str,
) -> DataFrame:
    """Clean area lookup, hourly weather and its quality row; returns the lookup's row counts."""
    raw_census = files.read_raw_csv(spark, census_input)
    lookup = contracts.prepare_lookup(raw_census, S.AREAS)
    files.write_table(lookup, census_output)
    raw_weather = files.read_raw_csv(spark, weather_input)
    files.write_table(hourly_weather(raw_weather), weather_output)
    hourly = files.read_table(spark, weather_output)
    files.write_table(
        quality.series_quality(raw_weather, weather_time(), hourly, ("weather_station", "weather_date")),
        weather_quality_output,
    )
    return quality.with_scalar(
        quality.count_rows(raw_census, "raw_census_record_count"),
        quality.count_rows(files.read_table(spark, census_output), "clean_community_area_count"),
    )


def daily_weather(facts: DataFrame, hourly: DataFrame) -> DataFrame:
    """Incidents and weather per day."""
    day, hour = S.HOURLY_WEATHER.keys
    counts = series.hourly_counts(facts, "incident_timestamp", day, hour, "crime_count")
    joined = series.join_hourly(hourly, counts, [day, hour], "crime_count")
    return series.daily_rollup(joined, S.DAILY_WEATHER)


def explore_tables(
    facts: DataFrame, daily: DataFrame, patterns: DataFrame, lookup: DataFrame
) -> dict[str, tuple[DataFrame, Sequence]]:
    """The result tables from facts, daily weather, temporal patterns and lookup, each with its row order."""
    impact = explore.condition_impact(daily, condition(), "crime_count", "weather_condition")
    bounds = series.period(daily, "weather_date")
    ts = "incident_timestamp"
    return {
        "weather_impact": (impact, ["weather_condition"]),
        "seasonal_weather_impact": (
            explore.seasonal_impact(daily, condition(), "weather_date", "crime_count", "weather_condition"),
            ["season", "weather_condition"],
        ),
        "weather_effect_sizes": (
            explore.effect_sizes(impact, "weather_condition", S.NO_EVENT, "average_daily_crime_count"),
            ["weather_condition"],
        ),
        "weekday_weekend_patterns": (
            explore.weekday_totals(patterns, "crime_count"),
            ["day_type", "hour"],
        ),
        "weather_correlations": (explore.correlations(daily, "crime_count", S.CORRELATIONS), []),
        "community_area_rolling": (
            explore.area_rolling(
                facts,
                lookup,
                daily,
                "community_area",
                "has_valid_community_area",
                ts,
                "weather_date",
                "crime_count",
                ["community_name", "hardship_index"],
                S.ROLLING_DAYS,
            ),
            ["community_area", "weather_date"],
        ),
        "community_socioeconomic": (
            explore.area_summary(
                facts,
                lookup,
                bounds,
                "community_area",
                "has_valid_community_area",
                ts,
                S.CENSUS_YEARS,
                "arrest",
                ["community_name", "hardship_index"],
                "crime_count",
            ),
            ["community_area"],
        ),
        "community_spatial_patterns": (
            explore.spatial_profile(
                facts,
                lookup,
                bounds,
                "community_area",
                ["has_valid_community_area", "has_valid_coordinates"],
                ts,
                ("community_name", "hardship_index"),
                "crime_count",
            ),
            [F.desc("crime_count"), F.asc("community_area")],
        ),
    }


def explore_job(
    spark: SparkSession, facts_path: str, weather_path: str, census_path: str, output_dir: str
) -> None:
    """Write the exploration tables; the daily and the temporal table feed the others once written."""
    facts = files.read_table(spark, facts_path)
    hourly = files.read_table(spark, weather_path)
    lookup = files.read_table(spark, census_path)
    first = {
        "daily_crime_weather": (daily_weather(facts, hourly), ["weather_date"]),
        "temporal_patterns": (
            explore.temporal_patterns(facts, "incident_timestamp", "crime_count"),
            ["year", "month", "day_of_week", "hour"],
        ),
    }
    for name, (table, order) in first.items():
        files.write_table(ordered(table, *order), f"{output_dir}/{name}")
    daily, patterns = (files.read_table(spark, f"{output_dir}/{name}") for name in first)
    for name, (table, order) in explore_tables(facts, daily, patterns, lookup).items():
        files.write_table(ordered(table, *order), f"{output_dir}/{name}")


@dataclass(frozen=True)
class Clustering:
    """Tables of a clustering run."""

    best_k: int
    scores: DataFrame
    stability_scores: DataFrame
    clustered_records: DataFrame
    cluster_summary: DataFrame
    district_alignment: DataFrame
    detailed_clustered_records: DataFrame
    district_alignment_k6: DataFrame


def cluster_facts(
    facts: DataFrame,
    folder: str,
    ks: Sequence[int] = clusters.CANDIDATES,
    seeds: Sequence[int] = clusters.SEEDS,
    fraction: float | None = None,
    partitions: int = fitting.FIT_PARTITIONS,
) -> Clustering:
    """Choose K from repeated fits, then assign and profile all valid rows.

    The fits use all valid rows, or a key-hash sample if the caller states its ``fraction``, as distinct points weighted by
    their rows, in so many ``partitions``: a fit depends on this number, not on the cluster. The assignments are written to ``folder``, where the returned
    tables read them.
    """
    if not seeds:
        raise ValueError(f"seeds={list(seeds)}: state at least one.")
    keep = ["crime_id", *S.CLUSTER_FEATURES, "district"]
    rows = clusters.cluster_input(
        facts, "has_valid_coordinates", S.CLUSTER_FEATURES, "crime_id", "district"
    )
    sample = rows
    if fraction is not None:
        sample = sampling.training_sample(rows, "crime_id", fraction, S.SMALLEST_SAMPLE, S.SAMPLE_SEED)
    points = clusters.distinct_points(sample, S.CLUSTER_FEATURES, "district")
    with fitting.persisted(fitting.spread(points, S.CLUSTER_FEATURES, partitions)) as train:
        clusters.require_varying(train, "hour")
        scaler = clusters.fit_scaler(clusters.assemble(sample, S.CLUSTER_FEATURES))
        scaled = scaler.transform(clusters.assemble(train, S.CLUSTER_FEATURES)).select("features", "weight", "groups")
        with fitting.persisted(scaled) as training:
            stability = clusters.kmeans_sweep(training, "groups", ks, seeds, weight="weight")
            scores = clusters.stability_rollup(stability)
            best_k = int(clusters.best_by(scores, "silhouette_score", "k").first()["k"])
            best_model = clusters.fit_kmeans(training, best_k, seeds[0], "weight")
            detail_k = clusters.DETAIL_K
            if not at_least(sample, detail_k + 1):
                raise ValueError(f"The detailed clustering needs more than {detail_k} valid rows.")
            detail_model = (
                best_model if best_k == detail_k else clusters.fit_kmeans(training, detail_k, seeds[0], "weight")
            )
    everything = scaler.transform(clusters.assemble(rows, S.CLUSTER_FEATURES))
    both = clusters.assign(clusters.assign(everything, best_model, "cluster"), detail_model, "detail")
    staged = files.stage(both.select(*keep, "cluster", "detail"), folder, "assigned")
    assigned = staged.drop("detail")
    detailed = staged.drop("cluster").withColumnRenamed("detail", "cluster")
    profile = clusters.cluster_profile(assigned, "cluster", "district")
    return Clustering(
        best_k,
        ordered(scores, "k"),
        ordered(stability, "k", "seed"),
        assigned,
        ordered(clusters.flag_hotspots(profile, "district"), "cluster"),
        shares.alignment(assigned, "cluster", "district", "incident_count", True),
        detailed,
        shares.alignment(detailed, "cluster", "district", "incident_count", False),
    )


def cluster_job(
    spark: SparkSession,
    facts_path: str,
    output_dir: str,
    fraction: float | None = None,
    map_sample: tuple[float, int] | None = None,
    partitions: int = fitting.FIT_PARTITIONS,
    ks: Sequence[int] = clusters.CANDIDATES,
    seeds: Sequence[int] = clusters.SEEDS,
) -> int:
    """Write the clustering tables with both assignments of all valid rows; returns the chosen K.

    ``map_sample`` is the fraction and the most rows of a further table of points to draw.
    """
    order = ["cluster", F.desc("incident_count"), "district"]
    with files.scratch(spark) as folder:
        result = cluster_facts(files.read_table(spark, facts_path), folder, ks, seeds, fraction, partitions)
        tables = {
            "silhouette_scores": result.scores,
            "stability_scores": result.stability_scores,
            "cluster_summary": result.cluster_summary,
            "clustered_records": result.clustered_records,
            "clustered_records_k6": result.detailed_clustered_records,
            "district_alignment": ordered(result.district_alignment, *order),
            "district_alignment_k6": ordered(result.district_alignment_k6, *order),
        }
        for name, table in tables.items():
            files.write_table(table, f"{output_dir}/{name}")
        if map_sample is not None:
            points = result.clustered_records
            files.write_sample(points, f"{output_dir}/map_points", *map_sample, "crime_id", S.SAMPLE_SEED)
    return result.best_k


@dataclass(frozen=True)
class Modeling:
    """Tables and models of a prediction run."""

    model: PipelineModel
    comparison_models: dict[str, PipelineModel]
    predictions: DataFrame
    confusion_matrix: DataFrame
    metrics: DataFrame
    class_distribution: DataFrame
    crime_type_distribution: DataFrame
    roc_curve: DataFrame
    model_comparison: DataFrame
    threshold_metrics: DataFrame
    feature_importance: DataFrame


def model_facts(
    facts: DataFrame, folder: str, bins: int = models.BINS, partitions: int | None = None
) -> Modeling:
    """Fit and compare the models on a random and a temporal holdout, side by side unless they are large.

    The fits read so many ``partitions``, by default 16, or more for more than 4 million rows; a fit depends on their number.
    The model table and the predictions are written to ``folder``, where the returned tables read them.
    """
    spark, spec = facts.sparkSession, S.MODEL
    table = files.stage(models.model_table(facts, spec), folder, "model_table")
    models.require_classes(table, "Arrest prediction")
    train, test = sampling.hash_split(table, spec.key, S.TRAIN_FRACTION, S.SAMPLE_SEED)
    models.require_classes(train, "The training split")
    models.require_classes(test, "The test split")

    def on_holdout():
        fitted = models.fit_models(train, spec, bins, partitions)
        return fitted, models.compare_models(fitted, test)

    def on_last_years():
        return models.compare_temporal(table, spec, bins, partitions)

    together = min(2, fitting.fits_together(table.count()))
    (fitted, found), late = fitting.concurrently(spark, lambda part: part(), [on_holdout, on_last_years], together)
    comparison = models.comparison_table(spark, [*found, *late])
    chosen = fitted[models.SELECTED[0]]
    score = "arrest_probability"
    scored = models.prediction_output(chosen.transform(test), spec.key, score)
    predictions = files.stage(scored, folder, "predictions")
    types = shares.distribution(table, spec.category, "type_share")
    return Modeling(
        model=chosen,
        comparison_models={
            name: fitted[name]
            for name in ("weighted_logistic_regression", "weighted_gradient_boosted_trees")
        },
        predictions=predictions,
        confusion_matrix=ordered(evaluate.confusion(predictions), "label", "prediction"),
        metrics=models.selected_metrics(comparison),
        class_distribution=ordered(shares.distribution(table, "label", "class_share"), "label"),
        crime_type_distribution=ordered(types, F.desc("count"), spec.category),
        roc_curve=ordered(
            evaluate.roc_curve(predictions, score), "false_positive_rate", "true_positive_rate"
        ),
        model_comparison=comparison,
        threshold_metrics=ordered(evaluate.threshold_metrics(predictions, score), "threshold"),
        feature_importance=ordered(models.feature_importance(chosen, spec, spark), F.desc("importance")),
    )


# Names of the written prediction tables.
MODEL_TABLES = (
    "predictions",
    "confusion_matrix",
    "metrics",
    "class_distribution",
    "crime_type_distribution",
    "model_comparison",
    "threshold_metrics",
    "feature_importance",
    "roc_curve",
)


def model_job(
    spark: SparkSession,
    facts_path: str,
    output_dir: str,
    bins: int = models.BINS,
    partitions: int | None = None,
) -> None:
    """Write the prediction tables and the fitted models."""
    with files.scratch(spark) as folder:
        result = model_facts(files.read_table(spark, facts_path), folder, bins, partitions)
        for name in MODEL_TABLES:
            files.write_table(getattr(result, name), f"{output_dir}/{name}")
    files.save_model(result.model, f"{output_dir}/random_forest_model")
    for name, model in result.comparison_models.items():
        files.save_model(model, f"{output_dir}/{name}_model")


def evidence_tables(
    processed_dir: str, explore_dir: str, cluster_dir: str, model_dir: str
) -> dict[str, dict[str, tuple[str, Sequence]]]:
    """Small result tables per stage, each with its path and row order."""
    # Names of the exported tables.
    by_condition, by_k = ["weather_condition"], ["k"]
    by_share = ["cluster", F.desc("incident_count"), "district"]
    prepared = {
        "cleaned_census": ["community_area"],
        "crime_quality": ["raw_record_count"],
        "weather_quality": ["raw_weather_record_count"],
        "data_dictionary": ["source_field"],
    }
    explored = {
        "weather_impact": by_condition,
        "weather_correlations": ["temperature_crime_correlation"],
        "temporal_patterns": ["year", "month", "day_of_week", "hour"],
        "daily_crime_weather": ["weather_date"],
        "community_socioeconomic": ["community_area"],
        "seasonal_weather_impact": ["season", "weather_condition"],
        "weather_effect_sizes": by_condition,
        "weekday_weekend_patterns": ["day_type", "hour"],
        "community_spatial_patterns": [F.desc("crime_count"), "community_area"],
    }
    clustered = {
        "silhouette_scores": by_k,
        "stability_scores": ["k", "seed"],
        "cluster_summary": ["cluster"],
        "district_alignment": by_share,
        "district_alignment_k6": by_share,
    }
    predicted = {
        "class_distribution": ["label"],
        "crime_type_distribution": [F.desc("count"), "primary_type"],
        "confusion_matrix": ["label", "prediction"],
        "metrics": ["model_name"],
        "model_comparison": ["validation_strategy", "model_name"],
        "threshold_metrics": ["threshold"],
        "feature_importance": [F.desc("importance"), "feature"],
    }
    stages = {
        "task1": (processed_dir, prepared),
        "task2": (explore_dir, explored),
        "task3": (cluster_dir, clustered),
        "task4": (model_dir, predicted),
    }
    return {
        stage: {name: (f"{folder}/{name}", order) for name, order in tables.items()}
        for stage, (folder, tables) in stages.items()
    }


def export_job(
    spark: SparkSession,
    evidence_dir: str,
    stages: Sequence[str],
    processed_dir: str,
    explore_dir: str,
    cluster_dir: str,
    model_dir: str,
) -> list[str]:
    """Export the small tables of the selected stages as CSV."""
    tables = evidence_tables(processed_dir, explore_dir, cluster_dir, model_dir)
    return files.export_stage(spark, tables, stages, evidence_dir)
