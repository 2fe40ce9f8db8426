"""Clustering and classification on small frames with a known answer."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyfield.functions.labels import positive_score
from tallyfield.operators import clusters, evaluate, fitting, models, shares
from tallyfield.plans import jobs, schemas as S
from tallyfield.sources import files


def facts_with_signal(spark, n=3000):
    """Two far groups of places, and arrests that depend on the category."""
    i = F.col("id")
    far = (i % 2) == 0
    return spark.range(n).select(
        i.alias("crime_id"),
        F.when(i % 3 == 0, "THEFT").otherwise("BATTERY").alias("primary_type"),
        (((i % 3) == 0) & ((i % 11) != 0)).alias("arrest"),
        (F.lit(2005) + (i % 10)).cast("int").alias("year"),
        (1 + i % 12).cast("int").alias("month"),
        F.when(far, 2 + i % 3).otherwise(20 + i % 3).cast("int").alias("hour"),
        F.when(far, 1).otherwise(2).cast("int").alias("district"),
        (1 + i % 77).cast("int").alias("community_area"),
        (F.when(far, 41.2).otherwise(42.8) + (i % 17) / 1000.0).alias("latitude"),
        (F.when(far, -88.2).otherwise(-87.2) + (i % 13) / 1000.0).alias("longitude"),
        F.lit(True).alias("has_valid_coordinates"),
        F.lit(True).alias("has_valid_district"),
        F.lit(True).alias("has_valid_community_area"),
    )


def test_cluster_input_drops_rows_without_place(spark):
    rows = spark.createDataFrame(
        [(1, 12, 3, 41.8, -87.6, True), (2, 12, 3, None, None, False), (3, None, 3, 41.8, -87.6, True)],
        "crime_id long, hour int, district int, latitude double, longitude double, has_valid_coordinates boolean",
    )
    kept = clusters.cluster_input(rows, "has_valid_coordinates", S.CLUSTER_FEATURES, "crime_id", "district")
    assert [r.crime_id for r in kept.collect()] == [1]


def test_clustering_finds_the_two_groups(spark, tmp_path):
    result = jobs.cluster_facts(facts_with_signal(spark, 2000), str(tmp_path), ks=(2, 3), seeds=(42, 123))
    assert result.best_k == 2
    scores = result.stability_scores.collect()
    assert [(r.k, r.seed) for r in scores] == [(2, 42), (2, 123), (3, 42), (3, 123)]
    assert all(-1 <= r.silhouette_score <= 1 and r.minimum_cluster_size <= r.maximum_cluster_size for r in scores)
    assert scores[0].average_dominant_district_share == 1.0
    summary = result.cluster_summary.collect()
    assert [r.incident_count for r in summary] == [1000, 1000]
    assert {r.crosses_district_boundaries for r in summary} == {False}
    assert result.detailed_clustered_records.select("cluster").distinct().count() == 6
    assert {r.cluster_share for r in result.district_alignment.collect()} == {1.0}


def test_clustering_guards(spark, tmp_path):
    facts = facts_with_signal(spark, 200)
    with pytest.raises(ValueError, match="seed"):
        jobs.cluster_facts(facts, str(tmp_path), seeds=())
    with pytest.raises(ValueError, match="same value"):
        jobs.cluster_facts(facts.withColumn("hour", F.lit(0)), str(tmp_path))
    with pytest.raises(ValueError, match="no value from 2"):
        clusters.kmeans_sweep(clusters.assemble(facts.limit(2), S.CLUSTER_FEATURES, "features"), "district")


@pytest.mark.parametrize("k", [2, 5])
def test_silhouettes_are_those_of_the_evaluator(spark, tables, k):
    from pyspark.ml.evaluation import ClusteringEvaluator

    rows = clusters.cluster_input(tables.facts(), "has_valid_coordinates", S.CLUSTER_FEATURES, "crime_id", "district")
    scaled = clusters.scale(rows, rows, S.CLUSTER_FEATURES)
    names = ["a", "b"]
    for name, seed in zip(names, (1, 2)):
        scaled = clusters.assign(scaled, clusters.fit_kmeans(scaled, k, seed), name)
    alone = F.when(F.col("crime_id") == rows.agg(F.min("crime_id")).first()[0], 99).otherwise(F.col("a"))
    scaled = scaled.withColumn("c", alone).persist()
    got = clusters.silhouettes(scaled, [*names, "c"])
    for name, value in zip([*names, "c"], got):
        evaluator = ClusteringEvaluator(featuresCol="features", predictionCol=name)
        assert value == pytest.approx(evaluator.evaluate(scaled), abs=1e-9)
    scaled.unpersist()


def test_sweep_scores_are_those_of_single_passes(spark, tables):
    rows = clusters.cluster_input(tables.facts(), "has_valid_coordinates", S.CLUSTER_FEATURES, "crime_id", "district")
    with fitting.persisted(fitting.spread(clusters.scale(rows, rows, S.CLUSTER_FEATURES), "crime_id", 3)) as train:
        found = clusters.kmeans_sweep(train, "district", (2, 4), (7,)).collect()
        for row in found:
            assigned = clusters.fit_kmeans(train, row.k, 7).transform(train)
            least, most = clusters.size_range(assigned, "cluster").first()
            share = shares.dominant_share(assigned, "cluster", "district", "s").first()[0]
            assert (row.minimum_cluster_size, row.maximum_cluster_size) == (least, most)
            assert row.average_dominant_district_share == pytest.approx(share, abs=1e-12)
            assert row.silhouette_score == pytest.approx(clusters.silhouette(assigned), abs=1e-12)


def test_fits_read_each_point_once_and_score_all_rows(spark, tmp_path, monkeypatch):
    read, fit = [], clusters.fit_kmeans

    def noted(df, *rest):
        read.append(df.count())
        return fit(df, *rest)

    monkeypatch.setattr(clusters, "fit_kmeans", noted)
    facts = facts_with_signal(spark, 5000)
    points = facts.select(*S.CLUSTER_FEATURES).distinct().count()
    result = jobs.cluster_facts(facts, str(tmp_path), ks=(2, 3), seeds=(42,))
    assert points < 2000 and set(read) == {points}
    rows = clusters.cluster_input(facts, "has_valid_coordinates", S.CLUSTER_FEATURES, "crime_id", "district")
    scaled = clusters.scale(rows, rows, S.CLUSTER_FEATURES)
    clustered = result.clustered_records.select("crime_id", "cluster").join(scaled, "crime_id").persist()
    row = result.stability_scores.filter(F.col("k") == result.best_k).first()
    least, most = clusters.size_range(clustered, "cluster").first()
    share = shares.dominant_share(clustered, "cluster", "district", "s").first()[0]
    assert (row.minimum_cluster_size, row.maximum_cluster_size) == (least, most)
    assert row.average_dominant_district_share == pytest.approx(share, abs=1e-12)
    assert row.silhouette_score == pytest.approx(clusters.silhouette(clustered), abs=1e-9)
    assert clustered.count() == 5000
    clustered.unpersist()


def test_category_index_equals_the_estimators(spark, tmp_path):
    rows = spark.createDataFrame([(c,) for c in "bbaccc"] + [(None,)], "primary_type string")
    table = models.category_table(rows, "primary_type", lambda df: files.stage(df, str(tmp_path), "types"))
    more = rows.unionByName(spark.createDataFrame([("new",)], rows.schema))
    got = {r[0]: r[1] for r in models.with_category_index(more, table, "primary_type").collect()}
    theirs = models.category_index(S.MODEL).fit(rows.dropna()).transform(more)
    assert got == {r[0]: r[1] for r in theirs.collect()} and got["new"] == got[None] == 3.0


def test_a_million_categories(spark, tmp_path):
    rows = spark.range(1_200_000).selectExpr("concat('c', id % 1000000) AS c", "id")
    table = models.category_table(rows, "c", lambda df: files.stage(df, str(tmp_path), "many"))
    out = models.with_category_index(rows, table, "c").agg(F.countDistinct("c_index"), F.min("c_index"), F.max("c_index")).first()
    assert tuple(out) == (1_000_000, 0.0, 999_999.0)
    assert models.with_category_index(rows, table, "c").filter("c_index < 200000 and id % 1000000 >= 200000").isEmpty()


def test_models_are_compared_in_one_pass(spark):
    table = models.model_table(facts_with_signal(spark, 400), S.MODEL)
    fitted = models.fit_models(table, S.MODEL, partitions=3)
    scored = models.scored_rows(fitted, table, "none")
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") + text.count("Range") == 1 and "Union" not in text
    rows = {r[0]: r for r in models.comparison_rows(scored, "s")}
    for name, model in fitted.items():
        alone = model.transform(table)
        metrics = evaluate.binary_metrics(alone).first()
        ranks = alone.select("label", positive_score(F.col("rawPrediction")).alias("rank"))
        assert rows[name][3:12] == pytest.approx((*metrics[:-1],)[:9], abs=1e-12)
        assert rows[name][12:] == pytest.approx(tuple(evaluate.areas(ranks, "rank").first()), abs=1e-12)
    positives = table.agg(F.avg("label")).first()[0]
    assert rows["none"][-2:] == pytest.approx((0.5, positives))


def test_null_deviation_of_one_seed_is_zero(spark):
    row = (1, 2, 0.5, 9.0, 1, 2, 0.25)
    schema = (
        "seed long, k long, silhouette_score double, training_cost double, minimum_cluster_size long,"
        " maximum_cluster_size long, average_dominant_district_share double"
    )
    got = clusters.stability_rollup(spark.createDataFrame([row], schema)).first()
    assert (got.silhouette_stddev, got.training_cost_stddev) == (0.0, 0.0)


def test_best_by_takes_the_smaller_k_on_a_tie(spark):
    rows = spark.createDataFrame([(3, 0.5), (2, 0.5), (4, 0.1)], "k int, s double")
    assert clusters.best_by(rows, "s", "k").first().k == 2


def test_pipelines_have_the_published_settings():
    forest = models.rf_pipeline(S.MODEL, True).getStages()[-1]
    assert forest.getNumTrees() == 20 and forest.getWeightCol() == "class_weight" and forest.getMaxBins() == 64
    assert not models.rf_pipeline(S.MODEL, False).getStages()[-1].isSet("weightCol")
    logistic = models.lr_pipeline(S.MODEL).getStages()
    assert len(logistic) == 4 and (logistic[-1].getMaxIter(), logistic[-1].getRegParam()) == (50, 0.01)
    assert models.gbt_pipeline(S.MODEL).getStages()[-1].getMaxIter() == 20


def test_more_categories_than_bins(spark):
    rows = facts_with_signal(spark, 1000).withColumn(
        "primary_type", F.when(F.col("arrest"), "A").otherwise(F.concat(F.lit("T"), F.col("crime_id") % 90))
    )
    table = models.model_table(rows, S.MODEL)
    with pytest.raises(ValueError, match="bins=64"):
        models.fit_models(table, S.MODEL)
    assert models.require_bins(table, S.MODEL, 128) is table
    models.rf_pipeline(S.MODEL, True, 128).fit(models.class_weights(table))


def test_fits_do_not_depend_on_input_partitions(spark):
    facts = facts_with_signal(spark, 600)
    table = models.model_table(facts, S.MODEL).withColumn("label", (F.hash("crime_id") % 2 == 0).cast("double"))
    rows = clusters.assemble(table, S.CLUSTER_FEATURES, "features")
    forests, costs = set(), set()
    for n in (1, 13):
        spread = fitting.spread(models.class_weights(table.repartition(n)), "crime_id")
        scored = models.rf_pipeline(S.MODEL, True).fit(spread).transform(table)
        forests.add(tuple(r.prediction for r in scored.orderBy("crime_id").collect()))
        costs.add(round(clusters.fit_kmeans(fitting.spread(rows.repartition(n), "crime_id"), 4, 42).summary.trainingCost, 6))
    assert len(forests) == 1 and len(costs) == 1


def test_detailed_clustering_needs_enough_rows(spark, tmp_path):
    with pytest.raises(ValueError, match="more than 6"):
        jobs.cluster_facts(facts_with_signal(spark, 6), str(tmp_path), ks=(2,), seeds=(42,))


def test_prediction_finds_the_signal(spark, tmp_path):
    result = jobs.model_facts(facts_with_signal(spark), str(tmp_path))
    rows = {(r.model_name, r.validation_strategy): r for r in result.model_comparison.collect()}
    assert len(rows) == 8
    assert {r.temporal_cutoff_year for key, r in rows.items() if key[1] == "temporal_holdout"} == {2011}
    baseline = rows["majority_class_baseline", "seeded_random_holdout"]
    assert (baseline.f1_score, baseline.area_under_roc) == (0.0, 0.5)
    total = result.predictions.count()
    for key, row in rows.items():
        if key[0] != "majority_class_baseline":
            assert row.area_under_roc > 0.9, key
        if key[1] == "seeded_random_holdout":
            assert row.true_positive + row.false_positive + row.false_negative + row.true_negative == total
    assert result.feature_importance.first().feature == "primary_type"
    assert sum(r["count"] for r in result.confusion_matrix.collect()) == total
    assert result.metrics.count() == 1 and result.class_distribution.count() == 2


def test_prediction_needs_both_classes(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks rows with label"):
        jobs.model_facts(facts_with_signal(spark, 300).withColumn("arrest", F.lit(False)), str(tmp_path))


def test_temporal_comparison_is_skipped_without_both_classes(spark):
    table = models.model_table(facts_with_signal(spark, 300), S.MODEL).withColumn(
        "label", F.when(F.col("year") >= 2011, 0.0).otherwise(F.col("label"))
    )
    assert models.compare_temporal(table, S.MODEL) == []


def test_saved_model_predicts_the_same(spark, tmp_path):
    from pyspark.ml import PipelineModel

    table = models.model_table(facts_with_signal(spark, 300), S.MODEL)
    model = models.lr_pipeline(S.MODEL).fit(models.class_weights(table))
    path = str(tmp_path / "model")
    files.save_model(model, path)
    files.save_model(model, path)
    columns = ["crime_id", "prediction"]
    again = PipelineModel.load(path).transform(table).select(*columns)
    assert again.exceptAll(model.transform(table).select(*columns)).count() == 0


def test_comparison_scores_rows_once(spark):
    """The areas read the counts per score several times; the rows, scored by every model, are read once."""
    seen = spark.sparkContext.accumulator(0)

    def score(i):
        seen.add(1)
        return "m", float(i % 2), float(i % 3 == 0), i / 7.0

    rows = spark.sparkContext.parallelize(range(400), 4).map(score)
    scored = spark.createDataFrame(rows, "model_name string, label double, prediction double, rank double")
    (row,) = models.comparison_rows(scored, "s")
    assert sum(row[3:7]) == 400
    assert seen.value == 400


def test_fits_of_more_rows_have_more_partitions_and_less_company():
    assert [fitting.fit_partitions(n) for n in (0, 4_000_000, 4_000_001, 40_000_000)] == [16, 16, 17, 160]
    assert [fitting.fits_together(n) for n in (0, 100_000, 6_000_000, 40_000_000)] == [8, 8, 4, 1]


def test_fits_share_the_category_index_and_tree_vectors(spark, monkeypatch):
    """A small partition size deals the same rows over more tasks, and all models hold one index."""
    monkeypatch.setattr(fitting, "PARTITION_ROWS", 50)
    table = models.model_table(facts_with_signal(spark, 1000), S.MODEL)
    dealt = []
    monkeypatch.setattr(models, "spread", lambda df, key, n: dealt.append(n) or fitting.spread(df, key, n))
    fitted = models.fit_models(table, S.MODEL)
    assert dealt == [20]
    assert len({model.stages[0].uid for model in fitted.values()}) == 1
    scored = models.scored_rows(fitted, table)
    assert scored.groupBy("model_name").count().filter("count = 1000").count() == 4


def test_silhouette_code_needs_no_package_on_executors(spark, monkeypatch, tmp_path):
    """What tasks run loads where only Spark, NumPy and Arrow are installed."""
    rows = spark.createDataFrame([(Vectors.dense(float(i), 0.0), i % 2) for i in range(8)], ["features", "cluster"])
    sent, run = [], type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda df, fn, schema: sent.append(fn) or run(df, fn, schema))
    clusters.silhouette(rows)
    load = "import sys, pyspark.cloudpickle as c; c.loads(sys.stdin.buffer.read()); assert 'tallyfield' not in sys.modules"
    subprocess.run([sys.executable, "-I", "-c", load], input=cloudpickle.dumps(sent[0]), cwd=tmp_path, check=True)
