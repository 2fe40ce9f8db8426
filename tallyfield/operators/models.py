"""Binary classification: model table, weights, feature stages, classifiers and comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.labels import positive_score, to_label
from .contracts import drop_null, require_flags
from .evaluate import COUNTS, compare_counts, score_counts
from .fitting import concurrently, fit_partitions, fits_together, persisted, spread
from .ordering import number_rows, ordered
from .sampling import temporal_split
from .scalars import distinct_values

# Model settings of the published study.
SEED = 42
TREES = 20
BOOSTING_ROUNDS = 20
LOGISTIC_ROUNDS = 50
LOGISTIC_L2 = 0.01
BINS = 64
TREE_CLASSIFIERS = (RandomForestClassifier, GBTClassifier)
CUTOFF_YEARS = 3
SELECTED = ("weighted_random_forest", "seeded_random_holdout")

# Columns of the comparison table.
COMPARISON_SCHEMA = (
    "model_name string, validation_strategy string, temporal_cutoff_year long, true_positive long,"
    " false_positive long, false_negative long, true_negative long, precision double, recall double,"
    " specificity double, f1_score double, balanced_accuracy double, area_under_roc double,"
    " area_under_pr double"
)


@dataclass(frozen=True)
class ModelSpec:
    """Columns of a model table."""

    key: str
    category: str
    target: str
    year: str
    numbers: Sequence[str]
    flags: Sequence[str]


def model_table(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Flagged, complete rows with key, category, label, year and numeric features."""
    gated = require_flags(df, spec.flags, [spec.target, spec.category])
    return drop_null(gated, spec.numbers).select(
        spec.key, spec.category, to_label(F.col(spec.target)).alias("label"), spec.year, *spec.numbers
    )


def _class_counts(df: DataFrame) -> tuple[int, int, int]:
    label = F.col("label")
    other = F.count("*") - F.count_if(label == 0) - F.count_if(label == 1)
    return tuple(df.agg(F.count_if(label == 0), F.count_if(label == 1), other).first())


def has_classes(df: DataFrame) -> bool:
    """Whether both labels occur."""
    negative, positive, _ = _class_counts(df)
    return negative > 0 and positive > 0


def require_classes(df: DataFrame, name: str) -> DataFrame:
    """Return ``df``, or fail when a label is absent."""
    if not has_classes(df):
        raise ValueError(f"{name} lacks rows with label 0 or with label 1.")
    return df


def class_weights(df: DataFrame) -> DataFrame:
    """Add ``class_weight``: rows / (2 x rows of the class); labels must be exactly 0 and 1."""
    return _with_weights(df, *_class_counts(df))


def _with_weights(df: DataFrame, negative: int, positive: int, other: int) -> DataFrame:
    if not negative or not positive or other:
        raise ValueError(f"label must hold 0 and 1 only; found {negative} zeros, {positive} ones, {other} others.")
    total = negative + positive
    weight = F.when(F.col("label") == 1, F.lit(total / (2 * positive)))
    return df.withColumn("class_weight", weight.otherwise(F.lit(total / (2 * negative))))


def category_index(spec: ModelSpec) -> StringIndexer:
    """Category to index by falling frequency; unseen categories share one more index."""
    return StringIndexer(
        inputCol=spec.category, outputCol=f"{spec.category}_index", handleInvalid="keep"
    )


def category_one_hot(spec: ModelSpec) -> OneHotEncoder:
    """Category index to a one-hot vector."""
    return OneHotEncoder(
        inputCols=[f"{spec.category}_index"], outputCols=[f"{spec.category}_vector"], handleInvalid="keep"
    )


def category_table(df: DataFrame, col: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``col`` and ``index`` of each category by falling frequency, then by name: the numbers of ``category_index``.

    No list of categories passes the driver, so there may be as many as rows. ``keep`` writes the counted categories
    and reads them back. NULL is no category.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_rows"))
    numbered = number_rows(ordered(counts, F.desc("_rows"), col), "_position", keep)
    return numbered.select(col, (F.col("_position") - 1).cast("double").alias("index"))


def with_category_index(df: DataFrame, table: DataFrame, col: str) -> DataFrame:
    """Add ``<col>_index`` from a category table; NULL and unseen categories share one more index."""
    size = table.agg(F.count("*").cast("double").alias("size")).scalar()
    names = table.select(F.col(col).alias("_category"), F.col("index").alias(f"_{col}_index"))
    joined = df.join(names, F.col(col) == F.col("_category"), "left").drop("_category")
    return joined.withColumn(f"{col}_index", F.coalesce(f"_{col}_index", size)).drop(f"_{col}_index")


def with_one_hot(df: DataFrame, col: str, categories: int) -> DataFrame:
    """Add ``<col>_vector`` from ``<col>_index``, with a place for each category and for unseen ones."""
    index = f"{col}_index"
    widest = df.sparkSession.range(1).select(F.lit(float(categories)).alias(index))
    encoder = OneHotEncoder(inputCols=[index], outputCols=[f"{col}_vector"], handleInvalid="keep")
    return encoder.fit(widest).transform(df)


def _features(spec: ModelSpec, category: str) -> VectorAssembler:
    return VectorAssembler(inputCols=[*spec.numbers, f"{spec.category}_{category}"], outputCol="features")


def _weighted(classifier, weighted: bool):
    return classifier.setWeightCol("class_weight") if weighted else classifier


def require_bins(df: DataFrame, spec: ModelSpec, bins: int) -> DataFrame:
    """Return ``df``, or fail when its categories and the index of unseen ones need more tree bins."""
    if distinct_values(df, spec.category).limit(bins).count() >= bins:
        raise ValueError(f"bins={bins} is too small for the values of {spec.category} and one for unseen ones.")
    return df


def rf_pipeline(spec: ModelSpec, weighted: bool, bins: int = BINS) -> Pipeline:
    """Random forest on numbers and the category index."""
    forest = RandomForestClassifier(numTrees=TREES, maxBins=bins, seed=SEED)
    return Pipeline(stages=[category_index(spec), _features(spec, "index"), _weighted(forest, weighted)])


def gbt_pipeline(spec: ModelSpec, weighted: bool = True, bins: int = BINS) -> Pipeline:
    """Gradient-boosted trees on the same features."""
    boosted = GBTClassifier(maxIter=BOOSTING_ROUNDS, maxBins=bins, seed=SEED)
    return Pipeline(stages=[category_index(spec), _features(spec, "index"), _weighted(boosted, weighted)])


def lr_pipeline(spec: ModelSpec, weighted: bool = True) -> Pipeline:
    """Logistic regression with an L2 penalty on numbers and the one-hot category."""
    logistic = LogisticRegression(maxIter=LOGISTIC_ROUNDS, regParam=LOGISTIC_L2, elasticNetParam=0.0)
    stages = [category_index(spec), category_one_hot(spec), _features(spec, "vector")]
    return Pipeline(stages=[*stages, _weighted(logistic, weighted)])


def majority_baseline(df: DataFrame) -> DataFrame:
    """Add ``prediction``: the negative class for every row."""
    return df.withColumn("prediction", F.lit(0.0))


def scored_rows(
    models: dict[str, PipelineModel], test: DataFrame, baseline: str | None = None
) -> DataFrame:
    """``model_name``, ``label``, ``prediction`` and ``rank`` of every row by every model, from one pass over ``test``.

    ``baseline`` names one more model that predicts the negative class and ranks all rows alike.
    """
    scored, done = test, []
    for i, model in enumerate(models.values()):
        found = F.struct("prediction", positive_score(F.col("rawPrediction")).alias("rank")).alias(f"_model_{i}")
        scored = model.transform(scored).select(*test.columns, *done, found)
        done.append(f"_model_{i}")
    rows = [
        F.struct(F.lit(name).alias("model_name"), F.col(at)["prediction"].alias("prediction"), F.col(at)["rank"].alias("rank"))
        for name, at in zip(models, done)
    ]
    if baseline is not None:
        scored = majority_baseline(scored)
        rows.append(F.struct(F.lit(baseline).alias("model_name"), "prediction", F.lit(0.0).alias("rank")))
    return scored.select("label", F.explode(F.array(*rows)).alias("row")).select("label", "row.*")


def comparison_rows(scored: DataFrame, strategy: str, cutoff: int = 0) -> list[tuple]:
    """Rows of the comparison table, one for each model of ``scored_rows``."""
    columns = [*COUNTS, "precision", "recall", "specificity", "f1_score", "balanced_accuracy", "area_under_roc", "area_under_pr"]
    # The counts are read for the ranges, their totals and the running sums: without keeping them, every model scores
    # all rows as many times.
    with persisted(score_counts(scored, "rank", "model_name")) as counts:
        found = compare_counts(counts, "rank", "model_name").select("model_name", *columns).collect()
    return [(row[0], strategy, cutoff, *row[1:]) for row in sorted(found)]


def comparison_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """The comparison rows as a table of 14 columns."""
    return spark.createDataFrame(rows, COMPARISON_SCHEMA)


def selected_metrics(comparison: DataFrame) -> DataFrame:
    """The row of the selected model."""
    name, strategy = SELECTED
    return comparison.filter(
        (F.col("model_name") == name) & (F.col("validation_strategy") == strategy)
    )


def _fit_all(
    train: DataFrame, spec: ModelSpec, pipelines: dict[str, Pipeline], bins: int, partitions: int | None
) -> dict[str, PipelineModel]:
    """Fit pipelines, which all begin with ``category_index``, on rows that are read from the source once.

    They lie in so many ``partitions``, by default as many as their number asks for. The categories are counted once, and
    the vectors that all trees read (numbers and category index) are made once.
    """
    counts = _class_counts(train)
    rows_held = sum(counts)
    with persisted(spread(train, spec.key, partitions or fit_partitions(rows_held))) as rows:
        weighted = _with_weights(require_bins(rows, spec, bins), *counts)
        index = category_index(spec).fit(rows)
        vectors = _features(spec, "index").transform(index.transform(weighted))
        with persisted(vectors.select("label", "class_weight", "features")) as assembled:

            def fit(pipeline: Pipeline) -> PipelineModel:
                *before, classifier = pipeline.getStages()[1:]
                if isinstance(classifier, TREE_CLASSIFIERS):
                    return PipelineModel([index, *before, classifier.fit(assembled)])
                return Pipeline(stages=[index, *before, classifier]).fit(weighted)

            fitted = concurrently(train.sparkSession, fit, list(pipelines.values()), fits_together(rows_held))
    return dict(zip(pipelines, fitted))


def weighted_pipelines(spec: ModelSpec, bins: int) -> dict[str, Pipeline]:
    """The three weighted classifiers by name."""
    return {
        "weighted_random_forest": rf_pipeline(spec, True, bins),
        "weighted_logistic_regression": lr_pipeline(spec),
        "weighted_gradient_boosted_trees": gbt_pipeline(spec, True, bins),
    }


def fit_models(
    train: DataFrame, spec: ModelSpec, bins: int = BINS, partitions: int | None = None
) -> dict[str, PipelineModel]:
    """The unweighted forest and the three weighted models on one training frame."""
    unweighted = {"unweighted_random_forest": rf_pipeline(spec, False, bins)}
    return _fit_all(train, spec, unweighted | weighted_pipelines(spec, bins), bins, partitions)


def compare_models(models: dict[str, PipelineModel], test: DataFrame) -> list[tuple]:
    """Baseline and fitted models on the random holdout."""
    return comparison_rows(scored_rows(models, test, "majority_class_baseline"), SELECTED[1])


def compare_temporal(
    df: DataFrame, spec: ModelSpec, bins: int = BINS, partitions: int | None = None
) -> list[tuple]:
    """The three weighted models on the last years; nothing when a part lacks a class."""
    train, test, cutoff = temporal_split(df, spec.year, CUTOFF_YEARS)
    if not (has_classes(train) and has_classes(test)):
        return []
    models = _fit_all(train, spec, weighted_pipelines(spec, bins), bins, partitions)
    return comparison_rows(scored_rows(models, test), "temporal_holdout", cutoff)


def prediction_output(predictions: DataFrame, key: str, score: str) -> DataFrame:
    """Key, label, prediction and probability of the positive class."""
    return predictions.select(
        key, "label", "prediction", positive_score(F.col("probability")).alias(score)
    )


def feature_importance(model: PipelineModel, spec: ModelSpec, spark: SparkSession) -> DataFrame:
    """Importance per feature; the indexed category is one feature."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(
        list(zip([*spec.numbers, spec.category], values)), "feature string, importance double"
    )
