"""Queries on model tables, weights, feature stages, classifiers and their comparison."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import evaluate, fitting, models, sampling
from ..operators.ordering import ordered
from ..operators.scalars import over_all
from ..plans import schemas as S
from ..sources import files
from .registry import query
from .standins import MODEL_TABLE_SQL, SCORED_SQL, Tables, key_hash_sql

SPEC = S.MODEL
NUMBERS = ["latitude", "longitude"]
TRAIN_BOUND = round(S.TRAIN_FRACTION * (1 << 32))
TEST_SQL = f"""{MODEL_TABLE_SQL},
test AS (SELECT * FROM model_rows WHERE {key_hash_sql('crime_id')} >= {TRAIN_BOUND})"""
HOLDOUT_MODELS = [
    "majority_class_baseline",
    "unweighted_random_forest",
    "weighted_random_forest",
    "weighted_logistic_regression",
    "weighted_gradient_boosted_trees",
]
# What SQL can know of a comparison: its rows, and the labels that each was made on.
COMPARED_SQL = f"""{TEST_SQL},
holdout AS (
  SELECT unnest({HOLDOUT_MODELS}) AS model_name, 'seeded_random_holdout' AS validation_strategy,
         0::BIGINT AS temporal_cutoff_year, count(*) FILTER (label = 1) AS positives,
         count(*) FILTER (label = 0) AS negatives, true AS rates_follow FROM test),
late AS (SELECT *, (SELECT max(year) - 3 FROM model_rows) AS cutoff FROM model_rows),
temporal AS (
  SELECT unnest({HOLDOUT_MODELS[2:]}) AS model_name, 'temporal_holdout' AS validation_strategy,
         cutoff::BIGINT AS temporal_cutoff_year, count(*) FILTER (year >= cutoff AND label = 1) AS positives,
         count(*) FILTER (year >= cutoff AND label = 0) AS negatives, true AS rates_follow
  FROM late GROUP BY cutoff
  HAVING positives > 0 AND negatives > 0 AND count(DISTINCT label) FILTER (year < cutoff) = 2)"""
INDEX_SQL = f"""{MODEL_TABLE_SQL},
ranked AS (SELECT primary_type, row_number() OVER (ORDER BY count(*) DESC, primary_type) - 1 AS i
           FROM model_rows GROUP BY primary_type)"""


def split(t: Tables):
    return sampling.hash_split(t.model_table(), SPEC.key, S.TRAIN_FRACTION, S.SAMPLE_SEED)


def fitted(t: Tables, build):
    """Predictions of one model on the random holdout."""
    train, test = split(t)
    with fitting.persisted(fitting.spread(models.class_weights(train), SPEC.key)) as weighted:
        return build.fit(weighted).transform(test)


def checked(predictions):
    """Key and label, and whether the probabilities sum to 1 and the prediction is the likelier class."""
    p = vector_to_array("probability")
    sums = (F.abs(p[0] + p[1] - 1) < 1e-9) & p[1].between(0, 1)
    likelier = F.col("prediction") == (p[1] > p[0]).cast("double")
    return predictions.select(SPEC.key, "label", (sums & likelier).alias("agrees"))


CHECKED_SQL = f"WITH {TEST_SQL} SELECT crime_id, label, true AS agrees FROM test"


def recomputed(comparison):
    """Model, split and label counts of each row, and whether its rates follow from its counts."""
    tp, fp, fn, tn = (
        F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative")
    )

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    rates = {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "specificity": ratio(tn, tn + fp),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": (ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2,
    }
    follow = F.col("area_under_roc").between(0, 1) & F.col("area_under_pr").between(0, 1)
    for name, value in rates.items():
        follow = follow & (F.abs(F.col(name) - value) < 1e-9)
    return comparison.select(
        "model_name",
        "validation_strategy",
        "temporal_cutoff_year",
        (tp + fn).alias("positives"),
        (fp + tn).alias("negatives"),
        follow.alias("rates_follow"),
    )


@query("c1_model_table", f"WITH {MODEL_TABLE_SQL} SELECT * FROM model_rows", floats=NUMBERS)
def c1_model_table(t: Tables):
    return t.model_table()


@query(
    "c2_class_weights",
    f"""WITH {MODEL_TABLE_SQL} SELECT crime_id, label,
        (SELECT count(*) FROM model_rows) / (2 * count(*) OVER (PARTITION BY label)) AS class_weight FROM model_rows""",
    floats=["class_weight"],
)
def c2_class_weights(t: Tables):
    return models.class_weights(t.model_table()).select("crime_id", "label", "class_weight")


@query(
    "a27_require_classes",
    f"WITH {MODEL_TABLE_SQL} SELECT label, count(*) AS records FROM model_rows GROUP BY label",
)
def a27_require_classes(t: Tables):
    """Rows per label, once it is sure that both occur."""
    rows = models.require_classes(t.model_table(), "The model table")
    return rows.groupBy("label").agg(F.count("*").alias("records"))


def kept(t: Tables, name: str):
    """Writes a table to a fresh folder and reads it back."""
    folder = files.scratch_dir(t.spark)
    return lambda df: files.stage(df, folder, name)


@query(
    "c3_category_index",
    f"""WITH {INDEX_SQL} SELECT crime_id, primary_type, i::DOUBLE AS primary_type_index
        FROM model_rows JOIN ranked USING (primary_type)""",
)
def c3_category_index(t: Tables):
    rows = t.model_table().select("crime_id", "primary_type")
    return models.with_category_index(rows, models.category_table(rows, "primary_type", kept(t, "types")), "primary_type")


@query(
    "c3_many_categories",
    """WITH named AS (SELECT l_orderkey, l_linenumber, l_extendedprice::DECIMAL(18, 2)::VARCHAR AS price FROM lineitem),
       ranked AS (SELECT price, row_number() OVER (ORDER BY count(*) DESC, price) - 1 AS i
                  FROM named WHERE l_linenumber <> 3 GROUP BY price)
       SELECT l_orderkey, l_linenumber, price, coalesce(i, (SELECT count(*) FROM ranked))::DOUBLE AS price_index
       FROM named LEFT JOIN ranked USING (price)""",
)
def c3_many_categories(t: Tables):
    """Nearly as many categories as rows; what only third lines have is unseen."""
    rows = t.read("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "string(cast(l_extendedprice as decimal(18, 2))) AS price"
    )
    table = models.category_table(rows.filter("l_linenumber <> 3"), "price", kept(t, "prices"))
    return models.with_category_index(rows, table, "price")


@query(
    "c4_category_one_hot",
    f"""WITH {INDEX_SQL} SELECT crime_id, i + 1 AS hot_position, (SELECT count(*) + 2 FROM ranked) - 1 AS width,
        1.0::DOUBLE AS total FROM model_rows JOIN ranked USING (primary_type)""",
)
def c4_category_one_hot(t: Tables):
    """Position of the one, width and sum of the one-hot vector."""
    rows = t.model_table().select("crime_id", "primary_type")
    table = models.category_table(rows, "primary_type", kept(t, "types"))
    indexed = models.with_category_index(rows, table, "primary_type")
    values = vector_to_array("primary_type_vector")
    return models.with_one_hot(indexed, "primary_type", table.count()).select(
        "crime_id",
        F.array_position(values, F.lit(1.0)).alias("hot_position"),
        F.size(values).cast("long").alias("width"),
        F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("total"),
    )


@query("c5_random_forest", CHECKED_SQL)
def c5_random_forest(t: Tables):
    return checked(fitted(t, models.rf_pipeline(SPEC, True)))


@query(
    "c5_random_forest_unweighted",
    f"WITH {TEST_SQL} SELECT label, count(*) AS records FROM test GROUP BY label",
)
def c5_random_forest_unweighted(t: Tables):
    """Rows per label in the confusion table of the unweighted forest."""
    table = evaluate.confusion(fitted(t, models.rf_pipeline(SPEC, False)))
    return table.groupBy("label").agg(F.sum("count").alias("records"))


@query("c6_boosted_trees", CHECKED_SQL)
def c6_boosted_trees(t: Tables):
    return checked(fitted(t, models.gbt_pipeline(SPEC)))


@query("c7_logistic_regression", CHECKED_SQL)
def c7_logistic_regression(t: Tables):
    return checked(fitted(t, models.lr_pipeline(SPEC)))


@query(
    "c8_majority_baseline",
    f"""WITH {MODEL_TABLE_SQL}, test AS (SELECT * FROM model_rows WHERE {key_hash_sql('crime_id')} >= {TRAIN_BOUND}),
        c AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM test)
        SELECT 'majority_class_baseline' AS model_name, 'seeded_random_holdout' AS validation_strategy,
               0::BIGINT AS temporal_cutoff_year, 0::BIGINT AS true_positive, 0::BIGINT AS false_positive,
               p AS false_negative, n AS true_negative, 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall,
               1.0::DOUBLE AS specificity, 0.0::DOUBLE AS f1_score, 0.5::DOUBLE AS balanced_accuracy,
               0.5::DOUBLE AS area_under_roc, p / (p + n) AS area_under_pr FROM c""",
    floats=["area_under_pr"],
)
def c8_majority_baseline(t: Tables):
    _, test = split(t)
    return models.comparison_table(t.spark, models.compare_models({}, test))


def holdout_rows(t: Tables):
    """Baseline and all models on the random holdout."""
    train, test = split(t)
    return models.comparison_table(t.spark, models.compare_models(models.fit_models(train, SPEC), test))


@query("c9_compare_models", f"WITH {COMPARED_SQL} SELECT * FROM holdout")
def c9_compare_models(t: Tables):
    return recomputed(holdout_rows(t))


@query("c10_compare_temporal", f"WITH {COMPARED_SQL} SELECT * FROM temporal")
def c10_compare_temporal(t: Tables):
    return recomputed(models.comparison_table(t.spark, models.compare_temporal(t.model_table(), SPEC)))


@query(
    "c11_selected_metrics",
    f"WITH {COMPARED_SQL} SELECT * FROM holdout WHERE model_name = '{models.SELECTED[0]}'",
)
def c11_selected_metrics(t: Tables):
    """Comparison row of the selected model, from its own fit."""
    train, test = split(t)
    with fitting.persisted(fitting.spread(models.class_weights(train), SPEC.key)) as weighted:
        model = models.rf_pipeline(SPEC, True).fit(weighted)
    rows = models.comparison_rows(models.scored_rows({models.SELECTED[0]: model}, test), models.SELECTED[1])
    return recomputed(models.selected_metrics(models.comparison_table(t.spark, rows)))


@query("r9_rates_by_model", f"WITH {COMPARED_SQL} SELECT model_name, rates_follow FROM holdout")
def r9_rates_by_model(t: Tables):
    """All models on the random holdout, by rising F1."""
    return recomputed(ordered(holdout_rows(t), "f1_score")).select("model_name", "rates_follow")


@query("r9_model_rates", order="f1_score")
def r9_model_rates(t: Tables):
    """Precision, recall and F1 of all models on the random holdout, by rising F1."""
    return ordered(holdout_rows(t), "f1_score").select("model_name", "precision", "recall", "f1_score")


@query(
    "c12_prediction_output",
    f"WITH {SCORED_SQL} SELECT l_orderkey, label, prediction, score AS probability_of_one FROM scored",
    floats=["probability_of_one"],
)
def c12_prediction_output(t: Tables):
    vector = array_to_vector(F.array(1 - F.col("score"), F.col("score")))
    return models.prediction_output(
        t.scored().withColumn("probability", vector), "l_orderkey", "probability_of_one"
    )


def importance(t: Tables):
    train, _ = split(t)
    with fitting.persisted(fitting.spread(models.class_weights(train), SPEC.key)) as weighted:
        model = models.rf_pipeline(SPEC, True).fit(weighted)
    return models.feature_importance(model, SPEC, t.spark)


IMPORTANCE_SQL = f"""WITH {MODEL_TABLE_SQL} SELECT unnest({[*SPEC.numbers, SPEC.category]}) AS feature,
    true AS sums_to_one FROM (SELECT 1 FROM model_rows LIMIT 1)"""


def sums_to_one(table):
    """Features of an importance table, and whether their shares sum to 1."""
    total = over_all(F.sum("importance"))
    return table.select("feature", (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query("c13_feature_importance", IMPORTANCE_SQL)
def c13_feature_importance(t: Tables):
    return sums_to_one(ordered(importance(t), F.desc("importance")))


@query("c13_importance_values", order="importance DESC")
def c13_importance_values(t: Tables):
    return ordered(importance(t), F.desc("importance"))


@query("r7_importance_ascending", IMPORTANCE_SQL)
def r7_importance_ascending(t: Tables):
    return sums_to_one(ordered(importance(t), "importance"))


@query("r7_importance_values", order="importance")
def r7_importance_values(t: Tables):
    return ordered(importance(t), "importance")
