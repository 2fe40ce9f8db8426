"""Evaluation of binary predictions; every table is a grouped aggregate of the scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shares import MAX_RANGES, prefix_sum, running_sums

# Probability thresholds of the trade-off table.
THRESHOLDS = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def confusion(df: DataFrame) -> DataFrame:
    """Rows per (label, prediction); combinations that do not occur are absent."""
    return df.groupBy("label", "prediction").count()


def _count(label: int, prediction: int) -> Column:
    return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))


def _ratio(part: Column, whole: Column, least: float = 1) -> Column:
    return part / F.greatest(whole, F.lit(least))


COUNTS = ("true_positive", "false_positive", "false_negative", "true_negative")
RATES = ("precision", "recall", "specificity", "f1_score", "balanced_accuracy", "positive_share")


def _rates(counts: DataFrame) -> DataFrame:
    """Add the rates made from confusion counts; 0/0 is 0.0."""
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    precision, recall, specificity = F.col("precision"), F.col("recall"), F.col("specificity")
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "specificity": _ratio(tn, tn + fp),
            "positive_share": _ratio(tp + fn, tp + fp + fn + tn),
        }
    ).withColumns(
        {
            "f1_score": _ratio(2 * precision * recall, precision + recall, 1e-12),
            "balanced_accuracy": (recall + specificity) / 2,
        }
    )


def binary_metrics(df: DataFrame) -> DataFrame:
    """Confusion counts and the rates made from them, in one row; 0/0 is 0.0."""
    counts = df.agg(
        _count(1, 1).alias("true_positive"),
        _count(0, 1).alias("false_positive"),
        _count(1, 0).alias("false_negative"),
        _count(0, 0).alias("true_negative"),
    )
    return _rates(counts).select(*COUNTS, *RATES)


def _steps(df: DataFrame, score: str) -> DataFrame:
    """Positive and negative rows per distinct score, with running sums in descending order."""
    labelled = df.select(
        score,
        (F.col("label") == 1).cast("long").alias("positive"),
        (F.col("label") == 0).cast("long").alias("negative"),
    )
    return prefix_sum(labelled, score, ["positive", "negative"])


def _areas() -> list[Column]:
    """Both areas as aggregates of steps with running sums.

    The trapezoids follow from the running counts per distinct score, so the curve is never thinned, however many
    scores there are.
    """
    positive, negative, hits, misses = (
        F.col(c).cast("double") for c in ("positive", "negative", "running_positive", "running_negative")
    )
    precision = F.try_divide(hits, hits + misses)
    before = F.try_divide(hits - positive, hits + misses - positive - negative)
    positives, negatives = (F.max(c).cast("double") for c in ("total_positive", "total_negative"))
    return [
        F.try_divide(F.sum(negative * (hits - positive / 2)), positives * negatives).alias("area_under_roc"),
        F.try_divide(
            F.sum(positive * (precision + F.coalesce(before, precision)) / 2), positives
        ).alias("area_under_pr"),
    ]


def areas(df: DataFrame, score: str) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve, in one row; NULL without the labels they need."""
    return _steps(df, score).agg(*_areas())


SCORE_COUNTS = ("positive", "negative", "hit", "miss")


def score_counts(df: DataFrame, score: str, by: str) -> DataFrame:
    """Rows per label, and those of them that are predicted 1, for each group and score."""
    label, predicted = F.col("label"), F.col("prediction") == 1
    counted = [label == 1, label == 0, (label == 1) & predicted, (label == 0) & predicted]
    sums = [F.sum(value.cast("long")).alias(name) for name, value in zip(SCORE_COUNTS, counted)]
    return df.groupBy(by, score).agg(*sums)


def compare(df: DataFrame, score: str, by: str) -> DataFrame:
    """Confusion counts, rates and exact areas of each group of predictions, from one shuffle of counts per score."""
    return compare_counts(score_counts(df, score, by), score, by)


def compare_counts(counts: DataFrame, score: str, by: str) -> DataFrame:
    """``compare`` from the counts per score. They are read several times, so keep what is costly to compute."""
    steps = running_sums(counts, score, SCORE_COUNTS, by=by)
    hit, miss, positive, negative = (F.max(f"total_{c}") for c in ("hit", "miss", "positive", "negative"))
    counts = steps.groupBy(by).agg(
        hit.alias("true_positive"),
        miss.alias("false_positive"),
        (positive - hit).alias("false_negative"),
        (negative - miss).alias("true_negative"),
        *_areas(),
    )
    return _rates(counts).select(by, *COUNTS, *RATES, "area_under_roc", "area_under_pr")


def threshold_metrics(df: DataFrame, score: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Counts, precision, recall and F1 when ``score >= threshold`` predicts 1; 0/0 is NULL.

    Rows are first counted by label and by how many thresholds they reach. Only these few counts
    are unfolded over the thresholds, never the rows.
    """
    ordered = sorted(thresholds)
    reached = F.lit(0)
    for value in ordered:
        reached = reached + (F.col(score) >= value).cast("int")
    scored = df.filter(F.col(score).isNotNull())
    counts = scored.groupBy(reached.alias("_reached"), "label").agg(F.count("*").alias("_rows"))
    unfolded = counts.select(
        "_reached", "label", "_rows", F.posexplode(F.array(*[F.lit(float(t)) for t in ordered]))
    )
    positive = F.col("_reached") > F.col("pos")

    def total(label: int, predicted: Column) -> Column:
        return F.sum(F.when((F.col("label") == label) & predicted, F.col("_rows")).otherwise(F.lit(0)))

    table = unfolded.groupBy(F.col("col").alias("threshold")).agg(
        total(1, positive).alias("true_positive"),
        total(0, positive).alias("false_positive"),
        total(1, ~positive).alias("false_negative"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    precision, recall = F.col("precision"), F.col("recall")
    return table.withColumns(
        {"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn)}
    ).withColumn("f1_score", F.try_divide(2 * precision * recall, precision + recall))


def _corners(steps: DataFrame, ranges: int) -> DataFrame:
    """Steps behind which the curve turns, or ends, by exact cross products of each step and the next one.

    The next step is looked for inside a range of running counts, and the last one of a range gets the first step of the
    next range from a table with a row for each range. So the result does not depend on the ranges.
    """
    before = F.col("running_positive") + F.col("running_negative") - F.col("positive") - F.col("negative")
    total = F.greatest(F.col("total_positive") + F.col("total_negative"), F.lit(1))
    step = F.struct(*[F.col(c).cast("decimal(19,0)").alias(c) for c in ("positive", "negative")])
    placed = steps.filter("positive + negative > 0").withColumns(
        {"_before": before, "_range": F.floor(before * ranges / total), "_step": step}
    )
    firsts = placed.groupBy("_range").agg(F.min_by("_step", "_before").alias("_first"))
    by_range = Window.partitionBy(F.lit(0)).orderBy("_range")  # at most a row a range
    following = firsts.select(F.col("_range").alias("_of"), F.lead("_first").over(by_range).alias("_following"))
    inside = Window.partitionBy("_range").orderBy("_before")
    next_ = F.coalesce(F.lead("_step").over(inside), F.col("_following"))
    joined = placed.join(F.broadcast(following), F.col("_range") == F.col("_of")).withColumn("_next", next_)
    cross = F.col("_step.positive") * F.col("_next.negative") != F.col("_step.negative") * F.col("_next.positive")
    return joined.filter(F.col("_next").isNull() | cross)


def roc_curve(df: DataFrame, score: str, compact: bool = False) -> DataFrame:
    """Running true and false positive rate per distinct score, descending, with both end points.

    ``compact`` leaves out points on a straight line between their neighbours: the same curve from fewer points.
    """
    steps = _steps(df, score)
    if compact:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        steps = _corners(steps, max(1, min(ranges, MAX_RANGES)))
    points = steps.select(
        F.try_divide(F.col("running_negative"), F.col("total_negative")).alias("false_positive_rate"),
        F.try_divide(F.col("running_positive"), F.col("total_positive")).alias("true_positive_rate"),
    )
    ends = df.sparkSession.range(2).select(
        F.col("id").cast("double").alias("false_positive_rate"),
        F.col("id").cast("double").alias("true_positive_rate"),
    )
    return ends.unionByName(points)
