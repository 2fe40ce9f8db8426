"""Queries on the evaluation of a fixed score, and on samples and splits."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.labels import positive_score, to_label
from ..operators import evaluate, sampling, shares
from ..operators.ordering import ordered
from ..plans import schemas as S
from .registry import query
from .standins import FACTS_SQL, SCORED_SQL, Tables, key_hash_sql

HASH_RANGE = 1 << 32
STEPS_SQL = f"""{SCORED_SQL},
steps AS (SELECT score, sum(label)::BIGINT AS positive, sum(1 - label)::BIGINT AS negative FROM scored GROUP BY score),
running AS (
  SELECT score, positive, negative, sum(positive) OVER w AS running_positive, sum(negative) OVER w AS running_negative,
         sum(positive) OVER () AS total_positive, sum(negative) OVER () AS total_negative
  FROM steps WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
"""
ROC_SQL = f"""{STEPS_SQL},
roc AS (SELECT 0.0::DOUBLE AS false_positive_rate, 0.0::DOUBLE AS true_positive_rate UNION ALL SELECT 1, 1 UNION ALL
        SELECT running_negative / total_negative, running_positive / total_positive FROM running)"""
THRESHOLD_SQL = f"""{SCORED_SQL},
counts AS (
  SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS true_positive,
         count(*) FILTER (label = 0 AND score >= threshold) AS false_positive,
         count(*) FILTER (label = 1 AND score < threshold) AS false_negative
  FROM scored, (SELECT unnest([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS threshold) GROUP BY threshold),
rates AS (
  SELECT *, true_positive / nullif(true_positive + false_positive, 0) AS precision,
         true_positive / nullif(true_positive + false_negative, 0) AS recall FROM counts),
thresholds AS (
  SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1_score FROM rates)"""


def steps(t: Tables):
    return t.scored().select(
        "score", F.col("label").cast("long").alias("positive"), (1 - F.col("label")).cast("long").alias("negative")
    )


@query(
    "p14_positive_score",
    "SELECT l_orderkey, l_quantity / 50 AS score FROM lineitem",
    floats=["score"],
)
def p14_positive_score(t: Tables):
    vector = array_to_vector(F.array(1 - F.col("score"), F.col("score")))
    return t.scored().select("l_orderkey", positive_score(vector).alias("score"))


@query("p15_to_label", f"WITH {FACTS_SQL} SELECT crime_id, arrest::INTEGER::DOUBLE AS label FROM facts")
def p15_to_label(t: Tables):
    return t.facts().select("crime_id", to_label(F.col("arrest")).alias("label"))


@query("a23_confusion", f"WITH {SCORED_SQL} SELECT label, prediction, count(*) AS count FROM scored GROUP BY ALL")
def a23_confusion(t: Tables):
    return evaluate.confusion(t.scored())


@query(
    "e1_binary_metrics",
    f"""WITH {SCORED_SQL}, c AS (
          SELECT count(*) FILTER (label = 1 AND prediction = 1) AS true_positive,
                 count(*) FILTER (label = 0 AND prediction = 1) AS false_positive,
                 count(*) FILTER (label = 1 AND prediction = 0) AS false_negative,
                 count(*) FILTER (label = 0 AND prediction = 0) AS true_negative FROM scored),
        r AS (SELECT *, true_positive / greatest(true_positive + false_positive, 1) AS precision,
                     true_positive / greatest(true_positive + false_negative, 1) AS recall,
                     true_negative / greatest(true_negative + false_positive, 1) AS specificity FROM c)
        SELECT *, 2 * precision * recall / greatest(precision + recall, 1e-12) AS f1_score,
               (recall + specificity) / 2 AS balanced_accuracy,
               (true_positive + false_negative)
                 / (true_positive + false_positive + false_negative + true_negative) AS positive_share FROM r""",
    floats=["precision", "recall", "specificity", "f1_score", "balanced_accuracy", "positive_share"],
)
def e1_binary_metrics(t: Tables):
    return evaluate.binary_metrics(t.scored())


AREAS_SQL = """points AS (
          SELECT score, running_negative / total_negative AS x, running_positive / total_positive AS y,
                 running_positive / (running_positive + running_negative) AS p FROM running),
        pairs AS (
          SELECT x - coalesce(lag(x) OVER w, 0) AS dx, (y + coalesce(lag(y) OVER w, 0)) / 2 AS my,
                 y - coalesce(lag(y) OVER w, 0) AS dy, (p + coalesce(lag(p) OVER w, p)) / 2 AS mp
          FROM points WINDOW w AS (ORDER BY score DESC))
        SELECT sum(dx * my) AS area_under_roc, sum(dy * mp) AS area_under_pr FROM pairs"""
PRICED_SQL = """
scored AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice AS score FROM lineitem)
"""


@query("e2_areas", f"WITH {STEPS_SQL}, {AREAS_SQL}", floats=["area_under_roc", "area_under_pr"])
def e2_areas(t: Tables):
    return evaluate.areas(t.scored(), "score")


@query(
    "e2_areas_many_scores",
    f"WITH {STEPS_SQL.replace(SCORED_SQL, PRICED_SQL)}, {AREAS_SQL}",
    floats=["area_under_roc", "area_under_pr"],
)
def e2_areas_many_scores(t: Tables):
    """Nearly as many distinct scores as rows."""
    label = (F.col("l_returnflag") == "R").cast("double").alias("label")
    return evaluate.areas(t.read("lineitem").select(label, "l_extendedprice"), "l_extendedprice")


@query(
    "e3_threshold_metrics",
    f"WITH {THRESHOLD_SQL} SELECT * FROM thresholds",
    floats=["threshold", "precision", "recall", "f1_score"],
)
def e3_threshold_metrics(t: Tables):
    return evaluate.threshold_metrics(t.scored(), "score")


@query(
    "j6_threshold_counts",
    f"WITH {THRESHOLD_SQL} SELECT threshold, true_positive, false_positive, false_negative FROM thresholds",
    floats=["threshold"],
)
def j6_threshold_counts(t: Tables):
    table = evaluate.threshold_metrics(t.scored(), "score")
    return table.select("threshold", "true_positive", "false_positive", "false_negative")


@query(
    "r8_rates_by_threshold",
    f"WITH {THRESHOLD_SQL} SELECT threshold, precision, recall, f1_score FROM thresholds",
    floats=["threshold", "precision", "recall", "f1_score"],
    order="threshold",
)
def r8_rates_by_threshold(t: Tables):
    table = evaluate.threshold_metrics(t.scored(), "score")
    return ordered(table.select("threshold", "precision", "recall", "f1_score"), "threshold")


@query("e4_roc_curve", f"WITH {ROC_SQL} SELECT * FROM roc", floats=["false_positive_rate", "true_positive_rate"])
def e4_roc_curve(t: Tables):
    return evaluate.roc_curve(t.scored(), "score")


CORNERS_SQL = f"""{STEPS_SQL},
turns AS (SELECT *, lead(positive) OVER w AS p, lead(negative) OVER w AS n FROM running WINDOW w AS (ORDER BY score DESC)),
corners AS (SELECT 0.0::DOUBLE AS false_positive_rate, 0.0::DOUBLE AS true_positive_rate UNION ALL SELECT 1, 1 UNION ALL
            SELECT running_negative / total_negative, running_positive / total_positive FROM turns
            WHERE p IS NULL OR positive * n <> negative * p)"""
RATES = ["false_positive_rate", "true_positive_rate"]


@query("r1_roc_points", f"WITH {ROC_SQL} SELECT * FROM roc", floats=RATES, order="false_positive_rate, true_positive_rate")
def r1_roc_points(t: Tables):
    return ordered(evaluate.roc_curve(t.scored(), "score"), *RATES)


@query(
    "r1_roc_corners",
    f"WITH {CORNERS_SQL.replace(SCORED_SQL, PRICED_SQL)} SELECT * FROM corners",
    floats=RATES,
    order="false_positive_rate, true_positive_rate",
)
def r1_roc_corners(t: Tables):
    """The curve of nearly as many scores as rows, without points on straight lines."""
    label = (F.col("l_returnflag") == "R").cast("double").alias("label")
    rows = t.read("lineitem").select(label, "l_extendedprice")
    return ordered(evaluate.roc_curve(rows, "l_extendedprice", compact=True), *RATES)


@query(
    "u1_union_end_points",
    f"WITH {ROC_SQL} SELECT false_positive_rate, true_positive_rate, count(*) AS points FROM roc GROUP BY ALL",
    floats=RATES,
)
def u1_union_end_points(t: Tables):
    """How often each point is in the curve: a corner that is a step too is there twice."""
    return evaluate.roc_curve(t.scored(), "score").groupBy(*RATES).agg(F.count("*").alias("points"))


@query(
    "w3_prefix_sum",
    f"WITH {STEPS_SQL} SELECT * FROM running",
    floats=["score"],
    longs=["running_positive", "running_negative", "total_positive", "total_negative"],
)
def w3_prefix_sum(t: Tables):
    return shares.prefix_sum(steps(t), "score", ["positive", "negative"])


@query(
    "w3_prefix_sum_by_group",
    """SELECT o_orderstatus, o_totalprice, orders,
              sum(orders) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC ROWS UNBOUNDED PRECEDING) AS running_orders,
              sum(orders) OVER (PARTITION BY o_orderstatus) AS total_orders
       FROM (SELECT o_orderstatus, o_totalprice, count(*) AS orders FROM orders GROUP BY ALL)""",
    floats=["o_totalprice"],
    longs=["running_orders", "total_orders"],
)
def w3_prefix_sum_by_group(t: Tables):
    rows = t.read("orders").withColumn("orders", F.lit(1))
    return shares.prefix_sum(rows, "o_totalprice", ["orders"], by="o_orderstatus")


@query(
    "e1_binary_metrics_by_group",
    """WITH s AS (SELECT l_linestatus AS model_name, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                 l_quantity / 50 AS score FROM lineitem),
        c AS (SELECT model_name, count(*) FILTER (label = 1 AND score >= 0.5) AS true_positive,
                     count(*) FILTER (label = 0 AND score >= 0.5) AS false_positive,
                     count(*) FILTER (label = 1 AND score < 0.5) AS false_negative,
                     count(*) FILTER (label = 0 AND score < 0.5) AS true_negative FROM s GROUP BY model_name),
        t AS (SELECT model_name, score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY ALL),
        r AS (SELECT *, sum(p) OVER w AS rp, sum(n) OVER w AS rn, sum(p) OVER g AS tp, sum(n) OVER g AS tn FROM t
              WINDOW w AS (PARTITION BY model_name ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
                     g AS (PARTITION BY model_name)),
        a AS (SELECT model_name, sum(n * (rp - p / 2)) / max(tp) / max(tn) AS area_under_roc FROM r GROUP BY model_name)
        SELECT c.*, true_positive / greatest(true_positive + false_positive, 1) AS precision,
               true_positive / greatest(true_positive + false_negative, 1) AS recall, area_under_roc
        FROM c JOIN a USING (model_name)""",
    floats=["precision", "recall", "area_under_roc"],
)
def e1_binary_metrics_by_group(t: Tables):
    """Counts, rates and areas of several groups of predictions from one shuffle of counts."""
    rows = t.read("lineitem").selectExpr(
        "l_linestatus AS model_name", "CASE WHEN l_returnflag = 'R' THEN 1D ELSE 0D END AS label",
        "l_quantity / 50D AS rank", "CASE WHEN l_quantity / 50D >= 0.5D THEN 1D ELSE 0D END AS prediction",
    )
    return evaluate.compare(rows, "rank", "model_name").select(
        "model_name", *evaluate.COUNTS, "precision", "recall", "area_under_roc"
    )


@query(
    "w3_prefix_sum_prices",
    """SELECT o_totalprice, orders, sum(orders) OVER (ORDER BY o_totalprice DESC ROWS UNBOUNDED PRECEDING)
              AS running_orders, sum(orders) OVER () AS total_orders
       FROM (SELECT o_totalprice, count(*) AS orders FROM orders GROUP BY o_totalprice)""",
    floats=["o_totalprice"],
    longs=["running_orders", "total_orders"],
)
def w3_prefix_sum_prices(t: Tables):
    return shares.prefix_sum(t.read("orders").withColumn("orders", F.lit(1)), "o_totalprice", ["orders"])


@query(
    "w2_share_of",
    """SELECT c_nationkey, c_mktsegment, count(*) AS customers,
              round(count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey), 4) AS segment_share
       FROM customer GROUP BY c_nationkey, c_mktsegment""",
)
def w2_share_of(t: Tables):
    counts = t.read("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("customers"))
    return shares.share_of(counts, "c_nationkey", "customers", "segment_share", 4)


@query(
    "o6_training_sample",
    f"""SELECT event_id, ts, value FROM events
        WHERE {key_hash_sql('event_id')} < {round(0.1 * HASH_RANGE)}""",
    floats=["value"],
    times=["ts"],
)
def o6_training_sample(t: Tables):
    rows = t.read("events").select("event_id", "ts", "value")
    return sampling.training_sample(rows, "event_id", 0.1, 20, S.SAMPLE_SEED)


@query(
    "o5_training_floor",
    "SELECT event_id, value FROM events",
    floats=["value"],
)
def o5_training_floor(t: Tables):
    """All rows, once it is sure that they reach the floor."""
    rows = t.read("events").select("event_id", "value")
    return sampling.training_sample(rows, "event_id", 1.0, S.SMALLEST_SAMPLE, S.SAMPLE_SEED)


@query(
    "o7_plot_sample",
    f"""SELECT event_id, value FROM events WHERE {key_hash_sql('event_id')} < {round(S.MAP_FRACTION * HASH_RANGE)}
        ORDER BY {key_hash_sql('event_id')}, event_id LIMIT {S.MAP_CAP}""",
    floats=["value"],
)
def o7_plot_sample(t: Tables):
    rows = t.read("events").select("event_id", "value")
    return sampling.bounded_sample(rows, "event_id", S.MAP_FRACTION, S.MAP_CAP, S.SAMPLE_SEED)


@query(
    "s9_bounded_sample",
    f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
        WHERE {key_hash_sql('l_orderkey')} < {round(0.2 * HASH_RANGE)}
        ORDER BY {key_hash_sql('l_orderkey')}, l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 700""",
    floats=["l_quantity", "l_extendedprice"],
)
def s9_bounded_sample(t: Tables):
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return sampling.bounded_sample(rows, "l_orderkey", 0.2, 700, S.SAMPLE_SEED)


@query(
    "o8_hash_split",
    f"""SELECT CASE WHEN {key_hash_sql('event_id')} < {round(S.TRAIN_FRACTION * HASH_RANGE)} THEN 'train'
               ELSE 'test' END AS part, event_id FROM events""",
)
def o8_hash_split(t: Tables):
    train, test = sampling.hash_split(t.read("events").select("event_id"), "event_id", S.TRAIN_FRACTION, S.SAMPLE_SEED)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "f9_temporal_split",
    """SELECT CASE WHEN year(o_orderdate) < (SELECT max(year(o_orderdate)) - 3 FROM orders) THEN 'train'
              ELSE 'test' END AS part, year(o_orderdate)::INTEGER AS year, count(*) AS rows
       FROM orders GROUP BY ALL""",
)
def f9_temporal_split(t: Tables):
    years = t.read("orders").select(F.year("o_orderdate").alias("year"))
    train, test, _ = sampling.temporal_split(years, "year", 3)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part", "year").agg(F.count("*").alias("rows"))
