"""Evaluation, running sums, samples, splits, and their independence of partitioning."""

import bisect
import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyfield.functions.labels import positive_score
from tallyfield.operators import contracts, evaluate, models, ordering, sampling, series, shares
from tallyfield.plans import schemas as S
from tallyfield.sources import files


def scored(spark):
    rows = [(0.9, 1.0), (0.8, 1.0), (0.7, 0.0), (0.3, 1.0), (0.1, 0.0)]
    return spark.createDataFrame(rows, "score double, label double")


def test_positive_score(spark):
    vector = scored(spark).select(array_to_vector(F.array(1 - F.col("score"), "score")).alias("p"))
    assert [r[0] for r in vector.select(positive_score(F.col("p"))).collect()] == [0.9, 0.8, 0.7, 0.3, 0.1]


def test_roc_has_both_end_points(spark):
    points = {tuple(r) for r in evaluate.roc_curve(scored(spark), "score").collect()}
    assert {(0.0, 0.0), (1.0, 1.0), (0.0, 1 / 3), (0.5, 2 / 3)} <= points


def test_thresholds(spark):
    table = {r.threshold: r for r in evaluate.threshold_metrics(scored(spark), "score").collect()}
    assert sorted(table) == list(evaluate.THRESHOLDS)
    assert table[0.2].recall == 1.0 and table[0.8].precision == 1.0
    assert (table[0.3].true_positive, table[0.3].false_positive) == (3, 1)


def test_thresholds_without_positives_are_null(spark):
    rows = spark.createDataFrame([(0.1, 0.0)], "score double, label double")
    row = evaluate.threshold_metrics(rows, "score").first()
    assert (row.precision, row.recall, row.f1_score) == (None, None, None)


def test_metrics_of_one_class_and_of_no_rows(spark):
    rows = spark.createDataFrame([(0.0, 0.0)], "label double, prediction double")
    for df in (rows, rows.limit(0)):
        row = evaluate.binary_metrics(df).first()
        assert (row.precision, row.recall, row.f1_score, row.true_positive) == (0.0, 0.0, 0.0, 0)


def test_class_weights_balance_the_classes(spark):
    rows = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    totals = models.class_weights(rows).groupBy("label").agg(F.sum("class_weight").alias("w")).collect()
    assert [round(r.w, 9) for r in totals] == [2.0, 2.0]


@pytest.mark.parametrize("values", [[0.0], [1.0], [0.0, 1.0, 2.0], []])
def test_class_weights_need_exactly_two_classes(spark, values):
    with pytest.raises(ValueError, match="label must hold 0 and 1"):
        models.class_weights(spark.createDataFrame([(v,) for v in values], "label double"))


def running(spark, rows, ranges):
    return [tuple(r) for r in shares.prefix_sum(rows, "o", ["n"], ranges).orderBy(F.desc_nulls_last("o")).collect()]


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_prefix_sum_equals_one_window(spark, ranges):
    values = [(float(i * 37 % 101) / 7, i % 5) for i in range(400)] + [(None, 3), (math.inf, 2), (-math.inf, 1)]
    rows = spark.createDataFrame(values, "o double, n int").repartition(5)
    sums = {}
    for o, n in values:
        sums[o] = sums.get(o, 0) + n
    want, total = [], 0
    for o in sorted((v for v in sums if v is not None), reverse=True) + [None]:
        total += sums[o]
        want.append((o, sums[o], total))
    got = running(spark, rows, ranges)
    assert [g[:3] for g in got] == want and {g[3] for g in got} == {total}


def test_prefix_sum_of_one_hot_value(spark):
    order = F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 3000)
    rows = spark.range(3000).select(order.alias("o"), F.lit(1).alias("n"))
    got = running(spark, rows, 8)
    assert got[-1][2] == 3000 and [g[2] for g in got] == sorted(g[2] for g in got)


def test_bounded_sample_is_the_exact_top_by_hash(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    everything = {r.k for r in sampling.hash_sample(rows, "k", 0.5, 42).collect()}
    some = {r.k for r in sampling.bounded_sample(rows, "k", 0.5, 300, 42).collect()}
    assert len(some) == 300 and some < everything
    assert {r.k for r in sampling.bounded_sample(rows, "k", 0.5, 10**6, 42).collect()} == everything
    fewer = {r.k for r in sampling.bounded_sample(rows, "k", 0.5, 20, 42).collect()}
    assert fewer < some


def test_bounded_sample_of_one_hot_key(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), "id")
    assert sampling.bounded_sample(rows, "k", 1.0, 40, 42).count() == 40


def test_sample_below_its_floor_is_an_error(spark):
    with pytest.raises(ValueError, match="floor=10"):
        sampling.training_sample(spark.range(100).withColumnRenamed("id", "k"), "k", 0.0, 10, 42)


def test_areas_are_exact_for_many_scores(spark):
    rows = [(i * 7919 % 5003 / 5003, float((i * i + i // 7) % 3 == 0)) for i in range(5003)]
    ones = [s for s, label in rows if label]
    zeros = sorted(s for s, label in rows if not label)
    roc = sum(bisect.bisect_left(zeros, s) for s in ones) / len(ones) / len(zeros)
    hits, pr, before = 0, 0.0, None
    for seen, (_, label) in enumerate(sorted(rows, reverse=True), 1):
        hits += label
        precision = hits / seen
        pr += label * (precision + (precision if before is None else before)) / 2 / len(ones)
        before = precision
    got = evaluate.areas(spark.createDataFrame(rows, "score double, label double"), "score").first()
    assert got.area_under_roc == pytest.approx(roc, abs=1e-12) and got.area_under_pr == pytest.approx(pr, abs=1e-12)
    none = evaluate.areas(spark.createDataFrame([], "score double, label double"), "score").first()
    assert tuple(none) == (None, None)


def test_split_is_disjoint_and_whole(spark):
    rows = spark.range(2000).withColumnRenamed("id", "k")
    train, test = sampling.hash_split(rows, "k", 0.8, 42)
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    assert 0.75 < train.count() / 2000 < 0.85


def test_temporal_split_of_no_rows_fails(spark):
    with pytest.raises(ValueError, match="at least one row"):
        sampling.temporal_split(spark.createDataFrame([], "year int"), "year", 3)


def both(df, build):
    """The result with 1 and with 7 input partitions, as sorted text."""
    return [sorted(map(str, build(df.repartition(n)).collect())) for n in (1, 7)]


def test_results_do_not_depend_on_partitions(spark, tables):
    lines, facts = tables.read("lineitem"), tables.facts()
    cases = [
        (lines, lambda d: contracts.dedup(d, ["l_orderkey", "l_linenumber"], ["l_shipdate"])),
        (facts, lambda d: sampling.training_sample(d, "crime_id", 0.1, 10, 42)),
        (facts, lambda d: sampling.hash_split(d, "crime_id", 0.8, 42)[0]),
        (facts, lambda d: sampling.bounded_sample(d, "crime_id", 0.5, 100, 42)),
        (facts, lambda d: shares.prefix_sum(d.withColumn("n", F.lit(1)), "latitude", ["n"])),
        (tables.observations(), lambda d: series.hourly_rollup(d, S.HOURLY_WEATHER).select("weather_hour", "weather_station")),
    ]
    for df, build in cases:
        one, seven = both(df, build)
        assert one == seven and one


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_prefix_sum_by_group_equals_one_window_each(spark, ranges):
    values = [(g, None if i % 17 == 0 else float(i * 37 % 101) / 7, i % 5) for i in range(300) for g in ("a", None, "c")]
    rows = spark.createDataFrame(values, "g string, o double, n int").repartition(5)
    got = {(r.g, r.o): tuple(r)[2:] for r in shares.prefix_sum(rows, "o", ["n"], ranges, by="g").collect()}
    for g in ("a", None, "c"):
        alone = shares.prefix_sum(rows.filter(F.col("g").eqNullSafe(F.lit(g))).drop("g"), "o", ["n"], 1)
        for r in alone.collect():
            assert got[g, r.o] == tuple(r)[1:]


@pytest.mark.parametrize("partitions", [1, 8])
def test_compact_curve_keeps_the_area_with_fewer_points(spark, tables, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    rows = tables.read("lineitem").selectExpr("double(l_returnflag = 'R') AS label", "l_extendedprice AS s")
    whole, few = (evaluate.roc_curve(rows, "s", compact=c).collect() for c in (False, True))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    area = lambda curve: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    whole, few = (sorted(map(tuple, curve)) for curve in (whole, few))
    assert len(few) < len(whole) / 1.5 and abs(area(whole) - area(few)) < 1e-12
    assert abs(area(few) - evaluate.areas(rows, "s").first()[0]) < 1e-12


def test_numbers_follow_the_rows_as_they_lie(spark, tmp_path):
    rows = spark.range(1000, numPartitions=7).selectExpr("(id * 37) % 1000 AS v", "id")
    keep = lambda name: lambda df: files.stage(df, str(tmp_path), name)
    got = ordering.number_rows(ordering.ordered(rows, F.desc("v")), "n", keep("sorted")).collect()
    assert all(r.n == 1000 - r.v for r in got) and len(got) == 1000
    broken = ordering.number_rows(rows, "n", keep("unsorted")).collect()
    assert sorted(r.n for r in broken) == list(range(1, 1001)) and any(r.n != 1000 - r.v for r in broken)
    assert ordering.number_rows(rows.limit(0), "n", keep("none")).collect() == []
