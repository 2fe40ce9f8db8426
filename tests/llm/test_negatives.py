"""Hard negatives against a plain computation, and their edges."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallyfield.llm import negatives
from tallyfield.llm.common import scratch

SCHEMA = "vec_id long, label int, vector array<long>, cluster string, score string, bound string"


def plain(rows, positives=5, wanted=5, band=(80, 100)):
    """All pairs, sorted."""
    known = sorted({(k, l, tuple(v)) for k, l, v in rows if None not in (k, l, v) and None not in v})
    out = set()
    for a, label, x in known:
        if a % 3:
            continue
        dot = lambda y: sum(p * q for p, q in zip(x, y))
        scored = sorted({(-dot(v), k, l == label) for k, l, v in known if k != a})
        for minus, p, _ in [s for s in scored if s[2]][:positives]:
            found = [(n, k) for n, k, same in scored if not same and band[0] * -minus <= band[1] * -n <= band[1] * -minus]
            found = sorted(set(found))[:wanted]
            out |= {(a, p, i + 1, k, -minus, -n) for i, (n, k) in enumerate(found)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    with scratch(spark) as folder:
        got = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 3 == 0, folder, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_negatives_are_those_of_a_plain_computation(spark, monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(negatives, "SLICE", 7)
    monkeypatch.setattr(negatives, "RUNGS", (0.1, 0.3, 1.0))
    centres = rng.normal(size=(4, 6)) * 8
    rows = [(i, int(rng.integers(3)), np.rint(centres[rng.integers(4)] + rng.normal(size=6) * rng.choice([1, 4])).astype(int).tolist()) for i in range(90)]
    rows += [(100 + i, int(rng.integers(3)), rows[5][2]) for i in range(30)]  # copies of one vector
    rows += [(200, None, [1] * 6), (201, 1, None), (202, 1, [1, None, 0, 0, 0, 0]), (None, 1, [9] * 6), (204, 2, [0] * 6)]
    rows += [(207, 1, [5, 5]), (210, 2, []), rows[0], rows[0], (0, 2, rows[7][2]), (213, 9, [3] * 6)]
    assert mined(spark, rows) == plain(rows)
    for clusters in (1, 5):
        assert mined(spark, rows, positives=2, negatives=30, band=(50, 90), clusters=clusters) == plain(rows, 2, 30, (50, 90))


def test_few_rows(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(1, 1, [1, 2]), (2, 2, [1, 2])]) == set()  # no anchor
    assert mined(spark, [(3, 1, [1, 2]), (4, 2, [1, 2])]) == set()  # no positive
    assert mined(spark, [(3, 1, [1, 2]), (4, 1, [1, 2]), (5, 2, [1, 2])]) == {(3, 4, 1, 5, 5, 5)}
    assert mined(spark, [(3, 1, [0, 0]), (4, 1, [1, 2]), (5, 2, [-1, 2])]) == {(3, 4, 1, 5, 0, 0)}
    large = 1 << 30
    assert mined(spark, [(3, 1, [large, 1]), (4, 1, [large, 1]), (5, 2, [large, 0])]) == {(3, 4, 1, 5, large**2 + 1, large**2)}


def test_bounds_hold_and_walks_stop_early():
    rng = random.Random(2)
    vectors = np.array([[rng.gauss(0, 1) for _ in range(5)] for _ in range(400)])
    centres = negatives.cluster_centres(vectors[:50], 4)
    to_centre = negatives.angles(vectors[:50], centres)[0]
    own = to_centre.argmin(1)
    widest = np.array([to_centre[own == i, i].max(initial=0) for i in range(len(centres))])
    bounds = negatives.list_bounds(vectors, centres, widest)
    for a, cluster in enumerate(own):
        assert (vectors @ vectors[a] <= bounds[:, cluster] * np.sqrt((vectors[a] ** 2).sum()) + 1e-6).all()
    steps = []

    class Seeker(negatives.PositiveSeeker):
        def meet(self, scores, *rest):
            steps.append(len(scores))
            super().meet(scores, *rest)

    whole = np.rint(vectors * 100).astype(np.int64)
    tight = np.zeros((1, 5)), np.zeros(1)
    tight[0][0] = negatives.unit(whole[:1].astype(float))[0]
    list_ = negatives.list_bounds(whole.astype(float), *tight)[:, 0]
    walker = negatives.Walker(np.repeat(list_, 10), np.zeros(4000, int), np.repeat(whole, 10, 0), [[i] for i in range(4000)], 1e9)
    seeker = Seeker(-1, 0, 5, None)
    walker.walk(whole[:1], [seeker])
    assert sum(steps) < 4000 and [k for _, k in seeker.held] == np.argsort(-(whole @ whole[0]).repeat(10), kind="stable")[:5].tolist()
