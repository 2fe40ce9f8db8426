"""Removal of repeated word windows against a plain computation, and its edges."""

import random

import pytest
from pyspark.sql import functions as F

from tallyfield.llm import factors
from tallyfield.llm.common import scratch


def plain(rows, window):
    """(words, removed, kept) of each row; the smallest (id, start) of a window's words keeps it."""
    order = lambda key: (key is not None, key)
    first = {}
    for key, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            at, now = tuple(words[i : i + window]), (order(key), i)
            first[at] = min(first.get(at, now), now)
    for key, text in rows:
        words = (text or "").encode().split()
        gone = {
            j for i in range(len(words) - window + 1) if first[tuple(words[i : i + window])] < (order(key), i)
            for j in range(i, i + window)
        }
        yield len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def removed(spark, rows, window, kind="long", **options):
    docs = spark.createDataFrame([(i, k, t, "x", "y") for i, (k, t) in enumerate(rows)], f"n int, doc_id {kind}, text string, repeat string, marks string")
    docs = docs.repartition(3).drop("repeat").withColumn("key", F.lit("z"))
    with scratch(spark) as folder:
        marks = factors.repeated_windows(docs, folder, window=window, **options)
        out = {r["n"]: r for r in factors.remove_repeats(docs, marks, window=window).collect()}
    for i in range(len(rows)):
        r = out[i]["repeat"]
        yield r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept"]


@pytest.mark.parametrize("hot", [2, 10, 4096])
def test_repeats_are_those_of_a_plain_computation(spark, hot):
    rng = random.Random(hot)
    base = [[f"{rng.randrange(50)}" for _ in range(rng.randint(5, 80))] for _ in range(6)]
    text = lambda: " ".join(w for _ in range(rng.randint(0, 5)) for w in rng.choice(base)[: rng.randint(3, 80)])
    rows = [(i, text()) for i in range(60)]
    rows += [(70, "a b " * 3000), (71, "a " * 50), (72, "b a " * 40), (73, None), (74, ""), (75, " \t\n "), (76, rows[3][1])]
    rows += [(77, rows[3][1].replace(" ", "  \n")), (78, "Æ 漢字 😀 " * 20)]
    rng.shuffle(rows)
    assert list(removed(spark, rows, 20, hot=hot)) == list(plain(rows, 20))
    assert list(removed(spark, rows, 4, hot=hot)) == list(plain(rows, 4))


def test_repeated_rows_and_rows_without_id(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(2, words), (2, words), (None, "w10 w11 w12 w13 w14 w15"), (None, "z " + words), (-5, "w20 w21 w22 w23 w24 q"), (2, "q " + words)]
    assert list(removed(spark, rows, 5)) == list(plain(rows, 5))
    as_text = [(None if k is None else f"{k}", t) for k, t in rows]
    assert list(removed(spark, as_text, 5, "string")) == list(plain(as_text, 5))


def test_empty_table(spark):
    assert list(removed(spark, [], 20)) == []


def test_a_passage_in_a_third_of_all_texts(spark):
    rng = random.Random(9)
    words = lambda n: " ".join(f"{rng.randrange(10**9)}" for _ in range(n))
    passage = words(27)
    rows = [(i, f"{words(30)} {passage} {words(30)}" if i % 3 == 0 else words(80)) for i in range(300)]
    got = list(removed(spark, rows, 20, hot=20))
    assert got == list(plain(rows, 20)) and sum(n for _, n, _ in got) == 99 * 27


def test_factors_are_the_longest_earlier_ones():
    rng = random.Random(1)
    for _ in range(300):
        segments = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 5))]
        block = factors.ReferenceBlock(segments)
        places = [(i, j) for i, s in enumerate(segments) for j in range(len(s) + 1)]
        for at, (i, j) in enumerate(places):
            if j == len(segments[i]):
                continue
            shared = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            best = max((shared(segments[i][j:], segments[k][m:]) for k, m in places[:at]), default=0)
            assert block.factors[at] == best
