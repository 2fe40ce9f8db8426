"""Whole queries and the pipeline against plain Python over the same rows."""

import hashlib
import math
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfield.llm import fingerprints, quality
from tallyfield.llm.queries import QUERIES, tokenizer_path

MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def texts(spark):
    return dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect())


def sql_hash(*values):
    """Spark's ``xxhash64``: each value's hash is the seed of the next."""
    seed = 42
    for kind, v in values:
        data = v.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", v)
        seed = xxhash.xxh64_intdigest(data, seed & MASK)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_print(text, bins=fingerprints.BINS):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text.lower()) if w]
    if not words:
        return ""
    hashes = [sql_hash(("s", w)) for w in words]
    n = fingerprints.SHINGLE
    runs = [hashes] if len(words) < n else [hashes[i : i + n] for i in range(len(words) - n + 1)]
    smallest = {}
    for h in sorted(sql_hash(*[("l", x) for x in run]) for run in runs):
        smallest.setdefault((h & MASK) >> (64 - (bins.bit_length() - 1)), h)
    out = ""
    for i in range(bins):
        at = i if i in smallest else min((sql_hash(("i", i), ("i", b)) & -bins) | b for b in smallest) & (bins - 1)
        out += f"{smallest[at] & 15:x}"
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = sum(x == y for x, y in zip(a, b)) / len(a)
    return max(0.0, (same - 1 / 16) / (1 - 1 / 16))


def test_fingerprints_are_the_plain_ones(spark, texts):
    keys = sorted(texts, reverse=True)
    prints = {k: plain_print(texts[k]) for k in keys}
    got = {r["doc_id"]: r for r in QUERIES["op5_fingerprints"](spark, SF_DIR).collect()}
    assert len(got) == len(keys)
    for key, after in zip(keys, keys[1:] + keys[:1]):
        body, half = texts[key], len(texts[key]) // 2
        edited = body[: len(body) - half] + texts[after][:half]
        row = got[key]
        assert row["n_chars"] == len(body) and row["fingerprint"] == prints[key]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["edited_fingerprint"] == plain_print(edited)
        assert row["near_edited"] == pytest.approx(plain_likeness(prints[key], plain_print(edited)), abs=1e-12)
        assert row["near_next"] == pytest.approx(plain_likeness(prints[key], prints[after]), abs=1e-12)


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_indicators(text):
    lower, shape = [], []
    for word in quality.words_of(text):
        kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
        folded = "".join(c for i, c in enumerate(kinds) if i == 0 or c != kinds[i - 1])
        lower.append(xxhash.xxh3_64_intdigest(word.lower()))
        shape.append(xxhash.xxh3_64_intdigest(folded, seed=1))
    for i in range(1, len(lower)):
        if lower[i] == lower[i - 1]:
            shape[i] ^= 0x5555555555555555
    found = set()
    for values, orders in ((shape, quality.SHAPE_ORDERS), (lower, quality.WORD_ORDERS)):
        values = [mix(v) for v in values]
        for n in orders:
            for i in range(len(values) - n + 1):
                run = n
                for v in values[i : i + n]:
                    run = mix((run * 31 + v) & MASK)
                found.add(run & (quality.BUCKETS - 1))
    return sorted(found)


def test_classifier_scores_are_the_plain_ones(spark, texts):
    """Log ratios, coordinate descent and calibration as loops over dictionaries."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    rows = labels.select("quality", "doc_id", F.xxhash64("doc_id", F.lit(9)).alias("o")).orderBy("o", "doc_id").collect()
    features = {k: plain_indicators(t) for k, t in texts.items()}
    rows = [(bool(r["quality"]), r["o"], features[r["doc_id"]]) for r in rows]
    counts = {side: Counter(b for s, _, f in rows if s is side for b in f) for side in (True, False)}
    total = {side: sum(c.values()) + quality.BUCKETS for side, c in counts.items()}
    ratio = lambda b: math.log((counts[True][b] + 1) / total[True] / ((counts[False][b] + 1) / total[False]))
    scaled = lambda f: [ratio(b) / math.sqrt(sum(ratio(x) ** 2 for x in f)) for b in f]
    apart = [o % 4 == 0 for _, o, _ in rows]
    assert {s for (s, _, _), a in zip(rows, apart) if a} == {s for (s, _, _), a in zip(rows, apart) if not a} == {True, False}
    good = sum(s for s, _, _ in rows)
    cost = {True: 1.0, False: max(1.0, good / (len(rows) - good) / 2)}
    train = [(1 if s else -1, cost[s], f, scaled(f)) for (s, _, f), a in zip(rows, apart) if not a]
    weight, bias, alpha, order = Counter(), 0.0, [0.0] * len(train), np.random.default_rng(0)
    for _ in range(12):
        moved = 0.0
        for i in order.permutation(len(train)).tolist():
            sign, most, f, values = train[i]
            gradient = sign * (sum(weight[b] * v for b, v in zip(f, values)) + bias) - 1
            new = min(max(alpha[i] - gradient / (1 + sum(v * v for v in values)), 0.0), most)
            if new != alpha[i]:
                for b, v in zip(f, values):
                    weight[b] += (new - alpha[i]) * sign * v
                bias += (new - alpha[i]) * sign
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break

    def margin(f):
        norm = math.sqrt(sum(ratio(b) ** 2 for b in f))
        return bias + (sum(weight[b] * ratio(b) for b in f) / norm if norm else 0.0)

    judged = [(margin(f), s) for (s, _, f), a in zip(rows, apart) if a]
    slope, shift = quality.sigmoid_fit(np.array([m for m, _ in judged]), np.array([s for _, s in judged]))
    for row in QUERIES["op2_quality_classifier"](spark, SF_DIR).collect():
        wanted = 1 / (1 + math.exp(-(slope * margin(features[row["doc_id"]]) + shift)))
        assert row["score"] == pytest.approx(wanted, abs=1e-6) and row["predicted"] == (row["score"] >= 0.7)


def lower_words(text, pattern):
    return re.findall(pattern, text.encode().lower().decode())


def plain_spans(texts, span=400):
    """Of each text in UTF-8, the bytes that a string of ``span`` bytes covers which also starts elsewhere, as spans."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    for t in texts:
        spans = []
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1 and spans and i <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + span)
            elif seen[t[i : i + span]] > 1:
                spans.append((i, i + span))
        yield t, spans


def cut_out(data, spans):
    edges = [0, *(x for pair in spans for x in pair), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def test_removed_repeats_are_the_plain_ones(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op9_suffix_dedup"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    for k, (data, spans) in zip(texts, plain_spans(texts.values())):
        row, kept = got[k], cut_out(data, spans)
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(data), len(data) - len(kept), len(spans))
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert any(r["n_removed"] for r in got.values())


def test_repeats_go_by_bytes_and_leave_no_copy(spark, tmp_path):
    """The rule of `op9`: bytes count, not words, and no occurrence is the one that stays."""
    rng = np.random.default_rng(9)
    words = lambda n, digits: " ".join(f"{x:0{digits}d}" for x in rng.integers(0, 10**digits, n))
    short, long = words(57, 6), words(57, 7)
    assert len(short) == 398 and len(long) == 455
    apart = [words(40, 8) + x + p + x + words(40, 8) for x, p in zip("abcde", (short, short, long, long, long))]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(apart)], "doc_id long, text string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    kept = [t.replace(long, "") for t in apart]
    got = {r["doc_id"]: r for r in QUERIES["op9_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert [got[i]["n_removed"] for i in range(5)] == [0, 0, 455, 455, 455]
    assert [got[i]["text"] for i in range(5)] == kept
    stage = corpus_pipeline.repeat_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert [r["text"] for r in stage.orderBy("doc_id").collect()] == kept


def test_pipeline_stages_are_the_plain_ones(spark, tmp_path, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps, kept = dict(corpus_pipeline.STAGES), {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
    assert len(steps) == 5
    of = lambda name: dict(kept[name].select("doc_id", "text").collect())

    model = quality.fit_classifier(spark.read.parquet(f"{SF_DIR}/documents.parquet"), quality.learnable(spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    good = of("quality_classifier")
    assert good == {k: t for k, t in texts.items() if model.score(quality.indicators(t)) >= 0.7}

    sets = {}
    for k, t in good.items():
        words = lower_words(t, "[^\x20\x09-\x0d]+")
        sets[k] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    first = of("ngram_jaccard_join")
    assert first == {k: t for k, t in good.items() if root(k) == k}

    seen = Counter(t.encode()[i : i + 400] for t in first.values() for i in range(len(t.encode()) - 399))
    clean = of("suffix_array_dedup")
    for k, t in first.items():
        data = t.encode()
        gone = {j for i in range(len(data) - 399) if seen[data[i : i + 400]] > 1 for j in range(i, i + 400)}
        assert clean[k] == bytes(c for i, c in enumerate(data) if i not in gone).decode("utf-8", "ignore")

    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    windows = set()
    for (t,) in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect():
        words = lower_words(t or "", pattern)
        n = min(13, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    sizes = {len(w) for w in windows}
    contaminated = set()
    for k, t in clean.items():
        words = lower_words(t, pattern)
        hit = {j for n in sizes for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for j in range(i, i + n)}
        if hit and 20 * len(hit) >= len(words):
            contaminated.add(k)
    left = of("benchmark_decontamination")
    assert left == {k: t for k, t in clean.items() if k not in contaminated}

    from tokenizers import Tokenizer

    library, found = Tokenizer.from_file(tokenizer_path()), {}
    for row in kept["packing"].orderBy("doc_id", "start").collect():
        found.setdefault(row["doc_id"], []).extend(row["ids"])
    assert found == {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in left.items()}
