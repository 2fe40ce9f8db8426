"""Operators without SQL against plain computations, round trips and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tallyfield.llm import katz, packing, suffixes, tokens
from tallyfield.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def texts(spark):
    return dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())


def test_token_counts_are_the_librarys(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    for row in QUERIES["op1_token_counts"](spark, SF_DIR).collect():
        assert row["n_tokens"] == len(library.encode(texts[row["doc_id"]], add_special_tokens=False).ids)


def test_transducer_on_odd_texts_and_small_chunks():
    from tokenizers import Tokenizer

    library, counter, rng = Tokenizer.from_file(tokenizer_path()), tokens.token_counter(tokenizer_path()), random.Random(1)
    alphabet = "abcthein'sreABÉèßñ012 \t\n\x1c\x85　.!?-_<|>endoftext漢İ́‍😀"
    for i in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) + "<|endoftext|>" * (i % 7 == 0)
        wanted = len(library.encode(text, add_special_tokens=False).ids)
        assert counter.offsets(text)[-1] == counter.offsets(text, 3)[-1] == wanted


def test_ids_of_odd_texts_and_long_runs_are_the_librarys():
    from tokenizers import Tokenizer

    library, encoder, rng = Tokenizer.from_file(tokenizer_path()), packing.token_ids(tokenizer_path()), random.Random(7)
    alphabet = "abcthein'sreABÉèßñ012 \t\n\x1c\x1d\x1e\x1f\x85\u3000.!?-_<|>endoftext漢İ́‍😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) + "<|endoftext|>" * (i % 7 == 0) for i in range(3000)]
    texts += ["a\x1cb", "\x1f", "x" * 100_000, "漢字" * 20_000, "Ab1-" * 30_000]
    for text in texts:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.of(text), f"<u{len(encoder.packed([1]))}").tolist() == wanted
        assert tokens.token_counter(tokenizer_path()).offsets(text)[-1] == len(wanted)
    assert max(map(len, [*encoder.runs, *encoder.parts])) <= tokens.SHORT


def test_packing_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(300):
        window = rng.choice([5, 16, 31, 64])
        lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 60))]
        bins = []
        for length in sorted(lengths, reverse=True):
            fitting = [(b, i) for i, b in enumerate(bins) if b >= length]
            if fitting:
                bins[min(fitting)[1]] -= length
            else:
                bins.append(window - length)
        filled = Counter()
        for length, _, pieces, first, each, offset in packing.plan(Counter(lengths).items(), window):
            for k in range(pieces):
                assert filled[first + k // each] == offset + k % each * length
                filled[first + k // each] += length
        assert sorted(window - n for n in filled.values()) == sorted(bins)


def test_pieces_are_the_librarys_ids(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    for row in QUERIES["op7_packing"](spark, SF_DIR).collect():
        ids = np.array([*library.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 1], "<u4")
        part = ids[row["start"] : row["start"] + row["length"]]
        assert row["doc_tokens"] == len(ids) and row["ids_crc32"] == zlib.crc32(part.tobytes())


def test_katz_is_normalised_and_equal_to_plain_python(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op8_katz_scores"](spark, SF_DIR).collect()}
    words = {k: katz.tokens_of(t) for k, t in texts.items()}
    train = [k for k in words if zlib.crc32(str(k).encode()) % 10]
    c1 = Counter(w for k in train for w in words[k])
    c2 = Counter(p for k in train for p in zip([None, *words[k]], words[k]))
    before = Counter(h for k in train for h in [None, *words[k][:-1]])
    small = range(1, katz.DISCOUNTED + 2)
    d1, d2 = (katz.discount(np.array([sum(v == r for v in c.values()) for r in small])).factors for c in (c1, c2))
    kept = lambda d, c: c * d[c] if c <= katz.DISCOUNTED else c
    total = sum(c1.values())
    p1 = {w: kept(d1, c) / total for w, c in c1.items()}
    unseen = 1 - sum(p1.values())
    follow = defaultdict(dict)
    for (h, w), c in c2.items():
        follow[h][w] = c
    size, weight = {}, {}
    for h, after in follow.items():
        size[h] = before[h] + all(c > katz.DISCOUNTED for c in after.values())
        weight[h] = (1 - sum(kept(d2, c) for c in after.values()) / size[h]) / (1 - sum(p1[w] for w in after))
    for h in [None, *list(follow)[:20]]:
        rest = sum(p for w, p in p1.items() if w not in follow[h]) + unseen
        assert abs(sum(kept(d2, c) for c in follow[h].values()) / size[h] + weight[h] * rest - 1) < 1e-9
    for key, tokens_ in words.items():
        score = 0.0
        for h, w in zip([None, *tokens_], tokens_):
            c = c2.get((h, w))
            score += math.log10(kept(d2, c) / size[h] if c else weight.get(h, 1.0) * p1.get(w, unseen))
        assert got[key]["score"] == pytest.approx(score, rel=1e-9) and got[key]["train_tokens"] == total


@pytest.mark.parametrize("seed", range(12))
def test_index_family_finds_all_repeats(monkeypatch, seed):
    rng = random.Random(seed)
    span = rng.choice([40, 57, 100])
    for name, sizes in (("SEGMENT", [16, 2048]), ("PIECE", [50, 1 << 20]), ("BATCH_BYTES", [200, 1 << 20])):
        monkeypatch.setattr(suffixes, name, rng.choice(sizes))
    base = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(30, 300))) for _ in range(4)]
    docs = [b"".join(rng.choice(base)[: rng.randint(10, 300)] for _ in range(rng.randint(0, 5))) for _ in range(12)]
    docs += [b"ab" * 100, b"x" * 150]
    seen = Counter(d[i : i + span] for d in docs for i in range(len(d) - span + 1))
    found = [(k, *a) for k, d in enumerate(docs) for a in suffixes.anchored(d, span)]
    places = Counter()
    for _, anchor, _, _, n in found:
        places[anchor] += n
    hot, segments, at = rng.choice([1, 10**9]), {}, []
    for k, anchor, first, last, _ in found:
        if places[anchor] > 1:
            whole = [(anchor, first, last)]
            for a, f, e in suffixes.split_hot(docs[k], *whole[0], span) if places[anchor] > hot else whole:
                name = repr((a, docs[k][f : e + span])).encode()
                segments.setdefault(name, [a, docs[k][f : e + span], 0])[2] += 1
                at.append((k, f, name))
    family, items, size = suffixes.IndexFamily(span), list(segments.items()), rng.choice([1, 2, 5, 100])
    for i in range(0, len(items), size):
        part = items[i : i + size]
        family.add([n for n, _ in part], [s[0] for _, s in part], [s[1] for _, s in part], [s[2] > 1 for _, s in part])
    runs, got = dict(family.repeats()), defaultdict(set)
    for k, first, name in at:
        flat = runs.get(name, [])
        for a, b in zip(flat[::2], flat[1::2]):
            got[k] |= set(range(first + a, first + b + 1))
    for k, d in enumerate(docs):
        assert got[k] == {i for i in range(len(d) - span + 1) if seen[d[i : i + span]] > 1}


def test_held_out_accuracy(spark):
    scored = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.01").where("held_out")
    scored = scored.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    assert scored.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95
    named = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").where("held_out").alias("a")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    assert named.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_near_edited_is_told_from_next(spark):
    rows = QUERIES["op5_fingerprints"](spark, SF_DIR).where("n_chars > 500")
    edited, after = rows.agg(F.percentile("near_edited", F.lit(0.1)), F.percentile("near_next", F.lit(0.9))).first()
    assert edited > 0.15 and after < 0.1
