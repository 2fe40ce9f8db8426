"""Whole jobs: nothing seen is left out, whatever the bounds of a task."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR

import corpus_pipeline
from tallyfield.llm import langid, packing, quality, queries, suffixes
from tallyfield.llm.common import documents, scratch


def plain_language_scores(train, texts):
    """Every count of every language; only parts that no training text has back off."""
    counts, languages = {}, sorted({lang for lang, _ in train})
    totals = {o: np.zeros(len(languages)) for o in "01234"}
    for lang, text in train:
        for word in langid.words_of(text):
            for part in [f"0{word}", *(f"{o}{g}" for o in langid.ORDERS for g in langid.grams(word, o))]:
                counts.setdefault(part, np.zeros(len(languages)))[languages.index(lang)] += 1
                totals[part[0]][languages.index(lang)] += 1
    vector = lambda p: np.log(np.where(counts[p] > 0, counts[p], 0.5) / (totals[p[0]] + 1))
    for text in texts:
        total = np.log((totals["0"] + 1) / (totals["0"] + 1).sum())
        for word in langid.words_of(text):
            for parts in [[f"0{word}"], *([f"{o}{g}" for g in langid.grams(word, o)] for o in langid.ORDERS)]:
                known = [vector(p) for p in parts if p in counts]
                if known:
                    total = total + np.mean(known, axis=0)
                    break
        yield languages[int(total.argmax())], float(1 / np.exp(total - total.max()).sum())


@pytest.mark.parametrize("share", [2e-6, 0.01, 0.2, 2.0])
def test_rare_words_of_a_language_are_seen_words(spark, share):
    train = [("a", "common " * 300 + "rare shared shared thing"), ("b", "common " * 200 + "shared shared shared others"), ("c", "zyx")]
    texts = ["rare", "common rare", "shared", "rarest thing", "shared other common", "zyxw", "漢", "", "qqq common"]
    docs = spark.createDataFrame(train, "lang string, text string")
    with scratch(spark) as folder:
        model = langid.fit_language_model(docs, folder, share=share)
    rows = langid.predict_language(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    got = {r["doc_id"]: r for r in rows.collect()}
    for i, (lang, score) in enumerate(plain_language_scores(train, texts)):
        if texts[i]:
            assert (got[i]["lang_pred"], got[i]["score"]) == (lang, pytest.approx(score, rel=1e-4))
    assert got[texts.index("")]["lang_pred"] == "und"


def test_packing_ends_in_ids(spark):
    docs = documents(spark, SF_DIR).limit(60)
    rows = corpus_pipeline.packing_stage(spark, docs, SF_DIR).collect()
    assert rows
    for row in rows:
        assert row["length"] == len(row["ids"]) and row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())


def test_digests_come_from_the_padded_ids(spark):
    pieces = [(1, 0, 3, 5, b"\x01\0\x02\0\x03\0", 0, 0), (1, 3, 2, 5, b"\x04\0\x05\0", 0, 0), (2, 0, 3, 3, b"\x06\0\x07\0\x08\0", 1, 0)]
    df = spark.createDataFrame(pieces, "doc_id long, start long, length int, doc_tokens long, ids binary, task int, nth long")
    with scratch(spark) as folder:
        packed = packing.pack(df, folder, 6)
        rows = {(r["doc_id"], r["start"]): r for r in packing.pieces_of(packed, ["doc_id", "start"], True, 9, 6).collect()}
        full = {r["sequence_id"]: r["ids"] for r in packing.padded_sequences(packed, 9, 6).collect()}
    assert sorted(map(len, full.values())) == [2, 6]
    for (key, start), row in rows.items():
        ids = [x for k, s, _, _, data, *_ in pieces if (k, s) == (key, start) for x in np.frombuffer(data, "<u2").tolist()]
        there = full[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]]
        assert row["ids"] == there == ids and row["ids_crc32"] == zlib.crc32(np.array(there, "<u4").tobytes())


def test_a_passage_between_different_words_is_counted_start_by_start(spark, monkeypatch):
    rng = random.Random(5)
    words = lambda n: " ".join(f"{rng.randrange(10**9)}" for _ in range(n))
    passage = words(43)[:415]
    texts = [f"{words(60)} {passage} {words(60)}" for _ in range(90)] + [words(150) for _ in range(60)]
    texts += [texts[0], texts[95], "ab" * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    largest = []
    monkeypatch.setattr(suffixes, "HOT_PLACES", 20)
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 5000)
    real = suffixes._single_starts
    monkeypatch.setattr(suffixes, "_single_starts", lambda *a: largest.append(a[1].count()) or real(*a))
    with scratch(spark) as folder:
        rows = suffixes.remove_repeats(docs, suffixes.repeated_spans(docs, folder)).collect()
    assert largest[0] >= 90
    span = suffixes.SPAN
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    for row in rows:
        t = row["text"]
        gone = {j for i in range(len(t) - span + 1) if seen[t[i : i + span]] > 1 for j in range(i, i + span)}
        assert bytes(row["repeat"]["kept"]).decode() == "".join(c for i, c in enumerate(t) if i not in gone)


def test_long_runs_are_read_between_their_edges():
    edge = "Ab" * 16
    one, other = (edge + middle * 40 + edge for middle in ("漢字かな交じり文", "x=1;y[2]+=3;"))
    a, b = set(quality.indicators(one).tolist()), set(quality.indicators(other).tolist())
    assert len(a & b) < len(a) / 2 and "".join(quality.words_of(one)) == one
    assert quality._shape("a" * 24 + "1-2" + "b" * 20) != quality._shape("a" * 44)
    trained = set(quality.indicators(edge + "漢字かな交じり文" * 60).tolist())
    assert len(a & trained) > len(a - trained)  # a text in the same script shares words with it
