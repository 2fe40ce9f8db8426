"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfield.llm import (
    archives, decontaminate, fingerprints, jaccard, katz, langid, packing, quality, suffixes, tokens,
)
from tallyfield.llm.common import scratch
from tallyfield.llm.queries import tokenizer_path

LONG = " ".join(f"word{i % 977} is{i}" for i in range(30_000))
ROWS = [
    (1, None), (2, ""), (3, "one two three"), (3, "one two three"), (4, LONG), (5, LONG + " more"),
    (None, "a text without an id but with words enough to be one"), (7, " \t\n "), (8, "Æther über naïve 漢字 😀"),
]
SCHEMA = "doc_id long, text string"
CLASHING = (
    "n_tokens", "score", "hit", "repeat", "key", "size", "length", "block", "group", "body", "k", "rank", "label", "tid",
)


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(request, spark):
    rows = ROWS if request.param == "rows" else []
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", F.lit("en").alias("lang"), *[F.lit("x").alias(c) for c in CLASHING])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_token_counts(docs):
    out = tokens.count_tokens(docs, tokenizer_path())
    rows = by_id(out)
    assert out.count() == docs.count()
    if rows:
        assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[7]["n_tokens"] == 0
        assert rows[3]["n_tokens"] == 3 and rows[4]["over_limit"] and rows[1]["chunk_tokens"] == [0]


@pytest.mark.parametrize("labels", [[], [(3, 1), (4, None), (None, 0)], [(3, 1), (4, 0), (4, 0), (8, 1), (5, 0), (99, 1)]])
def test_quality(spark, docs, labels):
    model = quality.fit_classifier(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    out = quality.score_texts(docs, model)
    assert out.count() == docs.count() and all(0 <= r["score"] <= 1 for r in out.collect())
    rows = by_id(out)
    if rows and not labels:
        assert {r["score"] for r in rows.values()} == {0.5}
    if rows and len(labels) == 6:
        assert rows[4]["score"] < rows[3]["score"]


def test_archives(spark, docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a b/\n?").alias("url"), F.col("text").alias("html"), "key")
    with scratch(spark) as folder:
        out = archives.pages_through_warc(pages, folder).collect()
    assert len(out) == pages.count()
    rows = {r["page_id"]: r for r in out}
    if rows:
        assert (rows[1]["record_type"], rows[1]["refers_to"], rows[2]["record_type"]) == ("revisit", 2, "response")
        assert rows[4]["payload_bytes"] == len(LONG) and rows[None]["record_type"] == "response"


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_versions_by_declared_length(version):
    records = [("http://a/", b"x\n\n1 0\nfiledesc://"), ("http://b/", b""), ("http://c/", b"\r\n\r\n")]
    read = list(archives.read_arc(archives.arc_file(version, "f", records)))
    assert [(h["url"], c) for h, c in read[1:]] == records
    assert read[0][0]["url"] == "filedesc://f" and read[0][1].startswith(version.encode())


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_header_fields_from_both_ends(version):
    more = "" if version == "1" else " 200 - - 17 f.arc"
    for url in ("http://a b/20010203040506 c", "http://x/", "dns:a.b"):
        for media in ("text/html", "text/html; charset=utf-8", "no-type"):
            header = archives.arc_header(f"{url} 1.2.3.4 20020304050607 {media}{more} 42".encode(), version)
            assert (header["url"], header["date"], header["type"], header["length"]) == (url, "20020304050607", media, "42")
    with pytest.raises(ValueError, match="No archive date"):
        archives.arc_header(b"http://a/ 42", version)


def test_arc_records_of_all_types(spark):
    names = b"URL IP-address Archive-date Content-type Archive-length\n"
    block = b"1 0 Origin\n" + names
    records = [
        (b"dns:a.b 1.2.3.4 20020304050607 text/dns", b"20020304\na.b. 5 IN A 1.2.3.4\n"),
        (b"http://a b/ 1.2.3.4 20020304050607 text/html; charset=x", b"HTTP/1.1 200 OK\r\nX-Row-Key: 7\r\n\r\nbody"),
        (b"http://c/ 1.2.3.4 20020304050607 image/gif", b"GIF89a"),
        (b"http://d/ 1.2.3.4 20020304050607 text/html", b"HTTP/1.0 404 Not Found"),
    ]
    data = b"filedesc://f.arc 0.0.0.0 20020304050607 text/plain %d\n%s" % (len(block), block)
    data += b"".join(b"\n%s %d\n%s" % (head, len(body), body) for head, body in records)
    data += b"\nhttp://cut/ 1.2.3.4 20020304050607 text/html 1000\nHTTP/1.1 200 OK\r\n\r\nshort"
    arcs = spark.createDataFrame([(data,)], "arc binary")
    with scratch(spark) as folder:
        archives.write_warc(archives.convert_arc(arcs), f"{folder}/warc", folder)
        back = archives.read_warc(spark, f"{folder}/warc").collect()
    got = {r["uri"]: (r["record_type"], r["payload_bytes"], r["row_key"]) for r in back}
    assert got == {
        None: ("warcinfo", len(block), None), "dns:a.b": ("resource", 29, None), "http://a b/": ("response", 4, "7"),
        "http://c/": ("resource", 6, None), "http://d/": ("response", 0, None), "http://cut/": ("response", 5, None),
    }
    dns = next(r for r in back if r["uri"] == "dns:a.b")
    assert dns["payload_digest"] == archives.payload_digest(records[0][1])


def test_jaccard(spark, docs):
    with scratch(spark) as folder:
        out = jaccard.similarity_classes(docs, folder).collect()
    assert len(out) == docs.count()
    rows = {r["doc_id"]: r for r in out}
    if rows:
        assert rows[1]["n_shingles"] == rows[2]["n_shingles"] == rows[7]["n_shingles"] == 0
        assert rows[3]["n_shingles"] == 1 and rows[5]["component_id"] == 4 and rows[4]["n_links"] == 1
        assert rows[2]["component_id"] == 2 and rows[None]["component_id"] is None


def test_fingerprints(docs):
    out = fingerprints.edited_fingerprints(docs).collect()
    assert len(out) == docs.count()
    rows = {r["doc_id"]: r for r in out}
    if rows:
        assert rows[1]["fingerprint"] == rows[2]["fingerprint"] == "" and len(rows[4]["fingerprint"]) == 128
        edited = LONG[: len(LONG) - len(LONG) // 2] + "one two three"[: len(LONG) // 2]
        assert rows[4]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[5]["near_next"] > 0.9


def test_decontamination(spark, docs):
    item = " ".join(LONG.split()[100:120])
    given = [("i", item), ("i", item), ("n", None), ("e", ""), ("s", "ONE, two"), ("w", "zzz")]
    for items in (given, []):
        bench = spark.createDataFrame(items, "item_id string, text string")
        for size in (1 << 24, 10):  # one block, or one for each item
            out = decontaminate.contamination(docs, bench, block_chars=size).collect()
            rows = {r["doc_id"]: r for r in out}
            assert len(out) == docs.count()
            if rows and items:
                assert (rows[4]["n_hit"], rows[4]["n_items"], rows[4]["contaminated"]) == (20, 1, False)
                assert (rows[3]["n_hit"], rows[3]["contaminated"]) == (2, True)
                assert rows[1]["n_words"] == 0 and not rows[1]["contaminated"]


def test_packing(spark, docs):
    with scratch(spark) as folder:
        pieces = packing.token_pieces(docs, tokenizer_path())
        out = packing.pack(pieces, folder)
        rows = out.collect()
        filled = {r["sequence_id"]: r for r in packing.sequence_lengths(out).collect()}
        full = {r["sequence_id"]: r["ids"] for r in packing.padded_sequences(out).collect()}
    assert sum(r["length"] for r in rows) == sum(r["length"] for r in pieces.collect())
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
        assert full[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == np.frombuffer(r["ids"], "<u2").tolist()
    assert sorted(ends) == list(range(len(ends))) and all(len(full[s]) == filled[s]["padded"] for s in ends)


def test_katz(spark, docs):
    for learn in (F.col("doc_id") != 8, F.lit(False)):
        with scratch(spark) as folder:
            out = katz.score_texts(docs, learn, folder, block_tokens=50).collect()
        assert len(out) == docs.count() and all(r["score"] <= 0 and r["base_score"] <= 0 for r in out)
        rows = {r["doc_id"]: r for r in out}
        if rows:
            assert rows[1]["n_tokens"] == rows[7]["n_tokens"] == 1 and rows[3]["n_tokens"] == 4


def test_suffixes(spark, docs):
    with scratch(spark) as folder:
        out = suffixes.remove_repeats(docs, suffixes.repeated_spans(docs, folder)).collect()
    assert len(out) == docs.count()
    rows = {r["doc_id"]: r for r in out}
    if rows:
        assert rows[4]["repeat"]["kept"] == b"" and rows[5]["repeat"]["kept"] == b" more"
        assert rows[1]["repeat"]["n_bytes"] == 0 and bytes(rows[3]["repeat"]["kept"]) == b"one two three"


def test_language(spark, docs):
    with scratch(spark) as folder:
        model = langid.fit_language_model(docs, folder)
    out = langid.predict_language(docs, model).collect()
    assert len(out) == docs.count()
    rows = {r["doc_id"]: r for r in out}
    if rows:
        assert [rows[i]["lang_pred"] for i in (1, 2, 3, 7)] == ["und", "und", "en", "und"]


def test_letters_are_letters_with_their_marks(spark):
    assert langid.words_of("½ ² ① Ⅷ 12_3 ͏") == [] and langid.words_of("x² ½y a_b naïve") == ["x", "y", "a", "b", "naïve"]
    assert langid.words_of("हिन्दी का") == ["हिन्दी", "का"] and langid.words_of("İx") == ["i̇x"]
    both = "Æther straße ªº ÿ"
    assert langid.LETTERS.findall(both.lower()) == langid.words_of(both)
    docs = spark.createDataFrame([(1, "½ ²", "aa"), (2, "①", "aa"), (3, "a word", "aa"), (4, "्", "aa")], "doc_id long, text string, lang string")
    with scratch(spark) as folder:
        model = langid.fit_language_model(docs, folder)
    assert [r["lang_pred"] for r in langid.predict_language(docs, model).orderBy("doc_id").collect()] == ["und", "und", "aa", "und"]


def test_pipeline_stages(spark, docs, tmp_path):
    given = docs.withColumn("n_chars", F.length("text").cast("long"))
    spark.createDataFrame([(3, 1), (8, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "zzz")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, given, str(tmp_path))
        if name != "packing":
            assert out.columns == given.columns and out.schema["n_chars"].dataType == given.schema["n_chars"].dataType
        kept = out.count()
        if name == "ngram_jaccard_join" and docs.count():
            assert kept == len({r[0] for r in ROWS}) - 1  # 5 is a near-duplicate of 4, one row of 3 stays
