"""One query for each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, archives, decontaminate, factors, fingerprints, jaccard, katz, langid, negatives, packing, quality, suffixes, tokens
from .common import documents, id_remainder, keep, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabularies are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    """Register a query and the SQL of the same result."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.count_tokens(documents(spark, sf_dir), tokenizer_path())
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit_classifier(docs, quality.learnable(documents(spark, sf_dir, "labels")))
    held = id_remainder(F.col("doc_id"), 4) == 2
    return quality.score_texts(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query(
    "op3_warc_conversion",
    """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS h
  FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) FOR i IN range(32)], '')
    AS payload_digest
  FROM p
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM m
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        back = archives.pages_through_warc(documents(spark, sf_dir, "pages"), folder)
        return keep(back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(
    "op6_decontamination",
    rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        packed = packing.pack(packing.token_pieces(documents(spark, sf_dir), tokenizer_path()), folder)
        found = packing.pieces_of(packed, ["doc_id", "start", "doc_tokens"])
        return keep(found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    with scratch(spark) as folder:
        held = id_remainder(F.col("doc_id"), 5) == 0
        model = langid.fit_language_model(docs.where(~held), folder)
        found = langid.predict_language(docs, model)
        return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query(
    "op4_jaccard_join",
    """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
  FROM w WHERE len(w) > 0
), sets AS (
  SELECT list_sort(s) AS s, min(doc_id) AS id, len(any_value(s)) AS n FROM s GROUP BY 1
), t AS (
  SELECT id, n, unnest(s) AS t FROM sets
), pairs AS (
  SELECT a.id AS x, b.id AS y, count(*) AS common_n, any_value(a.n + b.n) AS total
  FROM t a JOIN t b ON a.t = b.t AND a.id < b.id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs WHERE 100 * common_n >= 80 * (total - common_n)
), edges AS (
  SELECT x AS u, y AS v FROM links UNION ALL SELECT y, x FROM links
), reach(u, v) AS (
  SELECT id, id FROM sets UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u
), low AS (
  SELECT u, min(v) AS c FROM reach GROUP BY 1
), degree AS (
  SELECT u, count(*) AS n_links FROM edges GROUP BY 1
)
SELECT w.doc_id, coalesce(sets.n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id,
  coalesce(n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN s ON w.doc_id = s.doc_id LEFT JOIN sets ON list_sort(s.s) = sets.s
  LEFT JOIN low ON sets.id = low.u LEFT JOIN degree ON sets.id = degree.u
""".replace("\\\\", "\\"),
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        return keep(jaccard.similarity_classes(documents(spark, sf_dir), folder))


@query("op8_katz_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = id_remainder(F.col("doc_id"), 10) == 0
    with scratch(spark) as folder:
        scored = katz.score_texts(docs, ~held, folder)
        return keep(
            scored.select(
                "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
            )
        )


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    with scratch(spark) as folder:
        marks = keep(suffixes.repeated_spans(docs, folder))
    found = suffixes.remove_repeats(docs, marks)
    lengths = F.transform("repeat.spans", lambda s: s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("repeat.n_bytes").alias("n_bytes"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("repeat.spans").cast("long").alias("n_spans"),
        F.sha2("repeat.kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("repeat.kept").cast("string")).alias("text"),
    ).withColumn("removed_share", F.coalesce(F.try_divide("n_removed", "n_bytes"), F.lit(0.0)))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    with scratch(spark) as folder:
        return keep(alignment.alignment(documents(spark, sf_dir).select("doc_id", "text"), *paths, folder))


@query(
    "op12_substring_dedup",
    r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), e AS (
  SELECT doc_id, i, min({'d': doc_id, 'i': i}) OVER (PARTITION BY s) AS f FROM s
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS g FROM e WHERE f.d < doc_id OR f.d = doc_id AND f.i < i GROUP BY 1
), kept AS (
  SELECT d.doc_id, w, coalesce(len(g), 0) AS n, g FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id
), k AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM kept) u
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id AS a, unnest(g) AS b FROM gone) v WHERE a = u.doc_id AND b = u.i)
  GROUP BY 1
)
SELECT kept.doc_id, len(w)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256,
  coalesce(t, '') AS text
FROM kept LEFT JOIN k ON kept.doc_id = k.doc_id
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    with scratch(spark) as folder:
        marks = keep(factors.repeated_windows(docs, folder))
    found = factors.remove_repeats(docs, marks)
    lengths = F.transform("repeat.spans", lambda s: s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("repeat.n_words").alias("n_words"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.sha2("repeat.kept", 256).alias("kept_sha256"),
        F.col("repeat.kept").alias("text"),
    )


@query(
    "op11_hard_negatives",
    """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id,
  row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b)::INTEGER AS rank,
  n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.a = n.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, number = documents(spark, sf_dir, "embeddings"), F.col("vec_id")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(finite).select(
        "vec_id",
        F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
    )
    with scratch(spark) as folder:
        return keep(negatives.hard_negatives(rows, number % 100 == 0, folder))
