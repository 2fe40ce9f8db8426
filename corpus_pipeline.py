"""From raw documents to packed training sequences: quality, near-duplicates, repeats, contamination, packing.

Each stage takes what the one before it kept. Stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyfield.llm import decontaminate, jaccard, packing, quality, suffixes
from tallyfield.llm.common import documents, keep, scratch, scratch_dir, stage
from tallyfield.llm.queries import tokenizer_path


#: Rows of an Arrow batch: texts are long, and each task holds a batch on both sides of its Python worker.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at its threshold or above; their labels' rows teach it.

    Null and empty texts are scored like empty ones, repeated rows alike; a score equal to the threshold stays.
    """
    small_batches(spark)
    model = quality.fit_classifier(docs, quality.learnable(documents(spark, sf_dir, "labels")))
    return docs.where(quality.quality_score(model, spark)(F.col("text")) >= quality.THRESHOLD)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents, and one row of it.

    Of an id with several texts each is judged by its own group; ties go by the hash of the text. Texts without words
    are linked with nothing and stay; of rows that are repeated as they are one stays.
    """
    small_batches(spark)
    with scratch(spark) as folder:
        first = keep(jaccard.representatives(docs, folder))
    first = first.select(F.col("key").alias("__key"), F.col("tid").alias("__tid"), "rows").withColumnRenamed("rows", "__rows")
    same = F.col("doc_id").eqNullSafe(F.col("__key")) & (F.xxhash64("text") == F.col("__tid"))
    single = docs.join(first.where("__rows = 1"), same, "left_semi")
    ties = Window.partitionBy("doc_id", "text").orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")])
    several = docs.join(first.where("__rows > 1"), same, "left_semi").withColumn("__row", F.row_number().over(ties))
    return single.unionByName(several.where("__row = 1").drop("__row"))


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; a text that is one repeat becomes empty.

    Null and short texts stay as they are; repeated rows are repeats of each other.
    """
    small_batches(spark)
    with scratch(spark) as folder:
        marks = keep(suffixes.repeated_spans(docs, folder))
    found = suffixes.remove_repeats(docs, marks, as_text=True)
    text = F.when(F.size("repeat.spans") > 0, F.col("repeat.kept")).otherwise(F.col("text"))
    size = docs.schema["n_chars"].dataType
    found = found.withColumn("text", text).withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(size))
    return found.select(*docs.columns)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; null and empty texts are not, repeated rows are judged alike."""
    small_batches(spark)
    found = decontaminate.find_contamination(docs, documents(spark, sf_dir, "benchmark"))
    return decontaminate.clean(found).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and place in sequences; ``packing.padded_sequences`` makes the sequences of them.

    A null or empty text is one piece, the end id; repeated rows are packed each.
    """
    small_batches(spark)
    packed = packing.pack(packing.token_pieces(docs, tokenizer_path()), scratch_dir(spark))
    return packing.pieces_of(packed, ["doc_id", "start", "doc_tokens"], with_ids=True)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", repeat_stage),
    ("benchmark_decontamination", contamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot train the classifier or tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = scratch_dir(spark)
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), folder, name)
    return docs
