"""From raw documents to token ids: quality, near duplicates, repeated passages, mixing, encoding.

Every stage takes the documents its predecessor kept, read again from Parquet, and all but the last return their
columns. Null and empty texts pass every stage that does not reject them for their quality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import op1_quality, op2_repeated_bytes, op4_mixing, op5_jaccard_join, op9_sentencepiece
from sedimenta.llm.staging import stage_lean

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express the fitted models, raking and segmentation; tests compare each stage with a plain version.
ORACLE_SQL = None


def _hidden(docs: DataFrame) -> DataFrame:
    """The documents with other columns than their own under names that no stage uses."""
    return docs.withColumnsRenamed({c: f"__own_{k}" for k, c in enumerate(docs.columns) if c not in COLUMNS})


def _shown(result: DataFrame, docs: DataFrame) -> DataFrame:
    """Of a stage's result the columns of ``docs``, under their names."""
    return result.select(*(F.col(c if c in COLUMNS else f"__own_{k}").alias(c) for k, c in enumerate(docs.columns)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _shown(op1_quality.judge(_hidden(docs), labels).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest doc_id.

    Of equal rows one stays. Rows without a doc_id come last, and documents without words all stay.
    """
    first = stage_lean(op5_jaccard_join.one_of_each(docs), "kept").withColumnsRenamed({"doc_id": "__id", "version": "__of"})
    marked = docs.withColumn("__version", F.xxhash64("text"))
    kept = marked.join(first, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__version") == F.col("__of")), "left_semi")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        kept = kept.where(worded).dropDuplicates(["doc_id", "__version"]).unionByName(kept.where(~worded))
    return kept.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the bytes that a string starting earlier covers; what is left of a cut character goes."""
    rest = F.make_valid_utf8(F.col("kept").cast("string"))
    changed = F.when(F.col("n_removed") > 0, F.replace(rest, F.lit("\ufffd"), F.lit(""))).otherwise(F.col("text"))
    removed = op2_repeated_bytes.remove_repeats(_hidden(docs)).withColumn("text", changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        removed = removed.withColumn("n_chars", F.when(
            F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return _shown(removed, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens have the target shares of sources, languages and topics."""
    return _shown(op4_mixing.sample(_hidden(docs)), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text they decode to."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = op9_sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), model).drop("text")
    # Staged, as encoding and decoding in one task keep two Python workers a core.
    encoded = stage_lean(encoded, "ids")
    return op9_sentencepiece.decode(encoded, model, text="text").select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_lean(stage(spark, docs, sf_dir), name.split()[0])
    return docs
