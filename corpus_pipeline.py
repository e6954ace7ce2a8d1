"""The training-data pipeline: five stages, each written and read again.

Every stage but the last returns the columns of the documents. A document that
a stage leaves out is gone for the stages after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurelog.llm.chunked_bpe import bpe_round_trip
from tenurelog.llm.decontaminate import find_benchmark_windows
from tenurelog.llm.line_dedup import remove_repeated_lines
from tenurelog.llm.quality import fit_quality, score_quality
from tenurelog.llm.queries import KEEP, fold, table
from tenurelog.llm.weighted_minhash import near_duplicates
from tenurelog.llm.workspace import Workspace, digest

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``KEEP`` under a classifier learned from four fifths of the labels."""
    net = fit_quality(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    return score_quality(docs, net, keep=COLUMNS).where(F.col("score") >= KEEP).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest id; documents without text stay."""
    found = near_duplicates(docs).where("keeper AND node IS NOT NULL AND doc_id <=> class_id").select("node", "doc_id").distinct()
    named = docs.select(*COLUMNS, digest("text").alias("node"))
    # Rows with one id and one text are copies too: the first of them stays.
    once = Window.partitionBy("node", "doc_id").orderBy("lang", "source", "n_chars")
    found = found.select(F.col("node").alias("_node"), F.col("doc_id").alias("_id"))
    same = (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    kept = (
        named.join(found, same)
        .withColumn("_n", F.row_number().over(once))
        .where("_n = 1")
    )
    return kept.select(*COLUMNS).union(docs.where("text IS NULL").select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occurred before; ``n_chars`` follows the text."""
    cleaned = remove_repeated_lines(docs)
    changed = F.when(F.col("_n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return find_benchmark_windows(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS).where(F.size("items") == 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids as unsigned 32-bit little-endian integers, and a check that they decode to its text."""
    import public_tokenizers

    coded = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("line_dedup", line_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

ORACLE_SQL = None  # the classifier, the samples and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents to their ids."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, work.write(stage(spark, docs, sf_dir), name)
        work.drop(before)
    return docs
