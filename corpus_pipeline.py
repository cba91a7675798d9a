"""From raw documents to token ids: each stage works on what the one before it kept.

quality classifier       documents that the scorer rejects go
SimHash near-dedup       one document of each group stays
substring dedup          passages that occur earlier are cut out of the texts
decontamination          passages of benchmark items are cut out of the texts
SentencePiece            token ids, and the text that they decode to

Stages that cut keep every document, also one of which nothing is left (its
text is empty), and set ``n_chars`` anew where the text changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import decontaminate, pieces, quality, simhash, substrings
from foldwise.llm.shared import materialise, table


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of the documents with another text."""
    changed = ~F.col(text).eqNullSafe(F.col("text"))
    n_chars = F.when(changed, F.char_length(text).cast("bigint")).otherwise(F.col("n_chars"))
    return docs.select(*[
        F.col(text).alias(c) if c == "text" else n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality_model(docs, "text", "doc_id")
    return quality.classify(docs, model, "text").filter("keep").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, "doc_id", "text", shingle=4, distance=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = substrings.drop_repeats(docs, "doc_id", "text", min_words=20, outputs=["kept_text"])
    return _with_text(left, docs.columns, "kept_text")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    clean = decontaminate.remove_contamination(docs.withColumn("__before", F.col("text")), items, n=10)
    return _with_text(clean.withColumnsRenamed({"text": "__after", "__before": "text"}), docs.columns, "__after")


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # both ways in one pass: a task then needs one worker
    return pieces.encode(docs, "text", decoded="decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_codec", sentencepiece_codec),
]

# trained scorers, XXH64 fingerprints and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
