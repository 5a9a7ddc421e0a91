"""The training-data pipeline over ``documents``: each stage keeps, cleans or encodes what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.llm.common import checkpoint, table
from loomwell.llm.decontam import decontaminate
from loomwell.llm.line_dedup import line_dedup
from loomwell.llm.ngram_join import ngram_join
from loomwell.llm.quality import quality_rules
from loomwell.llm.queries import model_path
from loomwell.llm.spm_fst import encode

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(df: DataFrame, text) -> DataFrame:
    """The columns of documents, with new texts and their lengths."""
    return df.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a threshold of their language and source go."""
    return quality_rules(docs).where("q_kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(line_dedup(docs), F.col("ld_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one of the smallest id stays; documents without shingles stay."""
    gone = ngram_join(docs).where("component_id <> id").select(F.col("id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark spans are cut from the texts."""
    return _with_text(decontaminate(docs, table(spark, sf_dir, "benchmark"), clean=True), F.col("dc_text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left."""
    out = encode(docs.select(*COLUMNS), model_path())
    return out.select("doc_id", "lang", "source", F.col("sp_n_tokens").alias("n_tokens"), F.col("sp_ids").alias("ids"), F.col("sp_round_trip").alias("round_trip"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs


#: SQL can't express the tokenizer; a test holds run() against known rows, and its stages' operators are held against SQL or brute force.
ORACLE_SQL = None
