"""An extension: documents that arrive as files are filtered and classified as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.operators.stream_filter import StreamFilter
from loomwell.operators.topics import Topics


def classified(spark: SparkSession, path: str, schema: str, rule: StreamFilter, topics: Topics, text_col: str = "text") -> DataFrame:
    """A streaming DataFrame of the Parquet files that appear under ``path``: accepted documents with their categories."""
    docs = spark.readStream.schema(schema).parquet(path)
    out = docs.where(rule.accepts(F.col(text_col))).withColumn("categories", topics.categories(F.col(text_col)))
    return out.where(F.size("categories") > 0)
