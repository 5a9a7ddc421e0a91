"""Sinks: tables, JDBC and one text file for each record."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "errorifexists", batch: int = 1000) -> None:
    df.write.mode(mode).option("batchsize", str(batch)).jdbc(url, table, properties=properties)


def record_text() -> Column:
    """Three header lines (the url line holds the archive's path), an empty one and the content; what is null is left empty."""
    head = [F.concat(F.lit(f"{name}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for name, c in (("URL", "wet_path"), ("Top Level Domain Name", "warc_tldn"), ("Relevance", "relevance"))]
    return F.concat_ws("\n", *head, F.lit(""), F.coalesce("content", F.lit("")))


def write_records(df: DataFrame, path: str) -> None:
    """A text file for each record, in a folder <tld>-<uuid> of its own.

    Spark's text writer does it, under its commit protocol and in whatever store the path names, and it names files by itself; so the
    record's name is its folder's.
    """
    name = F.concat(F.coalesce("warc_tldn", F.lit("none")), F.lit("-"), F.regexp_extract("warc_record_id", "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[^<:>]+(?=>?$)", 0))
    df.select(name.alias("record"), record_text().alias("value")).write.mode("overwrite").partitionBy("record").text(path)


def run_stats(spark, process: str, n_urls: int, nanoseconds: int) -> DataFrame:
    row = [(str(uuid.uuid4()), process, str(n_urls), nanoseconds)]
    return spark.createDataFrame(row, "row_uuid string, process_name string, number_of_urls string, processing_time_ns long").withColumn("processing_date", F.current_timestamp().cast("string"))
