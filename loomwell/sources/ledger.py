"""The ledger of archives: path lists, outcomes of parsing, and keyed merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load_paths(spark: SparkSession, path: str) -> DataFrame:
    """A new ledger from a (compressed) list of paths: nothing started, the file name is the sixth part of the path."""
    rows = spark.read.text(path).select(F.col("value").alias("wet_path"), F.get(F.split("value", "/"), F.lit(5)).alias("file_name"))
    return rows.withColumns({"started": F.lit(False), "finished": F.lit(False), "successfully_processed": F.lit(False), "records_extracted": F.lit(0).cast("long"), "log_message": F.lit(None).cast("string")})


def outcomes(parsed: DataFrame) -> DataFrame:
    """Ledger rows of parsed archives: from each archive's closing row."""
    return parsed.where("warc_record_id IS NULL AND log_message IS NOT NULL").select(
        "wet_path", F.lit(True).alias("started"), F.lit(True).alias("finished"), F.col("records").alias("records_extracted"), "log_message"
    )


def begin(ledger: DataFrame, paths: DataFrame) -> DataFrame:
    """The ledger with the paths marked as started now; run before their archives are parsed, so that one which never ends shows."""
    now = paths.select("wet_path").distinct().withColumns({"started": F.lit(True), "started_processing": F.current_timestamp()})
    known = ledger if "started_processing" in ledger.columns else ledger.withColumn("started_processing", F.lit(None).cast("timestamp"))
    return merge(known, now, ["wet_path"])


def merge(old: DataFrame, new: DataFrame, keys: list[str], keep_old_where_null: bool = True) -> DataFrame:
    """Upsert by key: new values win; with ``keep_old_where_null`` a null doesn't overwrite. Columns that the new rows lack stay,
    columns that only they have aren't taken over. Of equal new keys one stays."""
    rest = [c for c in old.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in new.columns if c not in keys], F.lit(0))
    new = new.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    a, b = old.alias("a"), new.withColumn("__new", F.lit(True)).alias("b")
    joined = a.join(b, keys, "full_outer")

    def value(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"a.{c}")
        return F.coalesce(f"b.{c}", f"a.{c}") if keep_old_where_null else F.when(F.col("b.__new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))

    return joined.select(*keys, *[value(c).alias(c) for c in rest]).select(*old.columns)


def append(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append as a keyed store does it: a row of a known key replaces that row's columns, with its nulls too."""
    return merge(old, new, keys, keep_old_where_null=False)


def truncate(spark: SparkSession, path: str) -> None:
    """Leaves a Parquet table of the same columns without rows."""
    spark.createDataFrame([], spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)


def delete(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(gone.select(*keys).distinct(), keys, "left_anti")
