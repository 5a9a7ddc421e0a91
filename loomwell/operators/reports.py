"""Counts and progress reports, each in one pass over its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def docs_per_category(docs: DataFrame, categories_col: str, names: list[str]) -> DataFrame:
    """(category, docs): a document counts in each of its categories; listed names without documents are 0."""
    each = docs.agg(*[F.count_if(F.array_contains(categories_col, n)).alias(n) for n in names])
    return each.select(F.explode(F.array(*[F.struct(F.lit(n).alias("category"), F.col(n).alias("docs")) for n in names])).alias("x")).select("x.*")


def common_categories(categories: Column, wanted: list[str]) -> Column:
    """Those of the wanted categories that a document has, sorted; empty if it has none."""
    return F.array_sort(F.array_intersect(categories, F.array(*[F.lit(w) for w in wanted]).cast("array<string>")))


def distinct_records(docs: DataFrame, id_col: str) -> DataFrame:
    return docs.agg(F.count("*").alias("records"), F.countDistinct(id_col).alias("distinct_records"))


def content_lengths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_col, F.coalesce(F.length(text_col), F.lit(0)).alias("content_length"))


def subword_counts(docs: DataFrame, sub: str, text_col: str = "text") -> DataFrame:
    """(subword, n): tokens between spaces, without punctuation and in lower case, that start or end with ``sub``."""
    token = F.lower(F.regexp_replace("t", r"[!-/:-@\[-`{-~]", ""))
    rows = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), " ")).alias("t")).select(token.alias("subword"))
    return rows.where(F.startswith("subword", F.lit(sub)) | F.endswith("subword", F.lit(sub))).groupBy("subword").agg(F.count("*").alias("n"))


def progress(ledger: DataFrame) -> DataFrame:
    """Counts of a ledger with columns started and finished, and percentages with two places."""
    n = F.count("*")
    done, begun = F.count_if("finished"), F.count_if("started")
    bad = F.count_if(F.col("started") & ~F.col("finished"))

    def pct(a, b):
        return F.round(100.0 * a / F.nullif(b, F.lit(0)), 2)

    return ledger.agg(
        n.alias("total"), done.alias("finished"), (n - done).alias("remaining"), bad.alias("errored"),
        pct(done, n).alias("finished_pct"), pct(n - done, n).alias("remaining_pct"), pct(bad, begun).alias("errored_pct"),
    )


def incomplete(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("started") & ~F.col("finished"))


def unfinished_sample(ledger: DataFrame, n: int, seed: int | None = None, key: str = "wet_path") -> DataFrame:
    """``n`` unfinished paths without replacement; without a seed in the order of the keys' hash, so repeatable."""
    order = F.md5(F.col(key).cast("string")) if seed is None else F.rand(seed)
    return ledger.where(~F.col("finished")).orderBy(order, key).limit(n)


def first_paths(ledger: DataFrame, n: int, key: str = "wet_path") -> DataFrame:
    """The ``n`` smallest paths."""
    return ledger.select(key).orderBy(key).limit(n)
