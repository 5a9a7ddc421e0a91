"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import WS, ascii_lower, pair_hash

ID, TEXT, LINES, H1, H2 = "__ld_id", "__ld_text", "__ld_lines", "__ld_h1", "__ld_h2"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(WS)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drop lines whose key occurs in ``min_docs`` or more documents, but for those of the smallest id that holds it.

    Returns every input column, and ``ld_text`` (lines kept, joined by \\n), ``ld_n_lines`` and ``ld_n_dropped``.
    Null and empty texts are one empty line. Keys under ``min_chars`` code points always stay. Rows of equal id
    are one document when documents are counted, and each keeps its own lines. A row whose id is null holds no
    key and loses no line. An empty table gives an empty table. Columns of the input named like the three
    results are replaced.

    Only (hash, id, text hash, position) rows are exploded; counts are pre-aggregated before their shuffle, the join
    back is a plain equi-join that AQE can split at a hot line, and whole texts are shuffled once.
    """
    base = docs.withColumns({ID: F.col(id_col), TEXT: F.coalesce(F.col(text_col).cast("string"), F.lit(""))})
    base = base.withColumn("__ld_th", F.xxhash64(TEXT))
    lines = (
        base.where(F.col(ID).isNotNull())
        .select(ID, "__ld_th", F.posexplode(F.split(TEXT, "\n", -1)).alias("__ld_pos", "__ld_line"))
        .withColumn("__ld_key", line_key(F.col("__ld_line")))
        .where(F.length("__ld_key") >= min_chars)
        .select(ID, "__ld_th", "__ld_pos", pair_hash(F.col("__ld_key"))[0].alias(H1), pair_hash(F.col("__ld_key"))[1].alias(H2))
    )
    if min_docs <= 2:
        spread = lines.groupBy(H1, H2).agg(F.min(ID).alias("__ld_keep"), F.max(ID).alias("__ld_last")).where(F.col("__ld_keep") != F.col("__ld_last") if min_docs == 2 else F.lit(True))
    else:
        spread = lines.groupBy(H1, H2, ID).agg(F.lit(1).alias("__ld_one")).groupBy(H1, H2).agg(F.min(ID).alias("__ld_keep"), F.count("*").alias("__ld_docs")).where(F.col("__ld_docs") >= min_docs)
    gone = (
        lines.join(spread.select(H1, H2, "__ld_keep"), [H1, H2])
        .where(F.col(ID) != F.col("__ld_keep"))
        .groupBy(ID, "__ld_th")
        .agg(F.collect_set("__ld_pos").alias("__ld_gone"))
        .select(F.col(ID).alias("__ld_gid"), F.col("__ld_th").alias("__ld_gth"), "__ld_gone")
    )
    out = base.join(gone, (F.col(ID) == F.col("__ld_gid")) & (F.col("__ld_th") == F.col("__ld_gth")), "left")
    out = out.withColumn(LINES, F.split(TEXT, "\n", -1))
    n_gone = F.when(F.col("__ld_gone").isNull(), F.lit(0)).otherwise(F.size("__ld_gone"))
    # array_except works with a hash set, so long documents that lose many lines stay linear.
    kept = F.expr(
        "CASE WHEN __ld_gone IS NULL THEN __ld_text ELSE"
        " array_join(transform(array_except(sequence(0, size(__ld_lines) - 1), __ld_gone), p -> __ld_lines[p]), '\n') END"
    )
    return (
        out.withColumns({"ld_n_lines": F.size(LINES).cast("long"), "ld_n_dropped": n_gone.cast("long"), "ld_text": kept})
        .drop(ID, TEXT, LINES, "__ld_th", "__ld_gid", "__ld_gth", "__ld_gone")
    )
