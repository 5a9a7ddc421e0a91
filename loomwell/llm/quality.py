"""Quality rules: text metrics, and thresholds from mergeable quantile sketches per language and source.

DataFrame functions only. The sketch of a metric is a histogram over logarithmic buckets (as in DDSketch): counts of equal
buckets add up, so partial sketches merge in any order to the same result, and a quantile is off by ``ACCURACY`` at most
relative to its value. Sketches are rows (group, metric, bucket, count), at most a few hundred for a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import WS, checkpoint

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Relative accuracy of a quantile.
ACCURACY = 0.02
#: Values up to this are one bucket, whose value is 0.
TINY = 1e-3

#: Metrics judged by adaptive thresholds. For each: the least spread, so that groups of spotless or uniform texts don't
#: reject a first blemish. It is added to the group's median, so no threshold is the same for all groups by itself.
LEAST_SPREAD = {"symbols_per_word": 0.05, "dup_line_share": 0.1, "repeat_word_share": 0.1, "upper_share": 0.0075, "word_chars_mean": 0.8}
#: A threshold is the median plus this many times the spread, the distance from the median to the upper quartile.
SPREAD = 4.0
#: Groups of fewer documents take the thresholds of their language, and languages of fewer those of all documents.
LEAST_ROWS = 100
#: Columns that quality_rules() makes.
COUNTS = ("q_n_words", "q_word_chars", "q_n_symbols", "q_n_lines", "q_n_dup_lines", "q_n_repeat_words", "q_n_upper")


def base_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Input columns and q_n_words, q_word_chars, q_n_symbols, q_n_lines (lines with a word), q_n_dup_lines,
    q_n_repeat_words and q_n_upper."""
    ws = F.lit(WS)
    # Columns made in turn: each is used once or is cheap, so that no filter is pushed below and repeats them.
    out = docs.withColumn("__q_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = out.withColumn("__q_words", F.expr("filter(split(__q_text, '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), w -> w <> '')"))
    out = out.withColumn("__q_lines", F.filter(F.split("__q_text", "\n"), lambda line: F.btrim(line, ws) != ""))
    # Three-word windows by hash; within one text, hashes of 64 bits stand for the words.
    windows = "transform(sequence(0, size(ws) - 3), i -> xxhash64(ws[i], ws[i + 1], ws[i + 2]))"
    out = out.withColumn("__q_windows", F.expr(f"transform(array(__q_words), ws -> CASE WHEN size(ws) < 3 THEN cast(array() AS array<bigint>) ELSE {windows} END)[0]"))
    # Positions of windows found twice or more: equal neighbours after a sort by (hash, position).
    sorted_at = "sort_array(transform(hs, (h, i) -> struct(h AS h, i AS i)))"
    repeated = "filter(st, (x, k) -> (k > 0 AND st[k - 1].h = x.h) OR (k < size(st) - 1 AND st[k + 1].h = x.h))"
    out = out.withColumn(
        "__q_at",
        F.expr(
            f"transform(array(__q_windows), hs -> CASE WHEN size(array_distinct(hs)) = size(hs) THEN cast(array() AS array<int>)"
            f" ELSE sort_array(transform(transform(array({sorted_at}), st -> {repeated})[0], x -> x.i)) END)[0]"
        ),
    )
    # A window covers three words, or as many as there are to the next repeated window.
    covered = "aggregate(at, struct(0L AS n, -3 AS p), (acc, p) -> struct(acc.n + least(3, p - acc.p) AS n, p AS p)).n"
    return out.withColumns(
        {
            "q_n_words": F.size("__q_words").cast("long"),
            "q_word_chars": F.length(F.translate("__q_text", WS, "")).cast("long"),
            "q_n_symbols": (F.length("__q_text") - F.length(F.translate("__q_text", SYMBOLS, ""))).cast("long"),
            "q_n_lines": F.size("__q_lines").cast("long"),
            "q_n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"),
            "q_n_repeat_words": F.expr(f"transform(array(__q_at), at -> {covered})[0]"),
            "q_n_upper": F.length(F.regexp_replace("__q_text", r"\P{Lu}+", "")).cast("long"),
        }
    ).drop("__q_text", "__q_words", "__q_lines", "__q_windows", "__q_at")


def rates(df: DataFrame) -> DataFrame:
    """Adds the rates that thresholds apply to; each is 0 where its denominator is."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return df.withColumns(
        {
            "q_symbols_per_word": share("q_n_symbols", "q_n_words"),
            "q_dup_line_share": share("q_n_dup_lines", "q_n_lines"),
            "q_repeat_word_share": share("q_n_repeat_words", "q_n_words"),
            "q_upper_share": share("q_n_upper", "q_word_chars"),
            "q_word_chars_mean": share("q_word_chars", "q_n_words"),
        }
    )


def bucket_of(value: Column, accuracy: float = ACCURACY) -> Column:
    """Bucket of a value >= 0: the smallest b with gamma ** b >= value; -2**31 for TINY and less."""
    gamma = (1 + accuracy) / (1 - accuracy)
    return F.when(value <= TINY, F.lit(-(2**31))).otherwise(F.ceil(F.log(value) / F.lit(math.log(gamma)))).cast("int")


def sketches(df: DataFrame, group: list[str], metrics: list[str], accuracy: float = ACCURACY) -> DataFrame:
    """(group columns, metric, bucket, n): a mergeable quantile sketch for each group and metric; nulls aren't counted."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket_of(F.col(m), accuracy).alias("bucket")) for m in metrics])).alias("m")
    return df.select(*group, each).select(*group, "m.metric", "m.bucket").where("bucket IS NOT NULL").groupBy(*group, "metric", "bucket").agg(F.count("*").alias("n"))


def merge(a: DataFrame, b: DataFrame, group: list[str]) -> DataFrame:
    """The sketch of two inputs together."""
    return a.unionByName(b).groupBy(*group, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, group: list[str], at: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """(group columns, metric, n_rows, one column for each named quantile) of sketches."""
    gamma = (1 + accuracy) / (1 - accuracy)
    rows = sketch.groupBy(*group, "metric").agg(F.sum("n").alias("n_rows"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("__q_b"))
    for name, q in at.items():
        # The bucket in which the running count first reaches the rank.
        first = f"aggregate(__q_b, struct(0L AS seen, cast(NULL AS INT) AS b), (acc, x) -> struct(acc.seen + x.n AS seen, CASE WHEN acc.b IS NULL AND acc.seen + x.n >= {q} * n_rows THEN x.bucket ELSE acc.b END AS b)).b"
        value = F.when(F.col("__q_at") == -(2**31), F.lit(0.0)).otherwise(2 * F.pow(F.lit(gamma), F.col("__q_at")) / (gamma + 1))
        rows = rows.withColumn("__q_at", F.expr(first)).withColumn(name, value).drop("__q_at")
    return rows.drop("__q_b")


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", spread: float = SPREAD, least_spread: dict[str, float] | None = None, least_rows: int = LEAST_ROWS, carry_text: bool = True) -> DataFrame:
    """Judge documents by fixed base rules and by thresholds of their language and source.

    Returns every input column (but the text without ``carry_text``; columns named like the results are replaced), the base metrics, the rates, q_base_failed (fewer than 50 words, or
    more than half of them in three-word windows found twice), q_reasons (names of rates above their thresholds) and
    q_kept. A threshold is median + spread * (upper quartile - median) of the group's documents, where the difference
    counts as the rate's ``least_spread`` at least. A group of fewer than ``least_rows`` documents is judged by the merged sketch
    of its language, and a language of fewer by that of all documents. Null languages and sources are groups of their own; a null or empty text has no words and fails
    the base rules. Repeated rows count as often as they occur. An empty table gives an empty table.

    Groups are pre-aggregated to sketches; the thresholds, one row a group, are joined back without a hint, so that
    Spark broadcasts them only if they are small and can split a hot group if they aren't.
    """
    least = LEAST_SPREAD | (least_spread or {})
    metrics = [f"q_{m}" for m in LEAST_SPREAD]
    docs = docs.drop(*COUNTS, *metrics, "q_reasons", "q_base_failed", "q_kept")
    judged = rates(base_metrics(docs, text_col)).withColumns({"__q_lang": F.col(lang_col), "__q_source": F.col(source_col)})
    # Metrics cost far more than all else and are needed twice: for the sketches and for the verdicts.
    judged = checkpoint(judged if carry_text else judged.drop(text_col))
    own = sketches(judged, ["__q_lang", "__q_source"], metrics)
    at = F.create_map(*[x for m in LEAST_SPREAD for x in (F.lit(f"q_{m}"), F.lit(float(least[m])))])
    threshold = F.col("mid") + spread * F.greatest(at[F.col("metric")], F.col("high") - F.col("mid"))
    # Sketches of a language and of all documents are those of their groups added up.
    by_lang = own.groupBy("__q_lang", "metric", "bucket").agg(F.sum("n").alias("n"))
    of_all = by_lang.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
    levels = []
    for sketch, group, level in ((own, ["__q_lang", "__q_source"], 0), (by_lang, ["__q_lang"], 1), (of_all, [], 2)):
        rows = quantiles(sketch, group, {"mid": 0.5, "high": 0.75}).select(*group, "metric", "n_rows", threshold.alias("t"))
        levels.append(rows.withColumnsRenamed({"n_rows": f"n{level}", "t": f"t{level}", "__q_lang": f"__q_lang{level}", "metric": f"metric{level}"}))
    a, b, c = levels
    limits = a.join(b, F.col("__q_lang0").eqNullSafe(F.col("__q_lang1")) & (F.col("metric0") == F.col("metric1"))).join(c, F.col("metric0") == F.col("metric2"))
    limits = limits.withColumn("t", F.when(F.col("n0") >= least_rows, F.col("t0")).when(F.col("n1") >= least_rows, F.col("t1")).otherwise(F.col("t2")))
    wide = limits.groupBy(F.col("__q_lang0").alias("__q_l"), F.col("__q_source").alias("__q_s")).agg(*[F.max(F.when(F.col("metric0") == m, F.col("t"))).alias(f"__t_{m}") for m in metrics])
    out = judged.join(wide, F.col("__q_lang").eqNullSafe(F.col("__q_l")) & F.col("__q_source").eqNullSafe(F.col("__q_s")), "left")
    reasons = F.array_compact(F.array(*[F.when(F.col(m) > F.col(f"__t_{m}"), F.lit(m[2:])) for m in metrics]))
    failed = (F.col("q_n_words") < 50) | (100 * F.col("q_n_repeat_words") > 50 * F.col("q_n_words"))
    out = out.withColumns({"q_reasons": reasons, "q_base_failed": failed}).withColumn("q_kept", ~F.col("q_base_failed") & (F.size("q_reasons") == 0))
    return out.drop("__q_lang", "__q_source", "__q_l", "__q_s", *[f"__t_{m}" for m in metrics])
