"""Queries over the test tables, one for each operator, and the SQL to hold them against."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.llm import quality
from loomwell.llm.common import table
from loomwell.llm.decontam import decontaminate
from loomwell.llm.html_extract import extract
from loomwell.llm.line_dedup import line_dedup
from loomwell.llm.ngram_join import ngram_join
from loomwell.llm.quality import quality_rules
from loomwell.llm.secrets import secret_scan
from loomwell.llm.spm_fst import encode
from loomwell.llm.token_counts import token_counts
from loomwell.llm.toxicity import toxicity
from loomwell.llm.warc import archive_pages


def model_path() -> str:
    """The public SentencePiece model that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan(table(spark, sf_dir, "documents"))
    counts = [F.col(f"s_n_{k}").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return out.select("doc_id", *counts, F.sha2("s_base", 256).alias("base_sha256"), F.col("s_all").alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("ld_n_lines").alias("n_lines"), F.col("ld_n_dropped").alias("n_dropped"), F.sha2("ld_text", 256).alias("kept_sha256"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
    return out.select("doc_id", F.col("tc_n_bytes").alias("n_bytes"), F.col("tc_n_tokens").alias("n_tokens"), F.col("tc_over_limit").alias("over_limit"), F.col("tc_within").alias("n_within_limit"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), carry_text=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        F.col("dc_n_words").alias("n_words"),
        F.col("dc_n_hit").alias("n_hit"),
        F.size("dc_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("dc_items", ","), 256).alias("items_sha256"),
        (F.col("dc_n_hit") > 0).alias("contaminated"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).drop("url")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
    return out.select("doc_id", F.col("sp_n_tokens").alias("n_tokens"), F.col("sp_ids").alias("ids"), F.col("sp_round_trip").alias("round_trip"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_ngram_join": op3_ngram_join,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_warc": op7_warc,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_sentencepiece": op10_sentencepiece,
}

#: `[\x20\x09-\x0D]` as a DuckDB string.
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WORDS = "list_filter(string_split_regex({}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"
_ALNUM = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _quality_sql() -> str:
    """The base metrics, sketches, thresholds of the three levels and verdicts of operator 5."""
    gamma = (1 + quality.ACCURACY) / (1 - quality.ACCURACY)
    share = "CASE WHEN {1} > 0 THEN {0} / {1} ELSE 0.0 END AS {2}"
    rates = [("n_symbols", "n_words", "symbols_per_word"), ("n_dup_lines", "n_lines", "dup_line_share"), ("n_repeat_words", "n_words", "repeat_word_share"), ("n_upper", "word_chars", "upper_share"), ("word_chars", "n_words", "word_chars_mean")]
    values = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS metric, {m} AS v FROM rates" for _, _, m in rates)
    least = "CASE metric " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in quality.LEAST_SPREAD.items()) + " END"
    at = "2 * pow({0}, min(bucket) FILTER (seen >= {1} * n_rows)) / ({0} + 1)"
    pick = "CASE WHEN min(bucket) FILTER (seen >= {1} * n_rows) = -2147483648 THEN 0.0 ELSE " + at + " END"
    level = """{name} AS (SELECT {keys} metric, any_value(n_rows) AS n_rows, {mid} AS mid, {high} AS high FROM (
            SELECT *, sum(n) OVER (PARTITION BY {keys} metric ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY {keys} metric) AS n_rows
            FROM (SELECT {keys} metric, bucket, count(*) AS n FROM b GROUP BY {keys} metric, bucket)) GROUP BY {keys} metric)"""
    levels = ", ".join(level.format(name=n, keys=k, mid=pick.format(gamma, 0.5), high=pick.format(gamma, 0.75)) for n, k in (("own", "lang, source,"), ("tongue", "lang,"), ("whole", "")))
    return f"""
        WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, {_WORDS.format("text")} AS w, list_filter(string_split(text, chr(10)), lambda x: trim(x, {_WS}) <> '') AS l FROM t),
        g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) > 2),
        g2 AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM g),
        g3 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS m FROM g2),
        rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g3 WHERE m > 1) GROUP BY doc_id),
        base AS (SELECT w.doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
                   coalesce(rep.n, 0) AS n_repeat_words, length(regexp_replace(text, '\\P{{Lu}}+', '', 'g')) AS n_upper FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
        rates AS (SELECT *, {", ".join(share.format(*r) for r in rates)} FROM base),
        v AS ({values}),
        b AS (SELECT *, CASE WHEN v <= {quality.TINY} THEN -2147483648 ELSE CAST(ceil(ln(v) / {math.log(gamma)!r}) AS INT) END AS bucket FROM v),
        {levels},
        lim AS (SELECT own.lang, own.source, metric, unnest([struct_pack(n := own.n_rows, m := own.mid, h := own.high, k := 0), struct_pack(n := tongue.n_rows, m := tongue.mid, h := tongue.high, k := 1),
                   struct_pack(n := whole.n_rows, m := whole.mid, h := whole.high, k := 2)]) AS x
                FROM own JOIN whole USING (metric) JOIN tongue USING (metric) WHERE own.lang IS NOT DISTINCT FROM tongue.lang),
        used AS (SELECT lang, source, metric, arg_min(x.m + {quality.SPREAD} * greatest({least}, x.h - x.m), x.k) AS t FROM lim WHERE x.n >= {quality.LEAST_ROWS} OR x.k = 2 GROUP BY lang, source, metric),
        bad AS (SELECT DISTINCT v.doc_id FROM v JOIN used u ON v.metric = u.metric AND v.lang IS NOT DISTINCT FROM u.lang AND v.source IS NOT DISTINCT FROM u.source WHERE v.v > u.t)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM base"""


ORACLE: dict[str, str] = {
    "op3_ngram_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p WHERE 100 * c >= 80 * (n + m - c)),
        r AS (SELECT x AS node, x AS far FROM l UNION SELECT r.node, l.y FROM r JOIN l ON r.far = l.x)
        SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(c.low, s.doc_id) AS component_id, coalesce(k.n, 0) AS n_links FROM s
        LEFT JOIN (SELECT node, min(far) AS low FROM r GROUP BY node) c ON c.node = s.doc_id LEFT JOIN (SELECT x, count(*) AS n FROM l GROUP BY x) k ON k.x = s.doc_id""",
    "op5_quality_rules": _quality_sql(),
    "op6_decontamination": f"""
        WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
        iw AS (SELECT item, least(10, len(w)) AS size, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos FROM i WHERE len(w) > 0),
        win AS (SELECT DISTINCT item, size, array_to_string(w[pos:pos + size - 1], ' ') AS g FROM iw),
        d AS (SELECT doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
        dw AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM win)),
        dg AS (SELECT doc_id, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS g FROM dw),
        hit AS (SELECT dg.doc_id, dg.pos, dg.size, win.item FROM dg JOIN win ON dg.size = win.size AND dg.g = win.g),
        n AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS j FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS d FROM p),
        g AS (SELECT d, n, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY d, n)
        SELECT d.page_id, d.n AS payload_bytes, d.d AS payload_digest,
               CASE WHEN g.top IS NULL OR g.top = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN g.top <> d.page_id THEN g.top END AS refers_to
        FROM d LEFT JOIN g ON d.d = g.d AND d.n = g.n""",
    "op2_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_WS})")} AS key FROM lines),
        held AS (SELECT key, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS n FROM keyed WHERE length(key) >= 10 GROUP BY key),
        judged AS (
          SELECT k.doc_id, k.pos, k.line, coalesce(h.n >= 2 AND k.doc_id <> h.first_doc, false) AS gone
          FROM keyed k LEFT JOIN held h ON k.key = h.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
}
