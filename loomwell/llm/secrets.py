"""Secret scans: fixed patterns, and a randomness test battery under length-aware false-discovery control.

DataFrame functions only. Tokens of 20 or more base64 characters are candidates. For each its encoding is inferred (the
smallest alphabet that holds it) and three tests are made: chi-squared uniformity over that alphabet, serial
correlation of neighbouring characters, and the number of runs of digits, small and capital letters. The first two must
not reject randomness; the third gives the p-value of the null hypothesis "ordinary word", in which character classes
change rarely (a Chernoff bound, so it is valid at every length and falls with it). Discoveries are chosen by the
Benjamini-Hochberg rule over all candidates of the corpus, for each band of lengths by itself, so that a mass of short
tokens doesn't decide about long ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import checkpoint

#: Fixed patterns, and the least lengths of what they match (of group 2 for the first).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Inferred encodings: pattern and alphabet size, smallest first.
ENCODINGS = (("[0-9]+", 10), ("[0-9a-f]+", 16), ("[0-9A-F]+", 16), ("[a-z]+", 26), ("[A-Z]+", 26), ("[A-Z2-7]+", 32), ("[0-9a-z]+", 36), ("[0-9A-Z]+", 36), ("[0-9A-Za-z]+", 62))
#: Share of neighbours of different classes in ordinary words; deviations (of normal variables) at which a test rejects.
CHANGE, REJECT = 0.1, 4.0
FDR = 0.01
#: Matches of a text are placed in parts of so many.
PART = 256
#: Lower ends of the length bands.
LENGTHS = (20, 32, 48, 64)


def _located(text: str, pattern: str, group: int) -> str:
    """SQL for an array of (s, e, v): code point range of each match of a pattern, and the text of a group of it."""
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    found = f"arrays_zip(transform(split({text}, '{p}', -1), x -> length(x)), regexp_extract_all({text}, '{p}', 0), regexp_extract_all({text}, '{p}', {group}))"
    step = "struct(a.at + z['0'] + coalesce(length(z['1']), 0) AS at, CASE WHEN z['1'] IS NULL THEN a.out ELSE array_append(a.out, struct(cast(a.at + z['0'] AS INT) AS s, cast(a.at + z['0'] + length(z['1']) AS INT) AS e, z['2'] AS v)) END AS out)"
    kind = "array<struct<s: int, e: int, v: string>>"
    # Appending copies an array, so matches are placed in parts of PART, each behind the lengths of those before it.
    parts = f"transform(array({found}), f -> transform(sequence(0, (size(f) - 1) div {PART}), i -> slice(f, i * {PART} + 1, {PART})))[0]"
    length = "aggregate(p, 0, (n, z) -> n + z['0'] + coalesce(length(z['1']), 0))"
    starts = f"aggregate(ps, array(0), (a, p) -> array_append(a, element_at(a, -1) + {length}))"
    placed = f"transform(array({starts}), st -> flatten(transform(ps, (p, i) -> aggregate(p, struct(st[i] AS at, cast(array() AS {kind}) AS out), (a, z) -> {step}).out)))[0]"
    return f"CASE WHEN {text} RLIKE '{p}' THEN transform(array({parts}), ps -> {placed})[0] ELSE cast(array() AS {kind}) END"


def _p_value() -> str:
    """SQL for (s, e, n, q) of a candidate c: its length and -10 log10 of its p-value, 0 if a test rejects randomness."""
    size = "CASE " + " ".join(f"WHEN rtrim('=', c.v) RLIKE '^{p}$' THEN {k}" for p, k in ENCODINGS) + " ELSE 64 END"
    body = f"struct(c.s AS s, c.e AS e, split(rtrim('=', c.v), '') AS ch, cast({size} AS DOUBLE) AS k)"
    # Letters of a class are neighbours in their code points, so code values serve the correlation.
    codes = "transform(ch, x -> cast(ascii(x) AS DOUBLE))"
    kinds = "transform(ch, x -> CASE WHEN x BETWEEN '0' AND '9' THEN 0 WHEN x BETWEEN 'a' AND 'z' THEN 1 WHEN x BETWEEN 'A' AND 'Z' THEN 2 ELSE 3 END)"
    n = "cast(size(ch) AS DOUBLE)"
    squares = "aggregate(array_distinct(ch), 0D, (a, x) -> a + power(size(filter(ch, y -> y = x)), 2))"
    stats = f"named_struct('s', t.s, 'e', t.e, 'k', t.k, 'n', {n}, 'sq', {squares}, 'x', {codes}, 'g', {kinds})".replace("ch", "t.ch")
    mean = "aggregate(u.x, 0D, (a, v) -> a + v) / u.n"
    changes = "aggregate(sequence(1, size(u.g) - 1), 0, (a, i) -> a + CASE WHEN u.g[i] <> u.g[i - 1] THEN 1 ELSE 0 END)"
    more = f"named_struct('s', u.s, 'e', u.e, 'k', u.k, 'n', u.n, 'sq', u.sq, 'x', u.x, 'mean', {mean}, 'rate', {changes} / (u.n - 1))"
    chi = "(w.k / w.n * w.sq - w.n - (w.k - 1)) / sqrt(2 * (w.k - 1))"
    variance = "aggregate(w.x, 0D, (a, v) -> a + (v - w.mean) * (v - w.mean))"
    serial = f"abs(aggregate(sequence(1, size(w.x) - 1), 0D, (a, i) -> a + (w.x[i] - w.mean) * (w.x[i - 1] - w.mean))) / nullif({variance}, 0D) * sqrt(w.n)"
    bound = f"(w.n - 1) * (w.rate * ln(w.rate / {CHANGE}) + CASE WHEN w.rate < 1 THEN (1 - w.rate) * ln((1 - w.rate) / {1 - CHANGE}) ELSE 0 END) * 10 / ln(10)"
    q = f"CASE WHEN w.rate > {CHANGE} AND {chi} <= {REJECT} AND coalesce({serial}, {REJECT} + 1) <= {REJECT} THEN cast(least(400, floor({bound})) AS INT) ELSE 0 END"
    last = f"named_struct('s', w.s, 'e', w.e, 'n', cast(w.n AS INT), 'q', {q})"
    # A candidate of '=' alone, or of one character before them, has no neighbours to test.
    some = "filter(__s_cand, c -> length(rtrim('=', c.v)) > 1)"
    return f"transform(transform(transform(transform({some}, c -> {body}), t -> {stats}), u -> {more}), w -> {last})"


def thresholds(counts: list[tuple[int, int, int]], fdr: float = FDR) -> dict[int, int]:
    """By band, the least q that is a discovery, from (band, q, count) rows: the Benjamini-Hochberg rule."""
    out = {}
    for band in {b for b, _, _ in counts}:
        own = sorted(((q, c) for b, q, c in counts if b == band), reverse=True)
        total, seen = sum(c for _, c in own), 0
        for q, c in own:
            seen += c
            if q > 0 and total * 10 ** (-q / 10) <= fdr * seen:
                out[band] = q
    return out


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """Spans of secrets in whole texts, in code points, end exclusive.

    Returns per input row: the id, s_n_assign, s_n_access, s_n_hex, s_base and s_all: strings kind:start:end, by start and
    kind, joined by commas, of the pattern matches and of all spans. Matches are leftmost and non-overlapping for each
    kind; those that are too short are dropped afterwards. The battery adds spans of kind random that overlap no match.
    Null and empty texts have no spans. Repeated rows count as often as they occur among the candidates. Extra columns
    are ignored; an empty table gives no rows. The only thing collected is the table of p-value counts, at most 401 rows for each of
    four bands.
    """
    t = "__s_text"
    out = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(t))
    for kind, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX.replace("+", "{24,}"), 0)):
        out = out.withColumn(f"__s_{kind}", F.expr(f"filter({_located(t, pattern, group)}, m -> length(m.v) >= {LEAST[kind]})"))
    out = out.withColumn("__s_cand", F.expr(_located(t, CANDIDATE, 0)))
    kinds = ("assign", "access", "hex")
    spans = ", ".join(f"transform(__s_{k}, m -> struct(m.s AS s, {i} AS k, m.e AS e, '{k}' AS kind))" for i, k in enumerate(kinds))
    out = out.withColumn("__s_base", F.expr(f"array_sort(concat({spans}))")).withColumn("__s_tests", F.expr(_p_value()))
    out = checkpoint(out.select(id_col, "__s_base", "__s_tests"))
    band = "filter(array(" + ", ".join(map(str, LENGTHS)) + "), b -> x.n >= b)"
    rows = out.select(F.explode("__s_tests").alias("x")).select(F.expr(f"coalesce(array_max({band}), {LENGTHS[0]})").alias("band"), "x.q").groupBy("band", "q").count().collect()
    least = thresholds([tuple(r) for r in rows], fdr)
    at = "CASE coalesce(array_max(" + band + f"), {LENGTHS[0]}) " + " ".join(f"WHEN {b} THEN {q}" for b, q in sorted(least.items())) + " ELSE 1000 END" if least else "1000"
    extra = f"transform(filter(__s_tests, x -> x.q >= {at} AND NOT exists(__s_base, b -> b.s < x.e AND x.s < b.e)), x -> struct(x.s AS s, 3 AS k, x.e AS e, 'random' AS kind))"
    text = "array_join(transform({}, m -> concat(m.kind, ':', m.s, ':', m.e)), ',')"
    return out.select(
        id_col,
        *[F.expr(f"cast(size(filter(__s_base, m -> m.kind = '{k}')) AS BIGINT)").alias(f"s_n_{k}") for k in kinds],
        F.expr(text.format("__s_base")).alias("s_base"),
        F.expr(text.format(f"array_sort(concat(__s_base, {extra}))")).alias("s_all"),
    )
