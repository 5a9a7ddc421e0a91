"""Relevance search: BM25 over lower-cased ASCII words, as a full-text index would rank the texts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.functions.keywords import once

K1, B = 1.2, 0.75
#: Queries of the forum topics (fixed values).
FORUM_QUERIES = {
    "abortion": ("abortion", "pro-life", "pro-choice"),
    "guncontrol": ("strict", "gun", "control"),
    "evolution": ("evolution", "natural", "mechanism", "intelligent", "design"),
    "existenceofgod": ("atheist", "theist", "god", "exist"),
}


def relevance(docs: DataFrame, terms: list[str], id_col: str, text_col: str = "text") -> DataFrame:
    """(id, relevance) of the texts with a term: sum over terms of ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf +
    1.2 * (0.25 + 0.75 * length / mean length)), rounded to 6 places.

    Terms are cut into words as texts are, so "pro-life" is a phrase of two; a term without words never occurs. They are counted
    in the row (no explode of all words), by patterns only where the text contains the first word; the only shuffle before a
    ranking is one row of totals.
    """
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    cols = []
    for i, term in enumerate(terms):
        words = re.findall("[a-z]+", term.lower())
        pattern = "[^a-z]+".join(words)
        # The first word is matched, what follows is looked at, so that phrases which overlap all count.
        found = F.regexp_count("__t", F.lit(f"{words[0]}(?<![a-z]{words[0]})(?={pattern[len(words[0]):]}(?![a-z]))")) if words else F.lit(0)
        cols.append((F.when(F.contains("__t", F.lit(words[0])), found).otherwise(F.lit(0)) if words else found).alias(f"tf{i}"))
    own = once(docs.select(F.col(id_col), F.col(text_col)), "__t", text).select(id_col, F.regexp_count("__t", F.lit("[a-z]+")).alias("len"), *cols)
    total = own.agg(F.count("*").alias("n"), F.avg("len").alias("mean"), *[F.sum((F.col(f"tf{i}") > 0).cast("int")).alias(f"df{i}") for i in range(len(terms))])
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        score = score + F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    hit = F.greatest(*[F.col(f"tf{i}") for i in range(len(terms))], F.lit(0)) > 0
    # One row of totals: broadcasting it is bounded by construction.
    return own.where(hit).join(F.broadcast(total)).select(id_col, F.round(score, 6).alias("relevance"))


def top(scores: DataFrame, id_col: str, k: int | None = None, above: float = 0.1) -> DataFrame:
    """The ``k`` best of the scores above a threshold (ties by id); without ``k`` the full ranking."""
    out = scores.where(F.col("relevance") > above).orderBy(F.desc("relevance"), id_col)
    return out if k is None else out.limit(k)


def with_content(ranked: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Late materialisation: texts meet the few ids that a ranking left."""
    return ranked.join(docs, id_col)
