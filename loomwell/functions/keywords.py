"""Keyword and chunk expressions: all native, so predicates stay inside one scan."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One character that separates tokens: white space or ASCII punctuation.
SEP = r"[\s!-/:-@\[-`{-~]"
ANY, EITHER_SIDE, BOTH_SIDES = 0, 1, 2


def keyword_pattern(keyword: str, separator: int = ANY) -> str:
    """Java pattern whose matches are the places where a keyword starts, so overlapping occurrences all count.

    Separator policy: 0 anywhere, 1 a separator (or an end of the text) on one side at least, 2 on both; others never match.
    """
    if not keyword:
        raise ValueError("a keyword can't be empty")
    word, before, after = re.escape(keyword), rf"(?:\A|(?<={SEP}))", rf"(?:{SEP}|\z)"
    if separator == ANY:
        return f"(?iu)(?={word})"
    if separator == EITHER_SIDE:
        return f"(?iu)(?:{before}(?={word})|(?={word}{after}))"
    return f"(?iu){before}(?={word}{after})" if separator == BOTH_SIDES else r"(?!)"


def _can_overlap(word: str) -> bool:
    return any(word.startswith(word[i:]) for i in range(1, len(word)))


def keyword_count(text: Column, keyword: str, separator: int = ANY) -> Column:
    """Occurrences of a keyword regardless of case, inside words too; null texts count as empty.

    A keyword that can't overlap itself is counted by what its removal takes away; patterns run only over texts that
    contain the keyword, and begin with its letters.
    """
    pattern, text, word = keyword_pattern(keyword, separator), F.lower(F.coalesce(text, F.lit(""))), keyword.lower()
    if not _can_overlap(word):
        if separator == ANY:
            return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(word), F.lit("")))) / len(word.encode())).cast("int")
        own = re.escape(word)
        before, after = rf"(?<=(?:\A|{SEP}){own})", rf"(?={SEP}|\z)"
        pattern = {EITHER_SIDE: f"{own}(?:{after}|{before})", BOTH_SIDES: f"{own}{after}{before}"}.get(separator, pattern)
    return F.when(F.contains(text, F.lit(word)), F.regexp_count(text, F.lit(pattern))).otherwise(F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once: filters on it aren't pushed below a generator, which would repeat the expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def any_keyword(text: Column, keywords: list[str], least: int) -> Column:
    """Whether a single keyword (counts aren't pooled) occurs ``least`` times or more."""
    out = F.lit(False)
    for k in keywords:
        out = out | (F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(k.lower())) if least == 1 else keyword_count(text, k) >= least)
    return out


def chunks(text: Column) -> Column:
    """The parts of each line between full stops that a space follows."""
    return F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.split(line, r"\. ")))


def valid_chunks(parts: Column, low: int = 8, high: int = 49) -> Column:
    """Chunks of 8 to 49 tokens between single spaces, empty tokens not counted."""
    return F.filter(parts, lambda c: F.size(F.filter(F.split(c, " "), lambda w: w != "")).between(low, high))
