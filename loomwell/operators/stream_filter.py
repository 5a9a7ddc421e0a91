"""Stream filters: cheap whole-text test first, then a test of sentence-like chunks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.functions.keywords import any_keyword, chunks, once, valid_chunks


@dataclass(frozen=True)
class StreamFilter:
    """``least`` occurrences of one keyword in the text, and a valid chunk with a keyword among the first ``cap`` + 1."""

    keywords: tuple[str, ...]
    least: int = 1
    cap: int = 5000

    def among(self, valid: Column) -> Column:
        """Whether one of the first valid chunks has a keyword."""
        pattern = "|".join(re.escape(k.lower()) for k in self.keywords)
        return F.exists(F.slice(valid, 1, self.cap + 1), lambda c: F.rlike(F.lower(c), F.lit(pattern)))

    def detail(self, text: Column) -> Column:
        return self.among(valid_chunks(chunks(text)))

    def accepts(self, text: Column) -> Column:
        # AND short-circuits, so only texts that pass the cheap test are cut into chunks.
        return any_keyword(text, list(self.keywords), self.least) & self.detail(text)


def identity(text: Column) -> Column:
    """The filter that accepts everything."""
    return F.lit(True)


#: Presets (fixed values).
ELECTION = StreamFilter(("trump", "clinton", "presidential", "asthma"), 7)
FORUMS = StreamFilter(("abortion", "gun", "evolution", "god"), 1)


def stats(docs: DataFrame, rule: StreamFilter, text_col: str = "text") -> DataFrame:
    """Adds accepted, rejected_in_detail, rejected_early (0 or 1) and the numbers of chunks and of valid chunks."""
    text = F.col(text_col)
    out = once(docs, "__chunks", chunks(text)).withColumn("__early", any_keyword(text, list(rule.keywords), rule.least))
    out = once(out, "__valid", valid_chunks(F.col("__chunks")))
    out = once(out, "__detail", F.col("__early") & rule.among(F.col("__valid")))
    return out.withColumns(
        {
            "accepted": F.col("__detail").cast("int"),
            "rejected_in_detail": (F.col("__early") & ~F.col("__detail")).cast("int"),
            "rejected_early": (~F.col("__early")).cast("int"),
            "n_chunks": F.size("__chunks"),
            "n_valid_chunks": F.size("__valid"),
        }
    ).drop("__chunks", "__valid", "__early", "__detail")
