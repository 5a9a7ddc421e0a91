"""Topic filters: counts of core and secondary keywords against thresholds, with a separator policy."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwell.functions.keywords import ANY, EITHER_SIDE, BOTH_SIDES, keyword_count

CORE, SECONDARY = "core", "secondary"


@dataclass(frozen=True)
class Topics:
    """Keywords of each (topic, kind), least mentions (by default as many as there are keywords) and separator policies."""

    lexicon: dict[str, dict[str, tuple[str, ...]]]
    mentions: dict[str, dict[str, int]] = field(default_factory=dict)
    separators: dict[str, dict[str, int]] = field(default_factory=dict)

    def set_mentions(self, topic: str, least: dict[str, int]) -> Topics:
        if topic not in self.lexicon or set(least) != {CORE, SECONDARY}:
            raise ValueError(f"mentions need a known topic and both kinds: {topic}, {sorted(least)}")
        return replace(self, mentions=self.mentions | {topic: least})

    def hits(self, text: Column, topic: str, kind: str) -> Column:
        policy = self.separators.get(topic, {}).get(kind, ANY)
        total = F.lit(0)
        for k in self.lexicon[topic][kind]:
            total = total + keyword_count(text, k, policy)
        return total

    def least(self, topic: str, kind: str) -> int:
        return self.mentions.get(topic, {}).get(kind, len(self.lexicon[topic][kind]))

    def categories(self, text: Column) -> Column:
        """Sorted names of the topics whose core and secondary counts both reach their thresholds."""
        each = [F.when((self.hits(text, t, CORE) >= self.least(t, CORE)) & (self.hits(text, t, SECONDARY) >= self.least(t, SECONDARY)), F.lit(t)) for t in sorted(self.lexicon)]
        return F.array_compact(F.array(*each))

    def counts(self, docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
        """Long form (id, topic, core, secondary), zeros included."""
        text = F.col(text_col)
        rows = [F.struct(F.lit(t).alias("topic"), self.hits(text, t, CORE).alias(CORE), self.hits(text, t, SECONDARY).alias(SECONDARY)) for t in sorted(self.lexicon)]
        return docs.select(id_col, F.explode(F.array(*rows)).alias("x")).select(id_col, "x.*")


def topic_stats(docs: DataFrame, topics: Topics, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, categories): a row for every document, its categories joined by commas. Time isn't a row's but the run's, see sinks.run_stats()."""
    return docs.select(id_col, F.array_join(topics.categories(F.col(text_col)), ",").alias("categories"))


#: The forum topics (fixed values), and the thresholds and separators that production runs use.
FORUM_LEXICON = {
    "guncontrol": {CORE: ("gun", "guns"), SECONDARY: ("strict", "control")},
    "abortion": {CORE: ("abortion",), SECONDARY: ("pro-life", "pro-choice")},
    "evolution": {CORE: ("evolution",), SECONDARY: ("natural", "mechanism", "intelligent", "design")},
    "existenceofgod": {CORE: ("god",), SECONDARY: ("atheist", "theist", "exist")},
}
FORUM = Topics(FORUM_LEXICON)
FORUM_PRODUCTION = Topics(
    FORUM_LEXICON,
    {t: {CORE: 1, SECONDARY: 2 if t == "evolution" else 1} for t in FORUM_LEXICON},
    {t: {CORE: BOTH_SIDES if t == "guncontrol" else EITHER_SIDE, SECONDARY: EITHER_SIDE} for t in FORUM_LEXICON},
)
ELECTION_KEYWORDS = {"trump": "politics", "clinton": "politics", "presidential": "politics", "asthma": "asthma"}


def single_keyword_categories(text: Column, keywords: dict[str, str], least: int = 7) -> Column:
    """Sorted categories one of whose keywords alone occurs ``least`` times or more."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(keyword_count(text, k) >= least, F.lit(c)) for k, c in keywords.items()]))))


def no_categories(text: Column) -> Column:
    return F.array().cast("array<string>")


def identity_categories(text: Column) -> Column:
    return F.array(F.lit("document"))


def to_string(categories: Column) -> Column:
    """{'a','b'}; {} if there are none."""
    return F.when(F.size(categories) > 0, F.concat(F.lit("{'"), F.array_join(F.array_sort(categories), "','"), F.lit("'}"))).otherwise(F.lit("{}"))


def from_string(text: Column) -> Column:
    """Back from to_string(); {} gives no categories."""
    parts = F.transform(F.split(text, "','"), lambda x: F.regexp_replace(x, "[}{']", ""))
    return F.filter(parts, lambda x: x != "")
