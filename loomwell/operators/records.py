"""Record functions: completeness, fall-through fields and derived columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Required fields (fixed values).
INFO_FIELDS = ("WARC-Type", "WARC-Date", "WARC-Filename", "WARC-Record-ID", "Content-Type", "Content-Length", "Content")
CONVERSION_FIELDS = ("WARC-Type", "WARC-Target-URI", "WARC-Date", "WARC-Record-ID", "WARC-Refers-To", "WARC-Block-Digest", "Content-Type", "Content-Length", "Content")


def is_complete(headers: Column, required: tuple[str, ...], info: Column | None = None) -> Column:
    """Whether all required fields are there, and those of the archive's information if it is given."""
    own = F.forall(F.array(*[F.lit(r) for r in required]), lambda k: F.map_contains_key(headers, k))
    return own if info is None else own & is_complete(info, INFO_FIELDS)


def headers_complete(headers: Column, required: tuple[str, ...]) -> Column:
    return is_complete(headers, tuple(r for r in required if r != "Content"))


def get_field(headers: Column, info: Column, name: str) -> Column:
    """The record's own field, else the archive's."""
    return F.coalesce(F.try_element_at(headers, F.lit(name)), F.try_element_at(info, F.lit(name)))


def content_bytes(headers: Column) -> Column:
    return F.try_element_at(headers, F.lit("Content-Length")).try_cast("int")


def top_level_domain(url: Column) -> Column:
    """The last label of the host; null if the url doesn't parse."""
    return F.element_at(F.split(F.try_parse_url(url, F.lit("HOST")), r"\."), -1)


def categories_or_null(categories: Column, content: Column) -> Column:
    return F.when((F.size(categories) > 0) & (F.length(content) > 0), categories)
