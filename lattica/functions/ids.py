"""Identifiers: URLs and their integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of registered identifiers.
DOI, ORCID = "https://doi.org/", "https://orcid.org/"


def without_prefix(c: Column, prefix: str) -> Column:
    """Every occurrence of the prefix removed."""
    return F.replace(c, F.lit(prefix), F.lit(""))


def entity_id(c: Column) -> Column:
    """'https://any.site/W12' and 'W12' to 12; null, empty and malformed to null."""
    return F.substring(F.substring_index(F.trim(c), "/", -1), 2, 40).try_cast("bigint")


def topic_id(c: Column) -> Column:
    """Topics, fields and domains, of the older form '.../T1' and the newer '.../topics/T1', '.../domains/4'."""
    return F.regexp_extract(F.substring_index(F.trim(c), "/", -1), r"^[A-Za-z]?(\d+)$", 1).try_cast("bigint")


def first_id(c: Column) -> Column:
    """The integer of the first work, author, institution, concept or venue id in a text."""
    return F.regexp_extract(c, r"[WAICV](\d{2,})", 1).try_cast("bigint")


def id_url(site: str, letter: str, c: Column) -> Column:
    """site ends with a slash."""
    return F.concat(F.lit(site + letter), c.cast("string"))


def vertex_name(letter: str, c: Column) -> Column:
    return F.concat(F.lit(letter), c.cast("string"))
