"""Names derived from free text: column names, slugs, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest column name (a check suffix must still fit), fallbacks.
MAX_NAME = 58
NAME_PREFIX = "raw_"
NAME_FALLBACK = "raw_value"
SLUG_FALLBACK = "sem_titulo"


def _without_edges(text: Column) -> Column:
    return F.trim(text, F.lit("_"))


def column_name(text: Column) -> Column:
    """Lower-case name of letters, digits and single underscores, starting with a letter."""
    joined = _without_edges(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"))
    named = (
        F.when(F.coalesce(joined, F.lit("")) == "", NAME_FALLBACK)
        .when(joined.rlike(r"\A[a-z]"), joined)
        .otherwise(F.concat(F.lit(NAME_PREFIX), joined))
    )
    return F.rtrim(F.left(named, F.lit(MAX_NAME)), F.lit("_"))


def slug(text: Column) -> Column:
    """Like a column name, but hyphens stay, any length, no prefix."""
    joined = F.regexp_replace(F.lower(text), "[^a-z0-9_-]+", "_")
    edged = _without_edges(F.regexp_replace(joined, "_+", "_"))
    return F.when(F.coalesce(edged, F.lit("")) == "", SLUG_FALLBACK).otherwise(edged)


def label(text: Column) -> Column:
    """Words of letters and digits, each capitalised."""
    return F.initcap(F.btrim(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")))
