"""Payload text to typed values; text that does not convert gives NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rawstar.functions.fields import fits, trim_to_null

# Default word lists and default formats.
TRUE_WORDS = ["true", "t", "1", "sim", "s", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "nao", "n", "no"]
DATE_FORMAT = "DD/MM/YYYY"
TIME_FORMAT = "HH24:MI:SS"
MOMENT_FORMAT = "DD/MM/YYYY HH24:MI:SS"

# Accepted type names and their Spark types.
SPARK_TYPES = {
    "varchar": "string",
    "boolean": "boolean",
    "integer": "int",
    "bigint": "bigint",
    "smallint": "smallint",
    "numeric": "decimal(33,15)",
    "real": "float",
    "double precision": "double",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp",
    "time": "string",
    "uuid": "string",
    "jsonb": "string",
}
TYPE_ALIASES = {
    "bool": "boolean",
    "character varying": "varchar",
    "character": "varchar",
    "text": "varchar",
    "decimal": "numeric",
    "float4": "real",
    "float8": "double precision",
    "int2": "smallint",
    "int4": "integer",
    "int8": "bigint",
    "serial": "integer",
    "bigserial": "bigint",
    "json": "jsonb",
    "timestamp without time zone": "timestamp",
    "timestamp with time zone": "timestamptz",
}
UUID_PATTERN = r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"

# Format tokens, and their Spark letters with and without a
# separator on both sides (a separated field may drop its leading zero).
_TOKENS = {
    "YYYY": ("yyyy", "yyyy"),
    "AAAA": ("yyyy", "yyyy"),
    "HH24": ("HH", "H"),
    "MM": ("MM", "M"),
    "DD": ("dd", "d"),
    "MI": ("mm", "m"),
    "SS": ("ss", "s"),
}
_TOKEN = re.compile("|".join(_TOKENS), re.IGNORECASE)


def canonical_type(name: str) -> str:
    lowered = name.strip().lower()
    known = TYPE_ALIASES.get(lowered, lowered)
    if known not in SPARK_TYPES:
        raise ValueError(f"unsupported type: {name}")
    return known


def spark_pattern(template: str) -> str:
    """Spark datetime pattern of a ``DD/MM/YYYY HH24:MI:SS`` style template."""
    tight = re.search(f"({_TOKEN.pattern})({_TOKEN.pattern})", template, re.IGNORECASE) is not None
    return _TOKEN.sub(lambda m: _TOKENS[m.group().upper()][0 if tight else 1], template)


def to_text(value: Column) -> Column:
    return trim_to_null(value)


def to_boolean(
    value: Column, true_words: Sequence[str] = TRUE_WORDS, false_words: Sequence[str] = FALSE_WORDS
) -> Column:
    word = F.lower(F.btrim(value))
    return F.when(word.isin(list(true_words)), True).when(word.isin(list(false_words)), False)


def to_moment(value: Column, formats: Sequence[str]) -> Column:
    """First format that fits the whole text; formats are tried in the given order."""
    patterns = list(dict.fromkeys(f.strip() for f in formats if f.strip()))
    if not patterns:
        raise ValueError("at least one date or time format is needed")
    text = F.btrim(value)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(spark_pattern(p))) for p in patterns])


def to_decimal_comma(value: Column) -> Column:
    """Float from text with a decimal point or a decimal comma."""
    return F.replace(value, F.lit(","), F.lit(".")).try_cast("double")


def convert(
    value: Column,
    type_name: str,
    true_words: Sequence[str] = TRUE_WORDS,
    false_words: Sequence[str] = FALSE_WORDS,
    formats: Sequence[str] | None = None,
) -> Column:
    """Typed value of payload text, by type name; NULL where it does not convert."""
    kind = canonical_type(type_name)
    if kind in ("varchar", "jsonb"):
        return to_text(value)
    if kind == "boolean":
        return to_boolean(value, true_words, false_words)
    if kind == "date":
        return to_moment(value, formats or [DATE_FORMAT]).cast("date")
    if kind == "time":
        return F.date_format(to_moment(value, formats or [TIME_FORMAT]), "HH:mm:ss")
    if kind in ("timestamp", "timestamptz"):
        return to_moment(value, formats or [MOMENT_FORMAT]).cast(SPARK_TYPES[kind])
    if kind == "uuid":
        text = F.lower(F.btrim(value))
        return F.when(text.rlike(UUID_PATTERN), text)
    text = trim_to_null(value)
    if kind == "numeric":
        # Text with more digits than the type holds does not convert: no digit is lost silently.
        text = F.when(fits(text, SPARK_TYPES[kind]), text)
    return text.try_cast(SPARK_TYPES[kind])
