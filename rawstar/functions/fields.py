"""Reading payload headers and turning their text into typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_text(raw: Column | str, key: str) -> Column:
    """Text of one payload header; NULL if the header is absent or JSON null."""
    if "'" in key:  # a path cannot quote it
        column = F.col(raw) if isinstance(raw, str) else raw
        return F.from_json(column, f"struct<values: struct<{quoted(key)}: string>>")["values"].getField(key)
    return F.get_json_object(raw, f"$.values['{key}']")


def trim_to_null(value: Column) -> Column:
    """Strip spaces (spaces only); blank text becomes NULL."""
    return F.nullif(F.btrim(value), F.lit(""))


# A number's fraction digits without trailing zeros, and its exponent.
_FRACTION = "^[^.eE]*[.]([0-9]*?)0*([eE].*)?[ ]*$"
_EXPONENT = "[eE]([-+]?[0-9]+)[ ]*$"


def _scale(type_name: str) -> int:
    return int(type_name.rstrip(") ").split(",")[1]) if "," in type_name else 0


def fits_sql(path: str, type_name: str) -> str:
    """``fits`` as SQL text."""
    scale = _scale(type_name)
    digits = f"length(regexp_extract({path}, '{_FRACTION}', 1))"
    moved = f"coalesce(try_cast(regexp_extract({path}, '{_EXPONENT}', 1) AS int), 0)"
    # Short text cannot have too many digits: the patterns are for the rare long one.
    plain = f"NOT contains({path}, 'e') AND NOT contains({path}, 'E')"
    return f"(length({path}) <= {scale} AND {plain} OR {digits} - {moved} <= {scale})"


def fits(value: Column, type_name: str) -> Column:
    """Whether a number's text keeps all its digits in a decimal type; an exponent moves the written digits."""
    scale = _scale(type_name)
    short = (F.length(value) <= scale) & ~F.contains(F.lower(value), F.lit("e"))
    digits = F.length(F.regexp_extract(value, _FRACTION, 1))
    moved = F.coalesce(F.regexp_extract(value, _EXPONENT, 1).try_cast("int"), F.lit(0))
    return short | (digits - moved <= scale)


def typed(value: Column, type_name: str) -> Column:
    """Blank text is NULL, any other text must cast or the job fails.

    The cast itself ignores surrounding spaces, so the text is not trimmed twice. A number
    that would lose digits in a decimal type fails the job too.
    """
    if type_name.startswith("decimal"):
        lost = F.raise_error(F.concat(F.lit("digits would be lost: "), value))
        value = F.when(value.isNull() | fits(value, type_name), value).otherwise(lost)
    return F.when(F.btrim(value) != "", value.cast(type_name))


def typed_sql(path: str, type_name: str) -> str:
    """``typed`` as SQL text; wide tables are planned much faster from text.

    A number that would lose digits fails the job too.
    """
    value = f"CAST({path} AS {type_name})"
    if type_name.startswith("decimal"):
        lost = f"concat('digits would be lost: ', {path})"
        value = f"CASE WHEN {fits_sql(path, type_name)} THEN {value} ELSE raise_error({lost}) END"
    return f"CASE WHEN btrim({path}) <> '' THEN {value} END"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def upper_trim(value: Column) -> Column:
    return F.upper(F.btrim(value))


def payload_struct(raw: Column | str, keys: Iterable[str]) -> Column:
    """Parse the payload once into a struct holding just ``keys`` as text.

    A payload that is no JSON at all fails the job: it must never be dropped.
    """
    fields = ", ".join(f"{quoted(key)}: string" for key in keys)
    return F.from_json(raw, f"struct<values: struct<{fields}>>", {"mode": "FAILFAST"})["values"]


def parse_fields(raw_table: DataFrame, keys: Iterable[str], keep: Iterable[str]) -> DataFrame:
    """``keep`` columns plus one text column per payload key, with one JSON parse per row."""
    keys = list(keys)
    parsed = raw_table.select(*keep, payload_struct("raw", keys).alias("_payload"))
    return parsed.selectExpr(*keep, *[f"_payload.{quoted(key)} AS {quoted(key)}" for key in keys])
