"""One typed staging table per run: every payload header is read exactly once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar import layout
from rawstar.functions.fields import payload_struct, quoted, typed_sql

SYSTEM_KEYS = ["raw_id", "raw_schema", "raw_hash"]


@dataclass(frozen=True)
class FieldUse:
    """A recipe reads payload header ``key`` as ``type_name`` ('string' = raw text)."""

    key: str
    type_name: str = "string"


def agreed_types(uses: Iterable[FieldUse]) -> dict[str, str]:
    """One staging type per header; headers whose uses disagree stay text."""
    found: dict[str, set[str]] = {}
    for use in uses:
        found.setdefault(use.key, set()).add(use.type_name)
    return {key: types.pop() if len(types) == 1 else "string" for key, types in found.items()}


_MATCH = ["text_column_1", "text_column_2"]

# Headers each destination reads; the last four also match the reference dimension.
FIELDS_OF = {
    "table3": _MATCH,
    "table4": ["text_column_3"],
    "table1": [
        *_MATCH,
        *["id_column_1", "datetime_column_1", "numeric_column_1", "numeric_column_2"],
        *[layout.declared_key(p) for p in layout.POSITIONS],
    ],
    "table5": [*_MATCH, "integer_column_1"],
    "table6": [*_MATCH, "text_column_3"],
    "table2": [*_MATCH, *[key for p in layout.POSITIONS for key in layout.position_keys(p)]],
}


def recipe_uses(table: str | None = None) -> list[FieldUse]:
    """What one destination reads, or all six."""
    return [use for use in _all_uses() if table is None or use.key in FIELDS_OF[table]]


def _all_uses() -> list[FieldUse]:
    uses = [
        FieldUse("id_column_1", "int"),
        FieldUse("text_column_1"),
        FieldUse("datetime_column_1", "timestamp"),
        FieldUse("integer_column_1", layout.NUMERIC),
        FieldUse("text_column_2"),
        FieldUse("numeric_column_1", layout.NUMERIC),
        FieldUse("text_column_3"),
        FieldUse("numeric_column_2", layout.NUMERIC),
    ]
    for p in layout.POSITIONS:
        uses += [
            FieldUse(layout.declared_key(p), "smallint"),
            FieldUse(layout.kind_key(p)),
            FieldUse(layout.weight_key(p), layout.NUMERIC),
            FieldUse(layout.gap_key(p), layout.NUMERIC),
        ]
    return uses


def _staged(key: str, type_name: str) -> str:
    path = f"_payload.{quoted(key)}"
    value = path if type_name == "string" else typed_sql(path, type_name)
    return f"{value} AS {quoted(key)}"


def stage(raw_table: DataFrame, uses: Iterable[FieldUse] | None = None) -> DataFrame:
    """System keys plus one typed column per used header. A narrow map: no shuffle."""
    types = agreed_types(recipe_uses() if uses is None else uses)
    parsed = raw_table.select(*SYSTEM_KEYS, payload_struct("raw", types).alias("_payload"))
    return parsed.selectExpr(*SYSTEM_KEYS, *[_staged(key, t) for key, t in types.items()])


def key_ranges(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """Split the closed interval [low, high] into at most ``parts`` near-equal closed ranges."""
    span = high - low + 1
    starts = [low + span * i // parts for i in range(parts + 1)]
    return [(a, b - 1) for a, b in zip(starts, starts[1:]) if a < b]


def range_number(key: Column, low: Column, high: Column, parts: int) -> Column:
    """0-based number of the ``key_ranges`` interval holding ``key``."""
    span = high - low + 1
    # Largest i with low + floor(span * i / parts) <= key, in whole numbers.
    return F.call_function("div", (key - low + 1) * parts - 1, span).cast("int")


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All staged partitions as one table."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
