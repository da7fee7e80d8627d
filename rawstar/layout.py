"""Names of the raw payload and of the six destination tables."""

from __future__ import annotations

from pyspark.sql import types as T

# System columns of a raw table.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("raw_id", T.LongType(), False),
        T.StructField("raw_hash", T.StringType()),
        T.StructField("raw_ingested_at", T.TimestampType()),
        T.StructField("raw_schema", T.StringType()),
        T.StructField("raw_tab", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

# Payload header names that occur once.
SINGLE_KEYS = [
    "id_column_1",
    "text_column_1",
    "datetime_column_1",
    "integer_column_1",
    "text_column_2",
    "numeric_column_1",
    "text_column_3",
    "numeric_column_2",
]

POSITIONS = range(1, 15)


def declared_key(position: int) -> str:
    return f"integer_column_{position + 1}"


def kind_key(position: int) -> str:
    return f"text_column_{position + 3}"


def weight_key(position: int) -> str:
    return f"numeric_column_{2 * position + 1}"


def gap_key(position: int) -> str:
    return f"numeric_column_{2 * position + 2}"


def position_keys(position: int) -> list[str]:
    return [declared_key(position), kind_key(position), weight_key(position), gap_key(position)]


PAYLOAD_KEYS = SINGLE_KEYS + [key for p in POSITIONS for key in position_keys(p)]

# Wide enough for 18 integer and 15 fraction digits; times 1000 still fits 38.
NUMERIC = "decimal(33,15)"

# Destination columns in declaration order, with types.
DESTINATION_COLUMNS = {
    "table3": "id_column_1 bigint, text_column_1 string, text_column_2 string, "
    f"numeric_column_1 {NUMERIC}, text_column_3 string, text_column_4 string",
    "table4": "id_column_1 smallint, text_column_1 string, text_column_2 string",
    "table1": "id_column_1 bigint, id_column_2 int, text_column_1 string, "
    "datetime_column_1 timestamp_ntz, text_column_2 string, integer_column_1 smallint, "
    "integer_column_2 smallint, integer_column_3 int, text_column_3 string, "
    "id_column_3 bigint, id_column_4 bigint, id_column_5 bigint, integer_column_4 int, "
    "integer_column_5 int, id_column_6 int, integer_column_6 int, integer_column_7 int",
    "table5": "id_column_1 bigint, numeric_column_1 decimal(21,1), "
    f"numeric_column_2 {NUMERIC}, integer_column_1 int, integer_column_2 int, "
    "id_column_2 bigint, id_column_3 bigint",
    "table6": "id_column_1 bigint, id_column_2 bigint, id_column_3 smallint",
    "table2": "id_column_1 bigint, id_column_2 bigint, integer_column_1 smallint, "
    "integer_column_2 int, text_column_1 string, integer_column_3 int, "
    "integer_column_4 int, integer_column_5 int, integer_column_6 int",
}

# Constants the recipes write and test.
REFERENCE_LABEL = "SYNTHETIC/REFERENCE"
CODE_LABEL = "SYNTHETIC/GENERIC"
LOCAL_ZONE = "America/Sao_Paulo"
KIND_TOKENS = ["X", "Y", "Z"]
# \A and \z, because Java's $ would also accept a trailing newline.
TWO_LETTERS = r"\A[A-Z]{2}\z"
