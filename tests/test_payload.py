"""Payload reshaping, typed conversion, names and profiles on hand-written rows."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from rawstar.functions import convert, fields, names
from rawstar.operators import payload, profile


def raw(spark, *payloads):
    return spark.createDataFrame(
        [(i + 1, json.dumps({"values": p})) for i, p in enumerate(payloads)], "raw_id bigint, raw string"
    )


def values(df, *keep):
    return {tuple(r[k] for k in keep): json.loads(r.raw)["values"] for r in df.collect()}


ROWS = [
    {"k": "a", "u": "1", "x": "p"},
    {"k": "a", "u": "1", "x": "p"},
    {"k": "b", "u": "3", "x": 'q"\n'},
    {"k": "a", "u": "2", "x": ""},
    {"k": None, "u": "9", "x": "z"},
    {"k": None, "u": "9", "x": None},
]


def grouped(df, *args, **options):
    got = {}
    for r in payload.group_rows(df, *args, **options).collect():
        got.setdefault(r.group_key, {}).setdefault(r.header, []).append((r.position, r.value))
    for lists in got.values():
        for header, found in lists.items():
            found.sort(key=str if header is None else None)
            if header is not None:
                assert [p for p, _ in found] == list(range(1, len(found) + 1))
                lists[header] = [v for _, v in found]
    return got


def test_group_rows_lists(spark):
    assert grouped(raw(spark, *ROWS), "k", ["x"], ["u"]) == {
        "a": {"u": ["1", "2"], "x": ["p", "p", ""]},
        "b": {"u": ["3"], "x": ['q"\n']},
        None: {"u": ["9"], "x": ["z"]},
    }


def test_every_header_gets_a_role_and_every_key_stays(spark):
    rows = [
        {"k": "a", 'h"1': "v", "n": 5, "list": ["p", "q", "p"]},
        {"k": "a", "list": ["q", None, "r"], "o": {"z": [1]}},
        {"k": "only"},
        {"k": "nulls", "u": None, "list": []},
        {},
        {"k": 'quo"te', 'h"1': 'w"'},
    ]
    df = raw(spark, *rows)
    none = {None: [(None, None)]}
    assert grouped(df, "k", ["list"]) == {
        "a": {'h"1': ["v"], "n": ["5"], "list": ["p", "q", "p", "q", "r"], "o": ['{"z":[1]}']},
        "only": none,
        "nulls": none,
        None: none,
        'quo"te': {'h"1': ['w"']},
    }
    assert grouped(df, "k", unique_headers=["list"])["a"] == {"list": ["p", "q", "r"]}


def test_group_rows_has_one_form_at_every_size(spark):
    many = [{"k": "a", "u": str(i % 3), "x": str(i)} for i in range(3000)]
    assert grouped(raw(spark, *many), "k", ["x"]) == {"a": {"u": ["0", "1", "2"], "x": [str(i) for i in range(3000)]}}


def test_group_rows_roles_are_exclusive(spark):
    with pytest.raises(ValueError):
        payload.group_rows(raw(spark, *ROWS), "k", ["u"], ["u"])
    with pytest.raises(ValueError):
        payload.group_rows(raw(spark, *ROWS), "k", ["k"])


def test_group_columns_order_and_removal(spark):
    df = raw(spark, {"m": "1", "a": "2", "b": ["3", "4"], "rest": "r"}, {"m": ["0"], "a": "", "rest": "s"})
    got = values(payload.group_columns(df, [("m", ["b", "a"])]), "raw_id")
    assert got == {(1,): {"rest": "r", "m": ["1", "3", "4", "2"]}, (2,): {"rest": "s", "m": ["0", None, ""]}}
    with pytest.raises(ValueError, match="one group"):
        payload.group_columns(df, [("m", ["a"]), ("b", ["a"])])
    with pytest.raises(ValueError, match="source"):
        payload.group_columns(df, [("m", [])])


def test_keys_and_lists(spark, rows):
    df = raw(spark, {"a": "1", "b": ["x"]}, {"a": "[no list]", "c": "2"})
    assert rows(payload.payload_keys(df)) == [("a",), ("b",), ("c",)]
    assert rows(payload.multivalue_keys(df)) == [("a", False), ("b", True), ("c", False)]


def test_expand_key_keeps_text_that_fails(spark, rows):
    df = raw(spark, {"n": " 5 "}, {"n": "1.5"}, {"n": "40000"}, {"n": "  "}, {"n": None}, {})
    got = payload.expand_key(df, "n", "n_value", "smallint")
    assert rows(got, "raw_id", "n_value", "n_value_fail") == [
        (1, 5, None), (2, None, "1.5"), (3, None, "40000"), (4, None, None), (5, None, None), (6, None, None),
    ]
    for bad in ("Raw", "1a", "a-b", "a" * 59):
        with pytest.raises(ValueError):
            payload.expand_key(df, "n", bad, "integer")


def test_first_item(spark, rows):
    df = raw(spark, {"n": ["7", "8"]}, {"n": "9"}, {"n": []}, {"n": "[1]"}, {})
    got = payload.expand_key(df, "n", "first", "text", first_array_item=True)
    assert rows(got, "raw_id", "first") == [(1, "7"), (2, "9"), (3, None), (4, "[1]"), (5, None)]


def test_expand_child_pairs_by_position(spark, rows):
    parents = raw(spark, {"id": "10", "v": ["1", "x", "3"], "t": "only"}, {"id": "20", "v": "5"})
    child = spark.createDataFrame(
        [(10, 1, None, "old"), (10, 2, 22, "old"), (10, 3, None, "old"), (10, 4, None, "old"), (20, 1, None, None), (30, 1, 9, "n")],
        "pid int, line int, v int, t string",
    )
    got = payload.expand_child(
        parents,
        F.get_json_object("raw", "$.values.id").cast("int"),
        child,
        "pid",
        ["line"],
        [payload.ChildValue("v", "v", "integer"), payload.ChildValue("t", "t", sql="upper(input_text)")],
    )
    assert rows(got) == [
        (10, 1, 1, "ONLY"), (10, 2, 22, "old"), (10, 3, 3, "old"), (10, 4, None, "old"), (20, 1, 5, None), (30, 1, 9, "n"),
    ]
    with pytest.raises(ValueError, match="twice"):
        payload.expand_child(parents, F.lit(1), child, "pid", ["line"], [payload.ChildValue("v", "v")] * 2)


def test_items_beyond_the_child_rows_become_rows(spark, rows):
    parents = raw(spark, {"id": "10", "v": ["1", "2", "3"]}, {"id": "40", "v": ["7", "bad"]}, {"v": ["9"]})
    child = spark.createDataFrame([(10, 1, None, "old"), (None, 1, 5, "x")], "pid int, line int, v int, t string")
    key = F.get_json_object("raw", "$.values.id").cast("int")
    got = payload.expand_child(parents, key, child, "pid", ["line"], [payload.ChildValue("v", "v", "integer")])
    assert rows(got) == rows(
        spark.createDataFrame(
            [(10, 1, 1, "old"), (10, None, 2, None), (10, None, 3, None), (40, None, 7, None), (None, 1, 5, "x")],
            "pid int, line int, v int, t string",
        )
    )
    twice = raw(spark, {"id": "10", "v": ["1"]}, {"id": "10", "v": ["2"]})
    with pytest.raises(ValueError, match="2 parents have the key 10"):
        payload.expand_child(twice, key, child, "pid", ["line"], [payload.ChildValue("v", "v", "integer")])


@pytest.mark.parametrize(
    "text, want",
    [
        ("1.12345678901234567", None), ("1.123456789012345", "1.123456789012345"), ("-0.5" + "0" * 30, "-0.500000000000000"),
        (" 12 ", "12.000000000000000"), ("1e-15", "0.000000000000001"), ("1e-16", None), ("1.5E3", "1500.000000000000000"),
        ("123456789012345678", "123456789012345678.000000000000000"), ("1234567890123456789", None), ("x", None), ("", None),
        (".1234567890123456", None), ("12345678901234567.5", "12345678901234567.500000000000000"),
    ],
)
def test_numbers_keep_all_digits_or_fail(spark, text, want):
    df = raw(spark, {"n": text})
    got = payload.expand_key(df, "n", "v", "numeric").first()
    assert (None if got.v is None else f"{got.v:f}", got.v_fail) == (want, text if want is None and text else None)
    typed = fields.typed(F.get_json_object("raw", "$.values.n"), "decimal(33,15)")
    staged = F.expr(fields.typed_sql("get_json_object(raw, '$.values.n')", "decimal(33,15)"))
    for column in (typed, staged):
        if want is None and text:
            with pytest.raises(Exception, match="digits would be lost|CAST_INVALID|NUMERIC_VALUE_OUT"):
                df.select(column).collect()
        else:
            assert df.select(column.alias("v")).first().v == got.v


def test_add_and_drop_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id int, raw_note string")
    got = payload.add_columns(df, {"n": "numeric", "d": "timestamptz"})
    assert dict(got.dtypes)["n"] == "decimal(33,15)" and dict(got.dtypes)["d"] == "timestamp"
    with pytest.raises(ValueError):
        payload.add_columns(df, {"id": "int4"})
    with pytest.raises(ValueError, match="raw"):
        payload.drop_column(df, "raw_note")
    with pytest.raises(ValueError, match="no such"):
        payload.drop_column(df, "nope")


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, want",
    [("SIM", True), (" t ", True), ("0", False), ("Nao", False), ("maybe", None), ("", None), (None, None)],
)
def test_boolean_words(spark, text, want):
    assert one(spark, convert.to_boolean(F.lit(text).cast("string"))) is want


@pytest.mark.parametrize(
    "text, kind, formats, want",
    [
        ("05/02/2024", "date", None, datetime.date(2024, 2, 5)),
        ("5/2/2024", "date", None, datetime.date(2024, 2, 5)),
        ("31/02/2024", "date", None, None),
        ("2024-02-05", "date", ["DD/MM/YYYY", "AAAA-MM-DD"], datetime.date(2024, 2, 5)),
        ("05022024", "date", ["DDMMYYYY"], datetime.date(2024, 2, 5)),
        ("05/02/2024 x", "date", None, None),
        (" 23:59:01 ", "time", None, "23:59:01"),
        ("24:00:01", "time", None, None),
        ("05/02/2024 06:07:08", "timestamp", None, datetime.datetime(2024, 2, 5, 6, 7, 8)),
        ("A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11", "uuid", None, "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"),
        ("a0eebc99", "uuid", None, None),
        (" x ", "text", None, "x"),
        ("1e3", "float8", None, 1000.0),
    ],
)
def test_conversions(spark, text, kind, formats, want):
    assert one(spark, convert.convert(F.lit(text), kind, formats=formats)) == want


def test_conversion_arguments(spark):
    with pytest.raises(ValueError, match="unsupported"):
        convert.canonical_type("money")
    with pytest.raises(ValueError, match="format"):
        convert.to_moment(F.lit("x"), [" "])


@pytest.mark.parametrize(
    "text, column, slug, label",
    [
        ("  Preço (R$) ", "pre_o_r", "pre_o_r", "Pre O R"),
        ("2nd-value", "raw_2nd_value", "2nd-value", "2nd Value"),
        ("__", "raw_value", "sem_titulo", ""),
        ("", "raw_value", "sem_titulo", ""),
        ("a" * 57 + "  b", "a" * 57, "a" * 57 + "_b", "A" + "a" * 56 + " B"),
    ],
)
def test_names(spark, text, column, slug, label):
    assert one(spark, names.column_name(F.lit(text))) == column
    assert one(spark, names.slug(F.lit(text))) == slug
    assert one(spark, names.label(F.lit(text))) == label


def test_profile_merges_conflicting_shapes(spark):
    documents = [
        {"a": 1, "b": [1, "x", {"c": None}]},
        {"a": {"d": True}, "b": []},
        {"a": "t", "b": [[2.5]]},
        [1],
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in documents] + [(None,)], "doc string")
    got = {
        r.path: (sorted(r.forms), sorted(r.primitive_types), r.array_count, r.node_count)
        for r in profile.json_profile(df, "doc").collect()
    }
    assert got == {
        "$": (["array", "object"], [], 1, 4),
        "$[]": (["primitive"], ["number"], 0, 1),
        "$.a": (["object", "primitive"], ["number", "string"], 0, 3),
        "$.a.d": (["primitive"], ["boolean"], 0, 1),
        "$.b": (["array"], [], 4, 3),
        "$.b[]": (["array", "object", "primitive"], ["number", "string"], 1, 4),
        "$.b[].c": (["primitive"], ["null"], 0, 1),
        "$.b[][]": (["primitive"], ["number"], 0, 1),
    }


def test_profile_keeps_odd_keys_apart(spark):
    document = {"a.b": 1, "a": {"b": "x"}, "": 2, "c[]": 3, "c": [True], 'q"\\': 4}
    df = spark.createDataFrame([(json.dumps(document),)], "doc string")
    got = {r.path: sorted(r.primitive_types) for r in profile.json_profile(df, "doc").collect()}
    number = ["number"]
    assert got == {
        "$": [],
        '$."a.b"': number,
        "$.a": [],
        "$.a.b": ["string"],
        '$.""': number,
        '$."c[]"': number,
        "$.c": [],
        "$.c[]": ["boolean"],
        '$."q\\"\\\\"': number,
    }


@pytest.mark.parametrize("key", ["it's", "a.b", 'say "x"'])
def test_headers_of_any_text(spark, key):
    raw = spark.createDataFrame([(1, json.dumps({"values": {key: "5", "a": {"b": "6"}}}))], "raw_id long, raw string")
    for first in (False, True):
        got = payload.expand_key(raw, key, "typed", "int4", first_array_item=first).first()
        assert (got.typed, got.typed_fail) == (5, None)
