"""Hand-written raw rows for the rules of the six recipes."""

import datetime
import decimal
import json

import pytest

from rawstar import layout
from rawstar.functions.fields import field_text
from rawstar.operators import compare, manifest, scope
from rawstar.plans import expand, recipes, staging
from rawstar.session import materialize

D = decimal.Decimal


def raw_row(raw_id, schema="group001", raw_hash="h", **values):
    payload = {key: "" for key in layout.PAYLOAD_KEYS}
    payload.update({"text_column_1": "ref", "text_column_2": "CA", **values})
    return (raw_id, raw_hash, None, schema, "Sheet1", json.dumps({"values": payload}))


def raw_table(spark, *rows):
    return spark.createDataFrame(list(rows), "raw_id bigint, raw_hash string, raw_ingested_at timestamp, "
                                 "raw_schema string, raw_tab string, raw string")


def star(spark, *rows):
    return expand.plan_star(raw_table(spark, *rows)).tables


def slot(position, declared, kind="X", weight="1", gap=""):
    return dict(zip(layout.position_keys(position), (declared, kind, weight, gap)))


def test_reference_needs_exactly_two_letters(spark, rows):
    tables = star(
        spark,
        raw_row(1, text_column_2=" ca "),
        raw_row(2, text_column_2="CB\n"),
        raw_row(3, text_column_2="X1"),
        raw_row(4, text_column_2=""),
        raw_row(5, text_column_1="   "),
        raw_row(6, text_column_1=" ref ", text_column_2="CA"),
    )
    assert rows(tables["table3"], "text_column_1", "text_column_3", "text_column_4") == [("ref", "C", "A")]
    assert rows(tables["table1"], "id_column_3") == [(1,), (6,)]


def test_fact_matches_first_and_last_letter_of_longer_text(spark, rows):
    tables = star(spark, raw_row(1, text_column_2="CA"), raw_row(2, text_column_2="CXA"), raw_row(3, text_column_2="CXB"))
    assert rows(tables["table1"], "id_column_3") == [(1,), (2,)]


def test_blank_absent_and_null_are_null(spark, rows):
    payload = [
        (1, json.dumps({"values": {"a": "  "}})),
        (2, json.dumps({"values": {"a": None}})),
        (3, json.dumps({"values": {}})),
        (4, json.dumps({"values": {"a": " 7 "}})),
        (5, json.dumps({"values": {"a": ""}})),
    ]
    table = spark.createDataFrame(payload, "raw_id bigint, raw string").selectExpr(
        "raw_id", "'s' as raw_schema", "'h' as raw_hash", "raw"
    )
    typed = staging.stage(table, [staging.FieldUse("a", "smallint")])
    assert rows(typed, "raw_id", "a") == [(1, None), (2, None), (3, None), (4, 7), (5, None)]


@pytest.mark.parametrize("text", ["abc", "1.5", "40000", "\t"])
def test_bad_number_text_fails_the_run(spark, text):
    with pytest.raises(Exception, match="CAST|INPUT|OVERFLOW"):
        staging.stage(raw_table(spark, raw_row(1, **slot(1, text)))).collect()


def test_broken_payload_fails_the_run(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        staging.stage(raw_table(spark, (1, None, None, "s", "t", '{"values": {"a"'))).collect()


def test_thousandths_round_half_away_from_zero(spark, rows):
    tables = star(
        spark,
        raw_row(1, numeric_column_1="0.0005", numeric_column_2="-0.0005", **slot(1, "1", weight="0.0005", gap="0.0004")),
        raw_row(2, numeric_column_1="0.00049999", numeric_column_2="0", **slot(1, "1", weight="0", gap="0")),
    )
    assert rows(tables["table1"], "id_column_3", "integer_column_7", "integer_column_3") == [(1, 1, None), (2, 0, None)]
    assert rows(tables["table2"], "id_column_2", "integer_column_2", "integer_column_6") == [(1, 1, 0), (2, 0, None)]


def test_greatest_skips_null_and_needs_no_value(spark, rows):
    tables = star(spark, raw_row(1, **slot(2, "9"), **slot(5, "3")), raw_row(2))
    assert rows(tables["table1"], "id_column_3", "integer_column_1") == [(1, 9), (2, None)]


def test_local_time_in_a_summer_of_the_nineties(spark, rows):
    tables = star(
        spark,
        raw_row(1, datetime_column_1="1998-12-25 12:00:00-03"),
        raw_row(2, datetime_column_1="2024-04-01 00:00:00.12-03"),
    )
    assert rows(tables["table1"], "id_column_3", "datetime_column_1") == [
        (1, datetime.datetime(1998, 12, 25, 13, 0)),
        (2, datetime.datetime(2024, 4, 1, 0, 0, 0, 120000)),
    ]


def test_slots_kept_only_where_declared(spark, rows):
    tables = star(
        spark,
        raw_row(
            1,
            **slot(1, "1", " x "),
            **slot(2, "3"),
            **slot(3, "3", "W"),
            **slot(4, "4", "Y", weight="-1"),
            **slot(5, "5", "Z", weight=""),
            **slot(14, "14", "z", weight="2.5", gap="1"),
        ),
    )
    assert rows(tables["table2"], "integer_column_1", "text_column_1", "integer_column_2", "integer_column_6") == [
        (1, "X", 1000, None),
        (14, "Z", 2500, 1000),
    ]


def test_measure_keeps_positive_rounded_to_one_place(spark, rows):
    tables = star(spark, raw_row(1, integer_column_1="2.25"), raw_row(2, integer_column_1="0"), raw_row(3))
    assert rows(tables["table5"], "id_column_2", "numeric_column_1") == [(1, D("2.3"))]


def test_code_numbers(spark, rows):
    tables = star(spark, raw_row(1, text_column_3="aa"), raw_row(2, text_column_3=" BA "), raw_row(3, text_column_3="A"))
    assert rows(tables["table4"], "id_column_1", "text_column_2") == [(1, "AA"), (27, "BA")]
    assert rows(tables["table6"], "id_column_2", "id_column_3") == [(1, 1), (2, 27)]


def test_staged_direct_and_joined_children_agree(spark):
    raw = raw_table(
        spark,
        *[
            raw_row(i, integer_column_1=str(i % 3), text_column_3="AB", text_column_2=["CA", "DB", "X9"][i % 3], **slot(1, "1"))
            for i in range(60)
        ],
    )
    staged, direct = (expand.plan_star(raw.repartition(n), stored=s).tables for n, s in ((1, True), (7, False)))
    for name in expand.RUN_ORDER:
        assert compare.tables_equal(staged[name], direct[name]), name
    source = staging.stage(raw)
    joined = recipes.with_fact(source, materialize(staged["table1"]))
    assert compare.tables_equal(recipes.unpivot_positions(joined), staged["table2"])
    assert compare.tables_equal(recipes.child_measure(joined), staged["table5"])


def test_union_of_scopes_is_scope_of_union(spark):
    raw = raw_table(spark, *[raw_row(i, schema=f"g{i % 3}", **slot(1, "1")) for i in range(30)])
    both = expand.plan_star(raw, ["g0", "g2"]).tables["table2"]
    apart = [expand.plan_star(raw, [g]).tables["table2"] for g in ("g0", "g2")]
    assert compare.tables_equal(both, apart[0].unionByName(apart[1]))


def test_types_that_disagree_stay_text():
    uses = [staging.FieldUse("a", "int"), staging.FieldUse("a", "string"), staging.FieldUse("b", "int")]
    assert staging.agreed_types(uses) == {"a": "string", "b": "int"}


@pytest.mark.parametrize("low, high, parts", [(1, 10, 4), (5, 7, 8), (0, 0, 3), (10, 1009, 7)])
def test_key_ranges_cover_every_key_once(spark, low, high, parts):
    ranges = staging.key_ranges(low, high, parts)
    assert [k for lo, hi in ranges for k in range(lo, hi + 1)] == list(range(low, high + 1))
    from pyspark.sql import functions as F

    keys = spark.range(low, high + 1)
    numbered = keys.select("id", staging.range_number(F.col("id"), F.lit(low), F.lit(high), parts).alias("part")).collect()
    starts = {low + (high - low + 1) * i // parts: i for i in range(parts)}
    for key, part in numbered:
        assert part == max(i for s, i in starts.items() if s <= key)


def test_manifest_counts_null_hash_once_and_names_missing_scopes(spark, rows):
    raw = raw_table(
        spark, raw_row(1, raw_hash=None), raw_row(2, raw_hash=None, schema="g2"), raw_row(3), raw_row(4, schema="g2")
    )
    groups = manifest.manifest_groups(raw)
    assert rows(manifest.manifest_totals(groups)) == [(4, 2)]
    assert [r.raw_hash for r in manifest.ordered_manifest(groups).collect()] == [None, "h", None, "h"]
    with pytest.raises(ValueError, match="a, z"):
        manifest.require_scopes(groups, ["z", "g2", "a"])
    assert rows(manifest.manifest_totals(groups.where("false"))) == [(0, 0)]


def test_scope_interval_order(spark, rows):
    ordered = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "raw_schema string, first_version int")
    assert rows(scope.scope_interval(ordered, "b", "a"), "raw_schema") == [("a",), ("b",)]
    with pytest.raises(ValueError, match="after"):
        scope.scope_interval(ordered, "a", "b")
    with pytest.raises(ValueError, match="not registered"):
        scope.scope_interval(ordered, "a", "x")


def test_empty_source_gives_empty_tables(spark):
    tables = expand.plan_star(raw_table(spark, raw_row(1)).where("false")).tables
    assert {name: df.count() for name, df in tables.items()} == dict.fromkeys(expand.RUN_ORDER, 0)


def test_field_text_of_odd_key_names(spark):
    df = spark.createDataFrame([(json.dumps({"values": {"a b.c": "x"}}),)], "raw string")
    assert df.select(field_text("raw", "a b.c")).first()[0] == "x"
