"""Facets, quality rules, constraint checks and import review on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from rawstar.operators import checks, facets, quality, review
from rawstar.operators.quality import Domain, Rule


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [
            (1, "Ab%c", "10"), (2, "ab_c", "9,5"), (3, "", None), (4, None, "x"),
            (5, "x" * 1000 + "needle", "100"), (6, "abZc", ""), (7, "ab\\c", "-3"),
        ],
        "id int, name string, n string",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "filters, want",
    [
        (None, [1, 2, 3, 4, 5, 6, 7]),
        ({"name": None}, [1, 2, 3, 4, 5, 6, 7]),
        ({"name": []}, []),
        ({"name": [{"value": ""}]}, [3, 4]),
        ({"name": [{"is_null": True}]}, [4]),
        ({"name": [{"value": "ab_c"}, {"is_null": True}]}, [2, 4]),
        ({"n": [{"operator": "gt", "numeric_value": "9.4"}]}, [1, 2, 5]),
        ({"n": [{"operator": "lt", "numeric_value": "9,5"}]}, [7]),
        ({"n": [{"operator": "eq_numeric", "numeric_value": "9.5"}]}, [2]),
        ({"n": [{"operator": "between", "lower_value": "-3", "upper_value": "10"}]}, [1, 2, 7]),
        ({"n": [{"operator": "gt", "numeric_value": "0"}], "name": [{"value": "ab_c"}]}, [2]),
    ],
)
def test_row_filter(items, filters, want):
    assert ids(facets.filter_rows(items, filters)) == want


def test_unknown_operator(items):
    with pytest.raises(ValueError):
        facets.filter_rows(items, {"n": [{"operator": "near", "numeric_value": "1"}]})


def test_cross_filter_ignores_its_own_column(items, rows):
    own = facets.facet_values(items, "name", {"name": [], "n": [{"value": "10"}]})
    assert rows(own) == [(False, "Ab%c", 1)]
    assert facets.facet_values(items, "name", {"n": []}).count() == 0


def test_facets_keep_null_and_empty_apart(items):
    got = {(r.is_null, r.value_text): r.row_count for r in facets.facet_counts(items, ["name"]).collect()}
    assert got[(True, "")] == 1 and got[(False, "")] == 1
    listed = facets.facet_list(facets.facet_values(items, "name")).collect()
    assert [(r.is_null, r.value_text) for r in listed[:2]] == [(True, ""), (False, "")]


def test_facet_rows_shape(items):
    got = {r.row_key: r for r in facets.facet_rows(items, "id", ["name", "n"]).where("column_name = 'n'").collect()}
    assert (got[2].numeric_value, got[4].numeric_value, got[3].is_null, got[3].value_text) == (9.5, None, True, "")
    wide = facets.facet_rows(items, "id", ["name"]).where("row_key = 5").first()
    assert wide.search_text.endswith("needle") and wide.value_text.endswith("needle")


@pytest.mark.parametrize(
    "text, want", [("%", [1]), ("_", [2]), ("\\", [7]), ("AB", [1, 2, 6, 7]), ("needle", [5]), ("  ", [1, 2, 3, 4, 5, 6, 7])]
)
def test_search_is_literal_and_caseless(items, text, want):
    assert ids(items.where(facets.search_condition("name", text))) == want


@pytest.mark.parametrize("limit, count", [(None, 7), (2, 2), (0, 7), (-5, 1), (99999, 7)])
def test_list_limit(items, limit, count):
    assert facets.facet_list(facets.facet_values(items, "name"), limit).count() == count


def test_preview_and_readonly(spark, items):
    assert [r.id for r in facets.preview(items, "id", {"n": [{"operator": "gt", "numeric_value": "0"}]}, 2).collect()] == [1, 2]
    for limit, truncated in ((7, False), (6, True)):
        df, cut = facets.readonly_query(spark, "select * from {t} order by id", limit, t=items)
        assert (df.count(), cut) == (limit, truncated)
    with pytest.raises(ValueError):
        facets.readonly_query(spark, "drop table x", 1)


def test_stale_tables(spark, rows):
    schema = "table_name string, version_code string, change_token string"
    cached = spark.createDataFrame([("a", "1", " "), ("b", "1", "x"), ("c", None, "")], schema)
    current = spark.createDataFrame([("a", "1 ", None), ("b", "2", "x"), ("c", "", None), ("d", "1", "x")], schema)
    assert rows(facets.stale_tables(cached, current)) == [("b", False), ("d", True)]


def test_delete_keeps_unknown(items):
    assert ids(facets.delete_where(items, F.col("name") == "")) == [1, 2, 4, 5, 6, 7]


BLANKS = [(1, None), (2, ""), (3, "  "), (4, "abc")]


@pytest.mark.parametrize(
    "rule, params, lenient, strict",
    [
        ("not_blank", {}, [], [1, 2, 3]),
        ("is_blank", {}, [4], [4]),
        ("contains", {"text": "b"}, [], [1, 2, 3]),
        ("contains", {"text": "B"}, [4], [1, 2, 3, 4]),
        ("not_contains", {"text": "b"}, [4], [1, 2, 3, 4]),
        ("length_lt", {"limit": 3}, [4], [1, 2, 3, 4]),
        ("length_lte", {"limit": 3}, [], [1, 2, 3]),
        ("length_gt", {"limit": 3}, [4], [1, 2, 3, 4]),
        ("length_gte", {"limit": 3}, [], [1, 2, 3]),
        ("length_between", {"lower": 3, "upper": 3}, [], [1, 2, 3]),
    ],
)
def test_text_rules(spark, rule, params, lenient, strict):
    df = spark.createDataFrame(BLANKS, "id int, t string")
    for ignore, want in ((True, lenient), (False, strict)):
        r = Rule("t", rule, params, ignore)
        assert ids(quality.with_flags(df, [r]).where(r.flag_name)) == want


@pytest.mark.parametrize(
    "rule, params, fails",
    [
        ("numeric_gt", {"value": 2}, [1, 2]),
        ("numeric_gte", {"value": 2}, [1]),
        ("numeric_lt", {"value": 2}, [2, 3, 4]),
        ("numeric_lte", {"value": 2}, [3, 4]),
        ("numeric_between", {"lower": 2, "upper": 3}, [1, 4]),
        ("numeric_mean_stddev_within", {"stddevs": 1}, [4]),
        ("numeric_max_mean_stddev", {"stddevs": 1}, [4]),
        ("numeric_min_mean_stddev", {"stddevs": 0.5}, [1]),
    ],
)
def test_number_rules(spark, rule, params, fails):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 10), (5, None)], "id int, n int")
    r = Rule("n", rule, params)
    assert ids(quality.with_flags(df, [r]).where(r.flag_name)) == fails


def test_one_row_has_no_deviation(spark):
    df = spark.createDataFrame([(1, 5.0)], "id int, n double")
    r = Rule("n", "numeric_mean_stddev_within", {"stddevs": 1})
    assert not quality.with_flags(df, [r]).first()[r.flag_name]
    for bad in (Rule("n", "numeric_max_mean_stddev", {"stddevs": 0}), Rule("n", "nope"), Rule("n", "numeric_between", {"lower": 2, "upper": 1})):
        with pytest.raises(ValueError):
            quality.with_flags(df, [bad])


def test_failing_counts_share_a_scan(spark, rows):
    df = spark.createDataFrame(BLANKS, "id int, t string")
    rules = [Rule("t", "not_blank", ignore_blank=False), Rule("t", "contains", {"text": "z"})]
    flagged = quality.with_flags(df, rules)
    assert rows(quality.failing_counts(flagged, rules)) == [("t_contains_fail", 1), ("t_not_blank_fail", 3)]
    assert flagged.where(quality.any_failure(rules)).count() == 4


def test_domains(spark, rows):
    df = spark.createDataFrame([("1", "yes"), ("x", "??"), ("", None), ("7", "NO")], "n string, b string")
    got = quality.domain_conformance(
        df, [Domain("n", "range", "1", "5"), Domain("n", "greater", lower="1"), Domain("b", "boolean", true_words=("yes",), false_words=("no",))]
    )
    assert rows(got) == [("b", "boolean", 2, 1, 1), ("n", "greater", 1, 2, 1), ("n", "range", 1, 2, 1)]


def test_unique_checks_and_null(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, None), (None, 3), (5, 5)], "a int, b int")
    assert rows(checks.unique_violations(df, ["a", "b"])) == [(1, 1, 2)]
    assert rows(checks.unique_violations(df, ["a"], F.col("b").isNull())) == [(2, 2)]
    assert rows(checks.unique_violations(df, ["a"], F.col("b").isNotNull())) == [(1, 2)]
    assert rows(checks.primary_key_violations(df, ["a", "b"])) == [(None, 3, 1), (1, 1, 2), (2, None, 2)]


def test_references_checks_and_cascade(spark, rows):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, 3), (13, None)], "id int, pid int")
    assert rows(checks.fk_orphans(child, ["pid"], parent, ["id"])) == [(3, 2)]
    assert ids(checks.check_violations(child, F.col("pid") < 3)) == [11, 12]
    grand = spark.createDataFrame([(100, 10), (101, 11), (102, None)], "id int, cid int")
    kept = checks.cascade_delete(parent.where("id = 1"), "id", [("child", child, "pid", "id"), ("grand", grand, "cid", "id")])
    assert {n: ids(df) for n, df in kept.items()} == {"child": [11, 12, 13], "grand": [101, 102]}


def test_inclusion(spark, rows):
    child = spark.createDataFrame([(1, 1), (2, 9), (2, None)], "a int, b int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = checks.inclusion_profile({"a": (child, "a"), "b": (child, "b")}, {"p": (parent, "id")})
    assert rows(got) == [("a", "p", 2, 2, 0), ("b", "p", 2, 1, 1)]


def lines(spark, *data):
    return spark.createDataFrame(list(data), "file_key string, row_no bigint, values array<string>")


def test_header_review(spark, rows):
    table = lines(
        spark, ("a", 1, ["x ", "y"]), ("a", 2, ["1", "2"]), ("b", 1, ["x", "y", ""]), ("c", 2, ["x", "z"]), ("c", 3, ["x", "y"])
    )
    with pytest.raises(ValueError, match="c"):
        review.require_first_lines(table, table)
    review.require_first_lines(table.where("file_key <> 'c'"), table.where("file_key <> 'c'"))
    got = review.header_consistency(table.where("row_no = 1 or (file_key = 'c' and row_no = 2)"), table)
    assert rows(got) == [("a", 1, False), ("b", 1, False), ("c", 1, True)]
    assert review.header_names([" x ", "", "y"]) == ["x", "column_2", "y"]
    with pytest.raises(ValueError):
        review.header_names(["x", "x "])


def test_noise_and_ranges(spark, rows):
    table = lines(
        spark, ("a", 1, ["", "t"]), ("a", 2, ["x", "y"]), ("a", 3, [" ", None]), ("a", 4, ["x", " y"]), ("a", 5, ["1", ""]), ("b", 1, [])
    )
    found = review.candidates(table)
    assert rows(found) == [("a", 2, "header"), ("a", 3, "noise"), ("a", 4, "noise"), ("b", 1, "noise")]
    heads, noise = found.where("candidate = 'header'"), found.where("candidate = 'noise'")
    assert rows(review.drop_marked(table, heads, noise), "file_key", "row_no") == [("a", 1), ("a", 5)]
    with pytest.raises(ValueError, match="header and as noise"):
        review.drop_marked(table, heads, heads)
    ranges = spark.createDataFrame([("a", 2, 3), ("a", 3, 3), ("b", 1, 9), ("z", 1, 1), ("a", 3, 2)], "file_key string, lo int, hi int")
    assert rows(review.select_ranges(table, ranges), "file_key", "row_no") == [("a", 2), ("a", 3), ("b", 1)]
    assert rows(review.bad_ranges(table, ranges)) == [("a", 3, 2), ("b", 1, 9), ("z", 1, 1)]


def test_readonly_refuses_every_writing_form(spark, tmp_path):
    spark.sql(f"create table if not exists kept_out (x int) using parquet location '{tmp_path}/t'")
    for sql in (
        "with x as (select 1 as x) insert into kept_out select x from x",
        "from (select 1 as x) insert into kept_out select x",
        "insert into kept_out values (1)",
        "drop table kept_out",
    ):
        with pytest.raises(ValueError, match="read-only"):
            facets.readonly_query(spark, sql, 5)
    shown, more = facets.readonly_query(spark, "with x as (select id from range(9)) select * from x", 5)
    assert shown.count() == 5 and more and spark.table("kept_out").count() == 0
    spark.sql("drop table kept_out")


def test_facet_list_is_whole_without_a_limit(spark):
    values = spark.range(12_000).selectExpr("false as is_null", "cast(id as string) as value_text", "1 as row_count")
    assert facets.facet_list(values).count() == 12_000 and facets.facet_list(values, 11_000).count() == 11_000


@pytest.mark.parametrize(
    "sql",
    [
        "select reflect('java.lang.System', 'setProperty', 'rawstar.x', 'y')",
        "select id from range(3) where java_method('java.lang.System', 'getProperty', 'user.home') is not null",
        "select (select max(v) from (select try_reflect('java.lang.System', 'getProperty', 'a') as v from range(2))) as x",
        "with a as (select 1 as k union all select length(reflect('java.util.UUID', 'randomUUID'))) select * from a",
    ],
)
def test_readonly_refuses_foreign_calls(spark, sql):
    with pytest.raises(ValueError, match="foreign"):
        facets.readonly_query(spark, sql, 5)
    shown, _ = facets.readonly_query(spark, "select 'reflect(x)' as reflect, (select max(id) from range(4)) as m", 5)
    assert tuple(shown.first()) == ("reflect(x)", 3)
