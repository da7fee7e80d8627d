"""Physical plans: what reaches the scan, and which steps shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from rawstar import testbed
from rawstar.operators import checks, compare, facets, manifest, rules
from rawstar.plans import recipes, staging
from rawstar.session import materialize

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    source = materialize(staging.stage(testbed.raw(spark, SF)))
    table3 = materialize(recipes.dim_reference(source))
    return recipes.match_reference(source, table3), materialize(recipes.dim_code(source)), source


def test_destinations_do_not_shuffle(star):
    matched, table4, _ = star
    for df in (
        recipes.fact_main(matched),
        recipes.child_measure(matched),
        recipes.bridge_code(matched, table4),
        recipes.unpivot_positions(matched),
    ):
        assert "Exchange hashpartitioning" not in plan(df) and "SortMergeJoin" not in plan(df)


def test_destinations_read_only_their_columns(star):
    text = plan(recipes.child_measure(star[0]))
    schema = text[text.index("ReadSchema: struct<raw_id") :].split("\n")[0]
    assert "integer_column_1:decimal" in schema and "numeric_column_3" not in schema


def test_manifest_reads_two_columns_and_counts_before_the_shuffle(star):
    text = plan(manifest.manifest_groups(star[2]))
    assert "partial_count" in text and "ReadSchema: struct<raw_schema:string,raw_hash:string>" in text


def test_facet_filters_reach_the_scan(spark):
    orders = testbed.table(spark, SF, "orders")
    wanted = {
        "o_orderstatus": [{"value": "F"}, {"is_null": True}],
        "o_totalprice": [{"operator": "gt", "numeric_value": "1000"}],
    }
    text = plan(facets.facet_values(orders, "o_orderpriority", wanted))
    pushed = text[text.index("PushedFilters") :].split("\n")[0]
    assert "IsNull(o_orderstatus)" in pushed and "GreaterThan(o_total" in pushed
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in text


def test_staging_parses_the_payload_once(spark):
    text = plan(staging.stage(materialize(testbed.raw(spark, SF))))
    assert text.count("from_json(") == 1 and "Exchange" not in text


def test_checks_count_before_they_shuffle(spark):
    lines = testbed.table(spark, SF, "lineitem")
    assert "partial_count" in plan(checks.unique_violations(lines, ["l_partkey"]))
    orphans = plan(checks.fk_orphans(lines, ["l_partkey"], testbed.table(spark, SF, "part"), ["p_partkey"]))
    assert "partial_count" in orphans
    digest = plan(compare.logical_digest(lines, "lineitem"))
    assert "partial_bit_xor" in digest and "Sort " not in digest and digest.count("Exchange") == 1


def test_sigma_rules_scan_the_statistics_once(spark):
    from rawstar.operators.quality import Rule, with_flags

    customers = testbed.table(spark, SF, "customer")
    text = plan(with_flags(customers, [Rule("c_acctbal", "numeric_mean_stddev_within", {"stddevs": 2})]).select(F.count("*")))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rule_entries_are_compiled_and_whole_keys_travel_as_numbers(spark):
    parent = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    child = spark.createDataFrame([(2, 5), (3, 5), (None, 6)], "pid long, n short")
    checks = [
        rules.Unique("parent id", "parent", ("id",)),
        rules.Unique("parent name", "parent", ("name",)),
        rules.Unique("n", "child", ("n",)),
        rules.Reference("pid", "child", ("pid",), "parent", ("id",)),
    ]
    found = rules.violations({"parent": parent, "child": child}, checks)
    assert {r.rule: r.violations for r in found.collect()} == {"parent id": 0, "parent name": 0, "n": 1, "pid": 1}
    text = plan(found)
    assert "lambda" not in text and not re.search(r"cast\((id|pid|n)#\d+L? as string\)", text)
