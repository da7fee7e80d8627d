"""Steps whose work must not grow faster than their input: what is derived once, what is dealt out by size."""

import datetime

import pytest
from pyspark.sql import functions as F

from rawstar import layout, testbed
from rawstar.catalog import comparing, expansion
from rawstar.functions import fields
from rawstar.operators import profile

DAY = datetime.datetime(2024, 4, 1)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Orders with no, one and several lines; flags below, between and above the known ones, and none."""
    path = str(tmp_path_factory.mktemp("growth"))
    spark.createDataFrame(
        [(k, k * 7, "O", 100.25 + k, DAY, "1-URGENT") for k in range(60)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{path}/orders.parquet")
    flags = ["R", "A", "N", "B", "0", None, "S"]
    lines = [(k, n, flags[(k + n) % 7], float(k), 0.05) for k in range(1, 60) for n in range(1, k % 8)]
    # The same position twice: the least flag, the summed quantity and the greatest discount count.
    lines += [(k, 1, flags[(3 * k) % 7], 2.5, 0.07) for k in range(1, 60, 2)] + [(7, 20, "R", 1.0, 0.0), (None, 1, "R", 1.0, 0.0)]
    lines += [(9, 2, "R", None, None)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_returnflag string, l_quantity double, l_discount double"
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.fixture
def stored(monkeypatch):
    """Labels of the tables that the catalog stores."""
    labels = []
    for module in (expansion, comparing, profile, expansion.expand):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label="step", plain=plain: labels.append(label) or plain(df, label))
    return labels


def test_positions_are_those_of_the_sql(spark, sf, rows):
    text = testbed.POSITION_SQL.format(s="string").replace("from lineitem", "from {lineitem}")
    want = spark.sql(text, lineitem=testbed.table(spark, sf, "lineitem"))
    assert rows(testbed.positions(spark, sf)) == rows(want)


def test_raw_shuffles_each_table_once(spark, sf):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = testbed.raw(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Exchange hashpartitioning") == 2, plan
    # Text in a buffer would make it a sort for each aggregation.
    assert "SortAggregate" not in plan


def test_raw_payload_has_every_header_in_order(spark, sf):
    found = {r.raw_id: r.raw for r in testbed.raw(spark, sf).collect()}
    assert len(found) == 60
    assert found[1].startswith('{"values":{"id_column_1":"  0 "')  # no lines
    names = spark.createDataFrame([(found[8],), (found[1],)], "raw string").select(F.json_object_keys(F.get_json_object("raw", "$.values")))
    assert [r[0] for r in names.collect()] == [layout.PAYLOAD_KEYS] * 2
    # A quantity that is not known is a null in the payload, not an absent header.
    null_row = [r for r in testbed.positions(spark, sf).where("w is null or g is null").collect()]
    assert all('":null' in found[r.k + 1] for r in null_row)


def test_bridge_stages_once(spark, sf, stored):
    assert expansion.bridge_code(spark, sf).count() > 0
    assert stored.count("staging") == 1


def test_unstaged_run_and_counters_derive_their_rows_once(spark, sf, stored):
    assert expansion.expand_unstaged_counts(spark, sf).count() == 6
    assert expansion.row_counters(spark, sf).count() == 4
    assert stored.count("records") == 2


def test_dimensions_parse_their_headers_only(spark, sf):
    plan = expansion.dim_code(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    parsed = plan[plan.index("from_json") :].split(")")[0]
    assert "text_column_3" in parsed and "integer_column_2" not in parsed


def test_arriving_files_grow_with_the_table(spark, tmp_path):
    rows = raw_rows(spark, 4000)
    whole = str(tmp_path / "whole")
    rows.repartition(12).write.parquet(whole)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        read = spark.read.schema(layout.RAW_SCHEMA).parquet(whole)
        wide = comparing._arrive(read, str(tmp_path / "wide"), 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert wide >= 12
    few = comparing._arrive(rows.coalesce(1), str(tmp_path / "few"), 3)
    assert few == 3
    assert comparing._arrive(rows.coalesce(1), str(tmp_path / "few"), 2) == 2
    assert spark.read.parquet(str(tmp_path / "few")).count() == 8000
    assert [comparing._share(n, 2) for n in (1, 2, 3, 40)] == [1, 1, 2, 20]


def raw_rows(spark, n):
    return spark.range(n).selectExpr(
        "id as raw_id", "'h' as raw_hash", "timestamp '2024-04-01' as raw_ingested_at", "'g' as raw_schema", "'t' as raw_tab", "concat('{', id, '}') as raw"
    )


def test_documents_of_a_profile_are_derived_once(spark, stored):
    docs = spark.createDataFrame([('{"a": [1, 2]}',), (None,)], "raw string")
    assert profile.json_profile(docs, "raw").count() == 3
    assert stored.count("json-level") == 4  # the documents, two levels below, and the empty one that ends it


def test_capital_and_small_exponents_are_seen(spark):
    values = spark.createDataFrame([("1e-20",), ("1E-20",), ("1.5",), ("12E1",)], "v string")
    found = values.selectExpr(f"{fields.fits_sql('v', layout.NUMERIC)} as ok").collect()
    assert [r.ok for r in found] == [False, False, True, True]


def test_a_plain_session_gets_small_methods(spark, sf):
    import __spark_entry__ as entry

    kept = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        entry.queries()["dim_code"](spark, sf)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", kept)


def test_files_are_written_and_parsed_once(spark, sf, monkeypatch):
    from rawstar.catalog import ingestion
    from rawstar.plans import importing

    written, labels = [], []
    write, keep = ingestion._line_files, importing.materialize
    monkeypatch.setattr(ingestion, "_line_files", lambda *a: written.append(1) or write(*a))
    monkeypatch.setattr(importing, "materialize", lambda df, label="step": labels.append(label) or keep(df, label))
    assert ingestion.import_files(spark, sf).count() > 0
    assert len(written) == 1 and labels.count("scanned-lines") == 1
