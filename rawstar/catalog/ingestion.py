"""Source, raw table and sink queries. Files are written from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import testbed
from rawstar.catalog.registry import Registry
from rawstar.operators import manifest
from rawstar.plans import importing, staging
from rawstar.session import materialize, scratch_path
from rawstar.sources import files, raw, snapshots
from rawstar.testbed import LINES_CTE, oracle, table

reg = Registry()


_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _line_files(spark, sf):
    """The lines as one CSV file for each file key, in the order of their numbers."""
    path = scratch_path(spark, "csv")
    cells = [F.col("values")[i].alias(f"c{i + 1}") for i in range(3)]
    lines = testbed.lines(spark, sf).repartition("file_key").sortWithinPartitions("file_key", "row_no")
    written = lines.select("file_key", *cells).write.partitionBy("file_key")
    written.csv(path, emptyValue="", quoteAll=True, **_SPACES)
    return path


def _file_key(path="file_path"):
    return F.regexp_extract(path, "file_key=([^/]+)/", 1)


# What the files hold: lines numbered by their place, cells as they are written.
_FILES_CTE = f"""{LINES_CTE},
fl as (
  select file_key, row_number() over (partition by file_key order by row_no) as row_no,
    coalesce(c1, '') as c1, coalesce(c2, '') as c2, coalesce(c3, '') as c3,
    array_to_string(list_transform([c1, c2, c3], lambda v: '"' || coalesce(v, '') || '"'), ',') as line
  from ln)"""


@reg.query(oracle("select file_key, row_no, c1, c2, c3, false as has_overflow from fl", _FILES_CTE))
def scan_text_rows(spark, sf):
    scanned = files.scan_lines(spark, _line_files(spark, sf), 5, recursiveFileLookup=True, **_SPACES)
    cells = F.col("values")
    return scanned.select(
        _file_key().alias("file_key"),
        "row_no",
        *[F.coalesce(cells[i - 1], F.lit("")).alias(f"c{i}") for i in (1, 2, 3)],
        F.col("overflow").isNotNull().alias("has_overflow"),
    )


# Two levels of sixteen hold the files of the smallest scale; a level over one digest changes nothing.
_HASH_CTE = f"""{_FILES_CTE},
h0 as (select file_key, row_no - 1 as i, sha256(line) as d from fl),
{", ".join(f"""h{k + 1} as (
  select file_key, i // 16 as i, case when count(*) = 1 and i // 16 = 0 and min(i) = 0 then any_value(d)
    else sha256(string_agg(d, '' order by i)) end as d from h{k} group by file_key, i // 16)""" for k in range(6))}"""


@reg.query(
    oracle(
        "select file_key, d as file_hash, line_count from h6 join (select file_key, count(*) as line_count from fl group by 1) using (file_key)",
        _HASH_CTE,
    )
)
def file_digests(spark, sf):
    """Hash trees of sixteen lines a node, so that a file has several levels."""
    lines = files.numbered_text(spark, _line_files(spark, sf), recursiveFileLookup=True)
    return files.line_digests(lines, fanout=16).select(_file_key().alias("file_key"), "file_hash", "line_count")


_IMPORT_CTE = f"""{_FILES_CTE},
cl as (select file_key, row_no, c1, c2, c3, trim(c1) as a, trim(c2) as b, trim(c3) as c from fl),
hd as (
  select file_key, min(row_no) as hr, min_by(a, row_no) as ha, min_by(b, row_no) as hb, min_by(c, row_no) as hc
  from cl where a <> '' and b <> '' and c <> '' group by file_key),
kept as (
  select file_key, row_no, c1, c2, c3, ha, hb, hc from cl join hd using (file_key)
  where row_no <> hr and not (a = ha and b = hb and c = hc) and not (a = '' and b = '' and c = ''))"""


@reg.query(
    oracle(
        """select row_number() over (order by file_key, row_no) as raw_id, file_key, 'group001' as raw_schema, 'b1' as batch,
  cast(json_object('values', json_object(ha, c1, hb, c2, hc, c3)) as varchar) as raw, '0000' as version_code,
  (select count(*) from kept) as row_count, (select count(*) from hd) as file_count
from kept""",
        _IMPORT_CTE,
    )
)
def import_files(spark, sf):
    """Files to raw table: numbered lines, suggested headers and noise, ids, batch, snapshot, version."""
    importer = importing.Importer(spark, scratch_path(spark, "import"), "public.raw_data")
    options = {"recursiveFileLookup": True, **_SPACES}
    path = _line_files(spark, sf)
    importer.add(path, "group001", "b1", 3, **options)
    hashes = materialize(files.line_digests(files.numbered_text(spark, path, recursiveFileLookup=True)), "hashes")
    keys = hashes.select(_file_key().alias("file_key"), F.col("file_hash").alias("raw_hash"))
    version = importer.versions().select("raw_schema", "batch", "version_code", "row_count", "file_count")
    rows = importer.rows().join(keys, "raw_hash").join(version, ["raw_schema", "batch"])
    return rows.select("raw_id", "file_key", "raw_schema", "batch", "raw", "version_code", "row_count", "file_count")


@reg.query(
    """select doc_id, cast(i as integer) as row_no, line, 'data.items' as json_data_path from (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
  from documents)"""
)
def json_rows(spark, sf):
    path = scratch_path(spark, "json")
    documents = table(spark, sf, "documents").select(
        F.struct(
            F.transform(
                F.split("text", "\n"), lambda v: F.struct(F.col("doc_id").alias("doc_id"), v.alias("line"))
            ).alias("items")
        ).alias("data"),
        F.col("lang").alias("unused"),
    )
    documents.write.json(path)
    # One document per line here, so the files stay splittable.
    read = spark.read.schema("data struct<items: array<struct<doc_id: bigint, line: string>>>").json(path)
    return files.json_rows(read, "data.items").select(
        "doc_id", "row_no", "line", F.lit("data.items").alias("json_data_path")
    )


@reg.query(
    """select n_nationkey as id, n_name as name, n_regionkey as parent, cast(null as varchar) as segment, 'nation' as source
from nation union all select r_regionkey, r_name, null, null, 'region' from region
union all select c_custkey, c_name, c_nationkey, c_mktsegment, 'customer' from customer"""
)
def union_sources(spark, sf):
    def named(source, **columns):
        types = {"id": "bigint", "name": "string", "parent": "int", "segment": "string"}
        return table(spark, sf, source).select(*[F.col(c).cast(types[n]).alias(n) for n, c in columns.items()])

    return files.combine(
        {
            "nation": named("nation", id="n_nationkey", name="n_name", parent="n_regionkey"),
            "region": named("region", id="r_regionkey", name="r_name"),
            "customer": named("customer", id="c_custkey", name="c_name", parent="c_nationkey", segment="c_mktsegment"),
        }
    )


@reg.query("select doc_id, sha256(text) as raw_hash from documents")
def content_hash(spark, sf):
    return files.content_hash(table(spark, sf, "documents"), "text").select("doc_id", "raw_hash")


@reg.query(
    """select o_orderkey as row_key, 'group001' as raw_schema, 'Sheet1' as raw_tab,
  concat('h', cast(o_custkey % 3 as varchar)) as raw_hash,
  cast(json_object('values', json_object('o_orderkey', cast(o_orderkey as varchar), 'o_orderstatus', o_orderstatus,
    'o_orderpriority', case when o_orderkey % 7 = 0 then '' else o_orderpriority end)) as varchar) as raw from orders"""
)
def raw_envelope(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    )
    records = raw.envelope(
        orders,
        ["o_orderkey", "o_orderstatus", "o_orderpriority"],
        "group001",
        F.concat(F.lit("h"), (F.col("o_custkey") % 3).cast("string")),
        F.lit("Sheet1"),
    )
    return records.select(F.col("o_orderkey").alias("row_key"), "raw_schema", "raw_tab", "raw_hash", "raw")


_NEXT = "(select max(o_orderkey) + 2 from orders)"


@reg.query(
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, {_NEXT} - 1 + row_number() over (
  order by l_orderkey, l_linenumber, l_partkey, l_suppkey) as raw_id from lineitem"""
)
def raw_id_alloc(spark, sf):
    """Lines appended after the orders: ids go on from the orders table's counter."""
    used = table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("raw_id"))
    start = spark.createDataFrame([], "table_name string, next_raw_id bigint")
    counters = raw.advance_counter(start, "public.raw_data", used)
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(*key)
    return raw.allocate_raw_ids(lines, key, raw.next_raw_id(counters, "public.raw_data"))


def _batches(spark, sf):
    records = materialize(testbed.raw(spark, sf), "records")
    ends = records.agg(F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi")).first()
    number = staging.range_number(F.col("raw_id"), F.lit(ends.lo), F.lit(ends.hi), 4)
    return records.withColumn("part", number)


def _store(spark, sf):
    path = scratch_path(spark, "raw-table")
    records = _batches(spark, sf)
    for part in (0, 1, 2, 3, 1):  # batch 1 is run again, as after a failure
        raw.write_batch(records.where(F.col("part") == part), path, f"b{part}")
    return records, raw.read_raw(spark, path)


_BATCH = """(select raw_schema, raw_id, concat('b', cast(
  ((raw_id - lo + 1) * 4 - 1) // (hi - lo + 1) as varchar)) as batch
  from base, (select min(raw_id) as lo, max(raw_id) as hi from base))"""


@reg.query(
    oracle(
        f"""select raw_schema, batch, count(*) as row_count, cast(sum(raw_id) as bigint) as id_sum
from {_BATCH} group by raw_schema, batch"""
    )
)
def append_batches(spark, sf):
    _, stored = _store(spark, sf)
    return stored.groupBy("raw_schema", "batch").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("raw_id").alias("id_sum")
    )


@reg.query(
    oracle(
        f"select batch, count(*) as expected, count(*) as found, true as complete from {_BATCH} group by batch"
    )
)
def count_check(spark, sf):
    records, stored = _store(spark, sf)
    batch = F.concat(F.lit("b"), F.col("part").cast("string")).alias("batch")
    expected = records.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))
    manifest.require_count(stored, records.count())
    return raw.count_check(expected, stored.groupBy("batch").agg(F.count(F.lit(1)).alias("n")), "batch")


@reg.query(oracle("select raw_id, raw_hash, raw_schema, raw_tab, id_column_1 from base"))
def restore_roundtrip(spark, sf):
    base, target = scratch_path(spark, "snapshots"), scratch_path(spark, "restored")
    snapshots.write_snapshot(testbed.raw(spark, sf), base, "0001")
    restored = snapshots.restore_new(spark, base, "0001", target)
    return restored.select(
        "raw_id", "raw_hash", "raw_schema", "raw_tab", F.get_json_object("raw", "$.values.id_column_1").alias("id_column_1")
    )


@reg.query(
    """select cast(json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus,
  'o_orderpriority', case when o_orderkey % 7 = 0 then null else o_orderpriority end) as varchar) as json from orders"""
)
def export_json(spark, sf):
    path = scratch_path(spark, "export")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    )
    snapshots.export_json(orders, path)
    return spark.read.text(path).withColumnRenamed("value", "json")
