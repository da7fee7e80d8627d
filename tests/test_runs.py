"""Sources, snapshots, versions, digests, resumable runs and streaming on small files."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from rawstar.operators import compare, rules, versions
from rawstar.plans import expand, resume
from rawstar.sources import files, raw, snapshots
from rawstar.streaming import ingest
from test_recipes import raw_row, raw_table, slot


def test_scan_delimited(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('h1,h2\n"x, y",1\nshort\n1,2,3,4\n')
    (tmp_path / "b.csv").write_text("p,q,r\n")
    got = files.scan_delimited(spark, str(tmp_path), 3)
    assert rows(got.select("file_name", F.to_json("values").alias("v"), "overflow")) == [
        ("a.csv", '["1","2","3"]', "1,2,3,4"),
        ("a.csv", '["h1","h2",null]', None),
        ("a.csv", '["short",null,null]', None),
        ("a.csv", '["x, y","1",null]', None),
        ("b.csv", '["p","q","r"]', None),
    ]


def test_scan_text_and_json(spark, tmp_path, rows):
    (tmp_path / "t.txt").write_text("a|b\nc\n")
    got = files.scan_text(spark, str(tmp_path / "t.txt"), r"\|")
    assert rows(got.select(F.array_join("values", "+"))) == [("a+b",), ("c",)]
    (tmp_path / "d.json").write_text(json.dumps({"meta": 1, "data": {"items": [{"a": 1}, {"a": 2, "b": "x"}]}}, indent=1))
    schema = "data struct<items: array<struct<a: int, b: string>>>"
    got = files.scan_json(spark, str(tmp_path / "d.json"), schema, "data.items")
    assert rows(got, "row_no", "a", "b", "json_data_path") == [(1, 1, None, "data.items"), (2, 2, "x", "data.items")]


def test_file_hashes(spark, tmp_path, rows):
    (tmp_path / "x.bin").write_bytes(b"\x00\xffabc")
    assert rows(files.file_hashes(spark, str(tmp_path)), "file_hash") == [(hashlib.sha256(b"\x00\xffabc").hexdigest(),)]


def test_scan_to_raw_table(spark, tmp_path, rows):
    lines = spark.createDataFrame([("f", 2, ["1"]), ("f", 3, ["2", "b"])], "file_key string, row_no int, values array<string>")
    records = raw.envelope(raw.cells_to_columns(lines, ["n", "t"]), ["n", "t"], "g1", F.lit("hash"), F.col("file_key"))
    numbered = raw.allocate_raw_ids(records, ["file_key", "row_no"], 11)
    assert [json.loads(r.raw) for r in numbered.orderBy("raw_id").collect()] == [
        {"values": {"n": "1", "t": ""}}, {"values": {"n": "2", "t": "b"}},
    ]
    path = str(tmp_path / "raw")
    for _ in range(2):
        raw.write_batch(numbered, path, "b0")
    raw.write_batch(numbered.withColumn("raw_schema", F.lit("g2")), path, "b1")
    stored = raw.read_raw(spark, path)
    assert rows(stored, "raw_id", "raw_schema", "batch") == [(11, "g1", "b0"), (11, "g2", "b1"), (12, "g1", "b0"), (12, "g2", "b1")]
    plan = stored.where("raw_schema = 'g2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(raw_schema" in plan
    counters = spark.createDataFrame([("t", 5), ("u", 2)], "table_name string, next_raw_id bigint")
    assert rows(raw.advance_counter(counters, "t", stored)) == [("t", 13), ("u", 2)]
    assert raw.next_raw_id(counters, "none") == 1 and raw.next_raw_id(counters, "t") == 5


def test_snapshots(spark, tmp_path):
    base, target = str(tmp_path / "snap"), str(tmp_path / "out")
    df = spark.range(5)
    snapshots.write_snapshot(df, base, "0001")
    assert (tmp_path / "snap" / "version=0001" / "_SUCCESS").exists()
    with pytest.raises(Exception, match="EXISTS"):
        snapshots.write_snapshot(df, base, "0001")
    assert compare.tables_equal(snapshots.restore_new(spark, base, "0001", target), df)
    with pytest.raises(ValueError, match="exists"):
        snapshots.restore_new(spark, base, "0001", target)
    snapshots.write_snapshot(spark.range(2), base, "0002")
    assert snapshots.restore_in_place(spark, base, "0002", target).count() == 2


def test_json_objects_keep_null(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert snapshots.json_objects(df).first().json == '{"a":1,"b":null}'


def test_versions(spark, rows):
    table = spark.createDataFrame(
        [("t", "0009", "j1"), ("t", "9999", "j2"), ("u", "0000", "j1")], "table_name string, version_code string, job_id string"
    )
    names = spark.createDataFrame([("t",), ("u",), ("v",)], "table_name string")
    assert rows(versions.next_versions(table, names)) == [("t", "10000"), ("u", "0001"), ("v", "0000")]
    assert rows(versions.latest_versions(table)) == [("t", "9999", "j2"), ("u", "0000", "j1")]
    new = spark.createDataFrame([("j1", "t"), ("j3", "t"), ("j3", "t")], "job_id string, table_name string")
    assert rows(versions.register_once(table, new)) == [("j3", "t")]


def test_upsert(spark, rows):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, o int")
    new = spark.createDataFrame([(2, None, 1), (2, "late", 2), (3, "c", 1)], "k int, v string, o int")
    assert rows(versions.upsert(old, new, ["k"], "o")) == [(1, "a", 0), (2, "late", 2), (3, "c", 1)]
    assert rows(versions.upsert(old, new.where("o = 1"), ["k"])) == [(1, "a", 0), (2, None, 1), (3, "c", 1)]


def test_digest_sees_content_only(spark):
    def digest(df):
        return tuple(compare.logical_digest(df, "t").first())

    df = spark.range(100).selectExpr("id", "nullif(id % 7, 3) as v")
    assert digest(df) == digest(df.repartition(7).orderBy(F.desc("id")))
    assert digest(df) != digest(df.union(df.limit(1)))
    assert digest(df) != digest(df.withColumn("v", F.coalesce("v", F.lit(0))))
    assert digest(df.where("false")) == ("t", 0, "empty")


def test_differences(spark, rows):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "n"), (3, "z", "n"), (3, "z", "n")], "k int, v string, w string")
    b = spark.createDataFrame([(1, "x", None), (2, None, "m"), (3, "z", "n"), (4, "q", "n")], "k int, v string, w string")
    assert rows(compare.row_difference(a, b)) == [
        (2, None, "m", 0, 1), (2, "y", "n", 1, 0), (3, "z", "n", 2, 1), (4, "q", "n", 0, 1),
    ]
    assert rows(compare.keyed_difference(a.distinct(), b, ["k"])) == [(2, "changed", "v,w"), (4, "only right", None)]


RAW = [raw_row(i, schema=f"g{i % 2}", integer_column_1=str(i % 4), text_column_3="AB", **slot(1, "1")) for i in range(1, 41)]


def digests(tables):
    return {tuple(r) for r in compare.digests(compare.star_content(tables)).collect()}


def test_interrupted_run_keeps_complete_parts(spark, tmp_path):
    source = raw_table(spark, *RAW)
    whole = resume.Run(spark, str(tmp_path / "one"), "raw", ["g0", "g1"], parts=4)
    assert whole.execute(source) == 6
    run = resume.Run(spark, str(tmp_path / "two"), "raw", ["g0", "g1"], parts=4, wave=1)
    with pytest.raises(InterruptedError):
        run.stage(source, stop_after=2)
    with pytest.raises(ValueError, match="not published"):
        run.tables()
    # A part that lost rows after its checkpoint is written again, the other is kept.
    part0, part1 = (tmp_path / "two" / "staging" / run.request / f"part={i}" for i in (0, 1))
    spark.read.parquet(str(part1)).limit(3).write.mode("overwrite").parquet(str(tmp_path / "cut"))
    spark.read.parquet(str(tmp_path / "cut")).write.mode("overwrite").parquet(str(part1))
    files = {f.name for f in part0.iterdir()}
    plan = {p.part: (p.rows, p.found, p.reuse) for p in run.survey(source).parts}
    assert plan == {0: (10, 10, True), 1: (10, 3, False), 2: (10, None, False), 3: (10, None, False)}
    assert run.execute(source) == 6
    assert {f.name for f in part0.iterdir()} == files
    assert digests(run.tables()) == digests(whole.tables()) == digests(expand.plan_star(source).tables)


def test_only_changed_ranges_are_staged_again(spark, tmp_path):
    rows = [raw_row(i, schema="g0", text_column_3="AB", **slot(1, "1")) for i in range(1, 41)]
    run = resume.Run(spark, str(tmp_path), "raw", ["g0"], parts=4)
    assert run.execute(raw_table(spark, *rows)) == 6

    def stale(table):
        return {p.part for p in run.survey(table).parts if not p.reuse}

    # The payload alone decides: id, hash, tab and batch stay as they are.
    rows[14] = raw_row(15, schema="g0", text_column_3="", **slot(1, "1"))
    changed = raw_table(spark, *rows)
    assert stale(changed) == {1}
    assert run.execute(changed) == 6 and run.execute(changed) == 0
    assert digests(run.tables()) == digests(expand.plan_star(changed).tables)
    # Further ids are further ranges, also below the first; a range that lost all rows is left out.
    grown = [raw_row(-3, schema="g0", **slot(1, "1")), *rows[:20], *rows[30:], raw_row(41, schema="g0"), raw_row(90, schema="g0")]
    grown_table = raw_table(spark, *grown)
    assert stale(grown_table) == {-1, 4, 8}
    assert run.execute(grown_table) == 6
    assert digests(run.tables()) == digests(expand.plan_star(grown_table).tables)


def test_a_row_listed_twice_changes_the_fingerprint(spark):
    one, twice = raw_table(spark, RAW[0], RAW[1]), raw_table(spark, RAW[0], RAW[1], RAW[1], RAW[1])
    marks = [resume.fingerprints(t, resume.Ranges(1, 10)).first() for t in (one, twice)]
    assert marks[0].mark != marks[1].mark and [m.rows for m in marks] == [2, 4]


def test_lost_registration_is_made_up_without_new_rows(spark, tmp_path, monkeypatch):
    source = raw_table(spark, *RAW)
    run = resume.Run(spark, str(tmp_path), "raw", ["g0", "g1"], parts=2)
    run.write(source)
    before = digests(run.tables())
    monkeypatch.setattr(expand, "write_star", lambda *a: pytest.fail("rows written again"))
    assert run.execute(source) == 6
    assert run.execute(source) == 0
    assert digests(run.tables()) == before
    found = run._versions()
    assert found.count() == 6 and {r.version_code for r in found.collect()} == {"0000"}
    totals = json.loads(found.first().manifest)
    assert totals == {"expected_row_count": 40, "expected_distinct_raw_hash_count": 1}


def test_failed_checks_and_missing_scope_publish_nothing(spark, tmp_path):
    twice = resume.Run(spark, str(tmp_path / "a"), "raw", ["g1"], parts=1)
    with pytest.raises(ValueError, match="table1 source row unique"):
        twice.execute(raw_table(spark, RAW[0], RAW[0]))
    missing = resume.Run(spark, str(tmp_path / "b"), "raw", ["g0", "g7"], parts=1)
    with pytest.raises(ValueError, match="g7"):
        missing.execute(raw_table(spark, *RAW))
    for run in (twice, missing):
        with pytest.raises(ValueError, match="not published"):
            run.tables()


def test_job_identity():
    assert resume.job_id("s", ["a"], ["r"]) == resume.job_id("s", ["a"], ["r"]) != resume.job_id("s", ["b"], ["r"])


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    incoming, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    source = raw.as_raw(raw_table(spark, *RAW))
    source.where("raw_id <= 15").write.parquet(incoming)
    assert ingest.ingest_available(spark, incoming, out, state).count() == 15
    assert ingest.ingest_available(spark, incoming, out, state).count() == 15
    source.where("raw_id > 15").repartition(3).write.mode("append").parquet(incoming)
    got = ingest.ingest_available(spark, incoming, out, state, files_per_batch=1)
    assert rows(got, "raw_id") == rows(source, "raw_id")


def test_a_finished_job_sees_the_grown_source(spark, tmp_path):
    half, whole = raw_table(spark, *RAW[:20]), raw_table(spark, *RAW)
    run = resume.Run(spark, str(tmp_path), "raw", ["g0", "g1"], parts=2)
    assert run.execute(half) == 6 and run.execute(half) == 0
    assert run.execute(whole) == 6
    assert digests(run.tables()) == digests(expand.plan_star(whole).tables)
    # Another process finds the job that was published last.
    assert digests(resume.Run(spark, str(tmp_path), "raw", ["g0", "g1"], parts=2).tables()) == digests(run.tables())
    assert {r.version_code for r in run._versions().collect()} == {"0000", "0001"}


def test_violations_are_found(spark):
    tables = dict(expand.plan_star(raw_table(spark, *RAW)).tables)
    tables["table2"] = tables["table2"].unionByName(tables["table2"].limit(1))
    tables["table3"] = tables["table3"].limit(0)
    found = {r.rule: r.violations for r in resume.star_problems(tables).where("violations > 0").collect()}
    assert found["table2 position unique"] == 1 and "table1 reference" in found


def test_rules_count_every_kind_of_violation(spark, rows):
    parent = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "c")], "id long, name string")
    child = spark.createDataFrame(
        [(1, 1, "x"), (2, 9, "x"), (3, 9, None), (3, None, "y"), (4, 8, "z")], "id int, parent_id int, kind string"
    )
    found = rules.violations(
        {"parent": parent, "child": child, "empty": parent.limit(0)},
        [
            rules.Unique("parent id", "parent", ("id",)),
            rules.Unique("parent name", "parent", ("name",)),
            rules.Unique("pair", "parent", ("id", "name")),
            rules.Unique("some", "parent", ("name",), "id > 1"),
            rules.not_null("set", "parent", "id"),
            rules.Reference("fk", "child", ("parent_id",), "parent", ("id",)),
            rules.Reference("fk id", "child", ("id",), "parent", ("id",)),
            rules.Reference("fk none", "child", ("id",), "empty", ("id",)),
            rules.RowTest("kind", "child", "kind <> 'x'"),
        ],
    )
    assert rows(found) == [
        ("fk", 2), ("fk id", 2), ("fk none", 4), ("kind", 2), ("pair", 0), ("parent id", 1), ("parent name", 1), ("set", 1), ("some", 0),
    ]
    with pytest.raises(ValueError, match="types"):
        rules.violations({"parent": parent, "child": child}, [rules.Reference("fk", "child", ("kind",), "parent", ("id",))])


def test_star_rules_need_one_shuffle_of_keys(spark):
    tables = {
        name: spark.createDataFrame([], df.schema)
        for name, df in expand.plan_star(raw_table(spark, *RAW)).tables.items()
    }
    text = resume.star_problems(tables)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") <= 10
