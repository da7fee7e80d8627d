"""Numbered scans, digests of files, the import plan and row ranges."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from rawstar.operators import checks, review
from rawstar.plans import importing
from rawstar.sources import files


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of a few lines."""
    names = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_lines_are_numbered_across_splits(spark, tmp_path, rows, small_splits):
    r = random.Random(1)
    want = []
    for name, size in (("a.txt", 300), ("b.txt", 1), ("c.txt", 77)):
        lines = ["" if r.random() < 0.2 else f"{name} " + "é" * r.randint(0, 30) for _ in range(size)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want += [(name, i, line) for i, line in enumerate(lines, 1)]
    (tmp_path / "empty.txt").write_text("")
    got = files.numbered_text(spark, str(tmp_path)).withColumn("name", F.regexp_extract("file_path", "([^/]+)$", 1))
    assert rows(got, "name", "row_no", "value") == rows(spark.createDataFrame(want, "name string, row_no long, value string"))


def digest_tree(lines, fanout):
    level = [sha(x) for x in lines]
    while len(level) > 1:
        level = [sha("".join(level[k : k + fanout])) for k in range(0, len(level), fanout)]
    return level[0]


@pytest.mark.parametrize("fanout", [2, 3, 4096])
def test_a_file_beyond_one_read_is_hashed_in_pieces(spark, tmp_path, small_splits, fanout):
    """The whole-file reader refuses these files; lines of a file are hashed by several tasks."""
    texts = {f"{n}.txt": [f"line {i % 7}" for i in range(n)] for n in (1, 2, 9, 10, 200)}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        with pytest.raises(Exception, match="(?i)max.?length|exceeds"):
            files.file_hashes(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    found = files.line_digests(files.numbered_text(spark, str(tmp_path)), fanout).collect()
    got = {r.file_path.rsplit("/", 1)[1]: (r.file_hash, r.line_count) for r in found}
    assert got == {name: (digest_tree(lines, fanout), len(lines)) for name, lines in texts.items()}


def importer_of(spark, tmp_path):
    return importing.Importer(spark, str(tmp_path / "base"), "public.raw_data")


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_import_end_to_end(spark, tmp_path, small_splits):
    first = write(tmp_path / "one", a='k, v ,\n1,"x, y",p\n\n2,,q\nk,v\n', b="\nid,name\n7,n\nid,name\n8,m\n")
    importer = importer_of(spark, tmp_path)
    # a has a header of three cells, the last one blank, so its first full line is data unless marked.
    lines = importer.scan(first, 3)
    key = {r.file_key.rsplit("/", 1)[1]: r.file_key for r in lines.select("file_key").distinct().collect()}
    marks = spark.createDataFrame(
        [(key["a.csv"], 1, "header"), (key["a.csv"], 3, "noise"), (key["a.csv"], 5, "noise"),
         (key["b.csv"], 1, "noise"), (key["b.csv"], 2, "header"), (key["b.csv"], 4, "noise")],
        "file_key string, row_no bigint, candidate string",
    )
    assert importer.add(first, "g1", "b1", 3, marks=marks) == "0000"
    got = {r.raw_id: (r.raw_tab, json.loads(r.raw)["values"]) for r in importer.rows().collect()}
    assert got == {
        1: ("a.csv", {"k": "1", "v": "x, y", "column_3": "p"}),
        2: ("a.csv", {"k": "2", "v": "", "column_3": "q"}),
        3: ("b.csv", {"id": "7", "name": "n"}),
        4: ("b.csv", {"id": "8", "name": "m"}),
    }
    hashes = {r.raw_tab: r.raw_hash for r in importer.rows().collect()}
    assert hashes["b.csv"] == digest_tree(["", "id,name", "7,n", "id,name", "8,m"], files.FANOUT)
    with pytest.raises(ValueError, match="already imported"):
        importer.add(first, "g1", "b1", 3)
    # Suggested marks: the first line without a blank cell, its repeats and blank lines. Ids go on.
    second = write(tmp_path / "two", c="h1,h2\n" + "".join("h1,h2\n" if i % 5 == 0 else f"{i},x{i}\n" for i in range(400)))
    assert importer.add(second, "g1", "b2", 2) == "0001"
    rows = {r.raw_id: json.loads(r.raw)["values"] for r in importer.rows().where("batch = 'b2'").collect()}
    assert rows == {5 + n: {"h1": str(i), "h2": f"x{i}"} for n, i in enumerate(i for i in range(400) if i % 5)}
    seen = {r.version_code: (r.batch, r.row_count, r.file_count, r.first_raw_id, r.last_raw_id) for r in importer.versions().collect()}
    assert seen == {"0000": ("b1", 4, 2, 1, 4), "0001": ("b2", 320, 1, 5, 324)}
    assert spark.read.parquet(importer.versions().where("version_code = '0001'").first().snapshot).count() == 320


def test_an_import_that_stopped_is_run_again(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "in", a="k,v\n1,x\n2,y\n")
    importer = importer_of(spark, tmp_path)
    with monkeypatch.context() as broken:
        broken.setattr(importing.Importer, "_register", lambda *a: (_ for _ in ()).throw(InterruptedError("stopped")))
        with pytest.raises(InterruptedError):
            importer.add(path, "g1", "b1", 2)
    assert importer.rows().count() == 0
    assert importer.add(path, "g1", "b1", 2) == "0000"
    assert sorted(r.raw_id for r in importer.rows().collect()) == [1, 2]


@pytest.mark.parametrize(
    "text,width,message",
    [("a,a\n1,2\n", 2, "repeats a name"), (",\n,\n", 2, "no first line"), ("a,b\n1,2,3\n", 2, "more cells than the width")],
)
def test_imports_that_fail_leave_no_version(spark, tmp_path, text, width, message):
    importer = importer_of(spark, tmp_path)
    with pytest.raises(Exception, match=message):
        importer.add(write(tmp_path / "in", a=text), "g1", "b1", width)
    assert importer.versions().count() == 0


def test_ids_of_kept_lines(spark, rows):
    r = random.Random(2)
    keys = [(f, i) for f, n in (("a", 50), ("b", 3), ("c", 91)) for i in range(1, n + 1)]
    kept = [k for k in keys if r.random() < 0.6]
    df = spark.createDataFrame(keys, "file_key string, row_no long")
    got = importing.numbered(spark.createDataFrame([(*k, "x") for k in kept], "file_key string, row_no long, v string"), df, 100, chunk=8)
    assert sorted((r.raw_id, r.file_key, r.row_no) for r in got.collect()) == [(100 + n, *k) for n, k in enumerate(kept)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


@pytest.mark.parametrize("bucket", [1, 7, 1024])
def test_row_ranges(spark, bucket):
    r = random.Random(3)
    lines = [(f, i) for f in "abc" for i in range(-3, 120)]
    ranges = [(f, lo, lo + r.randint(-2, 30)) for f in "abx" for lo in [r.randint(-5, 130) for _ in range(12)]] + [("c", 5, 5), ("c", 6, 9)]
    want = sorted(x for x in lines if any(f == x[0] and lo <= x[1] <= hi for f, lo, hi in ranges))
    got = review.select_ranges(
        spark.createDataFrame(lines, "file_key string, row_no long"), spark.createDataFrame(ranges, "file_key string, lo long, hi long"), bucket
    )
    assert sorted(map(tuple, got.collect())) == want


def test_a_hundred_thousand_ranges_of_one_file(spark):
    ranges = spark.range(100_000).selectExpr("'f' as file_key", "id * 10 as lo", "id * 10 + id % 4 as hi")
    lines = spark.range(1_000_000).selectExpr("'f' as file_key", "id as row_no")
    got = review.select_ranges(lines, ranges)
    assert got.count() == sum(1 + i % 4 for i in range(100_000))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_inclusion_of_columns(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (2, None), (3, "y")], "n int, s string")
    b = spark.createDataFrame([(1, "1"), (2, "z")], "m long, t string")
    got = checks.inclusion_profile({"a.n": (a, "n"), "a.s": (a, "s")}, {"b.m": (b, "m"), "b.t": (b, "t")})
    assert rows(got, "child", "parent", "distinct_values", "matched", "missing") == [
        ("a.n", "b.m", 3, 2, 1), ("a.n", "b.t", 3, 1, 2), ("a.s", "b.m", 2, 0, 2), ("a.s", "b.t", 2, 0, 2),
    ]
    assert "Generate explode" not in got._jdf.queryExecution().analyzed().toString().split("Aggregate [holders")[-1]
