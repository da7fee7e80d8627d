"""Hash trees, kept facet counts, the streamed star and chains with cycles, on small tables."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from rawstar.operators import compare, facet_store, facets, hashtree, versions
from rawstar.plans import expand
from rawstar.sources import raw
from rawstar.streaming import expanding
from test_recipes import raw_row, raw_table, slot


def ranged(spark, path, rows, **options):
    side = hashtree.RangedTable(spark, str(path), "k", span=10, fanout=3, **options)
    side.write(spark.createDataFrame(rows, "k long, v string, w int"))
    return side


@pytest.mark.parametrize("low", [0, -70, -300])
def test_tree_difference_reads_only_unequal_ranges(spark, tmp_path, rows, low):
    base = [(k, f"v{k % 4}", None if k % 9 == 0 else k) for k in range(low, low + 200)]
    other = [(k, "new" if k == low + 15 else v, w) for k, v, w in base if k != low + 120] + [(low + 260, "x", 1)]
    random.Random(1).shuffle(other)
    left, right = ranged(spark, tmp_path / "a", base), ranged(spark, tmp_path / "b", other)
    found = sorted(r.node for r in hashtree.differing_ranges(left, right).collect())
    assert found == [(low + 15) // 10, (low + 120) // 10, (low + 260) // 10]
    # The folders of equal ranges are not read: what is put there now goes unseen.
    for part in (low // 10, low // 10 + 5):
        spark.createDataFrame([(part * 10, "unseen", 0)], "k long, v string, w int").write.mode("overwrite").parquet(f"{tmp_path}/a/rows/_range={part}")
    got = hashtree.tree_difference(left, right)
    assert rows(got) == rows(
        spark.createDataFrame(
            [(low + 15, "changed", "v"), (low + 120, "only left", None), (low + 260, "only right", None)],
            "k long, status string, changed string",
        )
    )


def test_equal_and_empty_trees(spark, tmp_path):
    base = [(k, None, None) for k in range(50)]
    left, right = ranged(spark, tmp_path / "a", base), ranged(spark, tmp_path / "b", base[::-1])
    empty = ranged(spark, tmp_path / "c", [])
    assert hashtree.differing_ranges(left, right).count() == 0
    assert hashtree.tree_difference(left, empty).count() == 50 and hashtree.tree_difference(empty, empty).count() == 0
    right.replace(spark.createDataFrame([(k, "y" if k == 44 else None, None) for k in range(40, 50)], "k long, v string, w int"))
    assert [tuple(r) for r in hashtree.tree_difference(left, right).collect()] == [(44, "changed", "v")]
    with pytest.raises(ValueError, match="different ranges"):
        hashtree.differing_ranges(left, hashtree.RangedTable(spark, str(tmp_path / "a"), "k", span=20))


def test_folders_hold_several_ranges_of_a_larger_table(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(hashtree, "FOLDERS", 4)
    base = [(k, f"v{k % 4}", None if k % 9 == 0 else k) for k in range(-75, 225)]
    other = [(k, "new" if k == 15 else v, w) for k, v, w in base if k != 120]
    left, right = ranged(spark, tmp_path / "a", base), ranged(spark, tmp_path / "b", other)
    for side in ("a", "b"):
        # 31 ranges, 9 to a folder.
        assert {f.name for f in (tmp_path / side / "rows").glob("_range=*")} == {f"_range={n}" for n in (-9, 0, 9, 18)}
    assert sorted(r.node for r in hashtree.differing_ranges(left, right).collect()) == [1, 12]
    want = [(15, "changed", "v"), (120, "only left", None)]
    assert rows(hashtree.tree_difference(left, right)) == rows(spark.createDataFrame(want, "k long, status string, changed string"))
    ranges = spark.createDataFrame([(1,), (-1,)], "node bigint")
    assert sorted(r.k for r in left.rows(ranges).collect()) == [*range(-10, 0), *range(10, 20)]
    # One range is replaced; others in its folder stay.
    right.replace(spark.createDataFrame([r for r in base if 10 <= r[0] < 20], "k long, v string, w int"))
    assert right.rows().count() == 299
    assert [tuple(r) for r in hashtree.tree_difference(left, right).collect()] == [(120, "only left", None)]


def test_a_row_moved_between_columns_is_seen(spark, tmp_path):
    left = ranged(spark, tmp_path / "a", [(1, None, 5), (1, None, 5), (2, "x", None)])
    right = ranged(spark, tmp_path / "b", [(1, None, 5), (2, "x", None), (2, "x", None)])
    assert hashtree.differing_ranges(left, right).count() == 1


def test_kept_counts_follow_the_partitions(spark, tmp_path, rows):
    source = str(tmp_path / "t")
    df = spark.range(60).selectExpr("id % 4 as p", "cast(id % 3 as string) as a", "nullif(id % 5, 2) as b", "id")
    df.write.partitionBy("p").parquet(source)
    store = facet_store.FacetStore(spark, str(tmp_path / "kept"), source, "p", ("a", "b"))
    assert rows(store.refresh(), "part") == [("0",), ("1",), ("2",), ("3",)]
    assert rows(store.counts()) == rows(facets.facet_counts(df, ["a", "b"]))
    assert store.refresh().count() == 0
    # One partition written anew, one gone, one new.
    df.where("p = 1").withColumn("a", F.lit("z")).write.mode("overwrite").parquet(f"{source}/p=1")
    shutil.rmtree(f"{source}/p=2")
    df.where("p = 0").drop("p").write.parquet(f"{source}/p=9")
    spark.catalog.refreshByPath(source)
    assert rows(store.refresh(), "part") == [("1",), ("9",)]
    now = spark.read.parquet(source)
    assert rows(store.counts()) == rows(facets.facet_counts(now, ["a", "b"]))


RAW = [
    raw_row(i, schema=f"g{i % 2}", integer_column_1=str(i % 4), text_column_2=["CA", "DB", "EE"][i % 3] if i < 20 else "ZZ",
            text_column_3="AB" if i < 30 else "BC", **slot(1, "1"))
    for i in range(1, 41)
]


def digests(tables):
    return {tuple(r) for r in compare.digests(compare.star_content(tables)).collect()}


def test_streamed_star_equals_the_batch_run(spark, tmp_path):
    incoming, base, state = (str(tmp_path / n) for n in ("in", "star", "state"))
    source = raw.as_raw(raw_table(spark, *RAW))
    source.where("raw_id <= 15").coalesce(1).write.parquet(incoming)
    star = expanding.expand_available(spark, incoming, base, state)
    keys = {tuple(r) for r in star.table("table3").collect()}
    source.where("raw_id > 15").repartition(3).write.mode("append").parquet(incoming)
    star = expanding.expand_available(spark, incoming, base, state, files_per_batch=1)
    assert digests(star.tables()) == digests(expand.plan_star(source).tables)
    # Keys given once stay, and no natural key has two.
    table3 = [tuple(r) for r in star.table("table3").collect()]
    assert keys <= set(table3) and len({r[0] for r in table3}) == len({r[1:] for r in table3}) == len(table3)
    # A batch taken again writes the same rows with the same keys.
    before = {n: sorted(map(str, df.collect())) for n, df in star.tables().items()}
    first = source.where("raw_id <= 15")
    star.take(first, 0)
    assert {n: sorted(map(str, df.collect())) for n, df in star.tables().items()} == before


def test_cycles_are_peeled(spark, rows):
    edges = [(1, 2), (2, 3), (3, 1), (4, 1), (5, 4), (6, 6), (7, 6), (8, 9), (9, 10), (20, 8)]
    df = spark.createDataFrame(edges, "child int, parent int")
    assert rows(versions.cycle_members(df)) == [(1,), (2,), (3,), (6,)]
    assert rows(versions.chain_ends(df)) == [(20, 10), (8, 10), (9, 10)]
    with pytest.raises(ValueError, match="4 members, first 1, 2, 3, 6"):
        versions.resolve_chain(df)
    assert versions.cycle_members(df.where("child >= 8")).count() == 0


def test_a_long_chain_and_a_long_cycle(spark):
    chain = spark.range(1000).selectExpr("id as child", "id + 1 as parent")
    assert versions.resolve_chain(chain).where("root <> 1000").count() == 0
    ring = spark.range(777).selectExpr("id as child", "(id + 1) % 777 as parent")
    assert versions.cycle_members(ring).count() == 777
