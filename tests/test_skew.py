"""Joins and numbering with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from rawstar.operators import skew, versions
from rawstar.operators.numbering import _in_order, dense_ids, group_positions
from rawstar.session import materialize, scratch_dir


@pytest.fixture(scope="module")
def hot(spark):
    """900 rows of key 7, a few of others, some without a key."""
    keys = [7] * 900 + [i % 50 for i in range(200)] + [None] * 5
    random.Random(3).shuffle(keys)
    return spark.createDataFrame(list(enumerate(keys)), "id int, k int")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([(i, f"name {i}") for i in range(0, 60, 1) if i != 13], "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(spark, hot, lookup, how, monkeypatch, rows):
    want = rows(hot.join(lookup, ["k"], how).select("id", "k"))
    for small in (True, False):
        monkeypatch.setattr(skew, "is_small", lambda df, small=small: small)
        got = skew.lookup_join(hot, lookup, ["k"], how)
        assert rows(got, "id", "k") == want
        if how in ("inner", "left"):
            assert ("name" in got.columns) and got.count() == len(want)


def test_hot_keys_are_few_and_right(spark, hot, rows):
    assert rows(skew.hot_keys(hot, ["k"], 4)) == [(7,)]


def test_is_small_measures(spark, lookup):
    assert skew.is_small(lookup)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, small in (("100b", False), ("1KB", False), ("1m", True), ("-1", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert skew.is_small(lookup) is small, limit
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_dense_ids_are_consecutive_in_order(spark, parts):
    values = [f"v{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    ids = {r.v: r.n for r in dense_ids(df, ["v"], "n", start=41, parts=parts).collect()}
    assert [ids[v] for v in sorted(values)] == list(range(41, 1041))


def test_rows_that_tie_are_spread(spark):
    ties = spark.range(2000).selectExpr("1 as k", "2 as line").repartition(4)
    sizes = [r["count"] for r in _in_order(ties, ["k", "line"], 4).groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1000
    got = [r.pos for r in group_positions(ties, ["k"], ["line"], "pos", parts=4).collect()]
    assert sorted(got) == list(range(1, 2001))
    assert sorted(r.n for r in dense_ids(ties, ["k"], "n", parts=4).collect()) == list(range(1, 2001))


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0), ["id"], "n").count() == 0


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_positions_in_a_group_over_many_partitions(spark, hot, parts):
    got = group_positions(hot, ["k"], ["id"], "pos", parts=parts).collect()
    assert len(got) == hot.count()
    groups = {}
    for r in got:
        groups.setdefault(r.k, []).append((r.pos, r.id))
    for members in groups.values():
        members.sort()
        assert [p for p, _ in members] == list(range(1, len(members) + 1))
        assert [i for _, i in members] == sorted(i for _, i in members)


def test_stored_steps_are_in_the_shared_folder(spark):
    stored = materialize(spark.range(3), "probe")
    assert scratch_dir(spark) in stored.inputFiles()[0]
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("small", [True, False])
def test_chain_with_a_hot_parent(spark, monkeypatch, small):
    monkeypatch.setattr(skew, "is_small", lambda df: small)
    parents = {i: 5 for i in range(100, 400)} | {5: 4, 4: 3, 3: 2, 2: 1} | {i: i - 1 for i in range(401, 440)}
    edges = spark.createDataFrame(list(parents.items()), "child int, parent int")

    def root(node):
        while node in parents:
            node = parents[node]
        return node

    assert {r.child: r.root for r in versions.resolve_chain(edges).collect()} == {c: root(c) for c in parents}


def test_chain_cycle_and_two_parents_are_errors(spark):
    with pytest.raises(ValueError, match="cycle"):
        versions.resolve_chain(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 1)], "child int, parent int"))
    with pytest.raises(ValueError, match="more than one"):
        versions.resolve_chain(spark.createDataFrame([(1, 2), (1, 3)], "child int, parent int"))
    assert versions.resolve_chain(spark.createDataFrame([], "child int, parent int")).count() == 0


def test_no_expression_depends_on_session_shuffle_width(spark, hot, rows):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for width in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            results.append(rows(group_positions(hot, ["k"], ["id"], "pos")))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_without_a_key_pass_by_the_join(spark, monkeypatch, rows, how):
    monkeypatch.setattr(skew, "is_small", lambda df: False)
    left = spark.createDataFrame([(None if i % 3 else i % 7, i) for i in range(200)], "k int, v int")
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "k int, name string")
    got = skew.lookup_join(left, lookup, ["k"], how)
    assert rows(got) == rows(left.join(lookup, "k", how).select(*got.columns))
