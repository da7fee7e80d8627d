"""Stored tables with a hash tree over their key ranges, so that a comparison reads only what differs.

A table is stored by ranges of ``span`` keys. A folder holds one range, or, of a table with more than
``FOLDERS`` ranges, those below one node of the lowest level that has no more nodes than that: a folder costs
some milliseconds in every write and listing, so their number must not grow with the table. Beside
the rows stands the tree: for every node of every level (part 0 covers ``span`` keys, a node above ``fanout`` nodes) the number of its rows and a
digest of their content, whatever their order. Counts and digests of a node are those of its
children added up, so the tree of a range takes one scan of it and no sort.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawstar.operators.compare import keyed_difference
from rawstar.operators.skew import lookup_join
from rawstar.session import materialize

META = "columns string, width bigint"
TREE = "level int, node bigint, rows bigint, mix bigint, total decimal(38,0)"
PART = "_range"
FOLDERS = 512


def _floor_div(value: Column, by: int) -> Column:
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


@dataclass(frozen=True)
class RangedTable:
    """A table under ``path`` with a whole-number ``key``, which may repeat but not be NULL."""

    spark: SparkSession
    path: str
    key: str
    span: int = 100_000
    fanout: int = 16

    def _range(self) -> Column:
        return _floor_div(F.col(self.key).cast("bigint"), self.span)

    def _folder(self, node: Column, width: int) -> Column:
        """The first of the ``width`` ranges that share a folder."""
        return node - F.pmod(node, F.lit(width))

    def _write_rows(self, df: DataFrame, width: int, mode: str) -> None:
        ranged = df.withColumn(PART, self._folder(self._range(), width))
        # Rows of a folder meet in a few tasks, as many as its size needs, in the order of their keys.
        placed = ranged.hint("rebalance", PART).sortWithinPartitions(PART, self.key)
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(PART).parquet(f"{self.path}/rows")

    def write(self, df: DataFrame) -> None:
        """Store the table and its tree; what was there is replaced."""
        ranges = materialize(df.select(self._range().alias("node")).distinct(), "key-ranges")
        width = 1
        while ranges.select(self._folder(F.col("node"), width)).distinct().count() > FOLDERS:
            width *= self.fanout
        self._write_rows(df, width, "static")
        # An empty table has no file to tell its columns.
        named = self.spark.createDataFrame([(df.schema.json(), width)], META)
        named.coalesce(1).write.mode("overwrite").json(f"{self.path}/columns")
        self._tree(df.columns).write.mode("overwrite").parquet(f"{self.path}/tree")

    def replace(self, df: DataFrame) -> None:
        """Store rows again for the ranges that ``df`` has; the tree follows."""
        width = self._width()
        if width > 1:
            # Other ranges of the same folders stay as they are.
            new = materialize(df.select(self._range().alias("node")).distinct(), "new-ranges")
            folders = materialize(new.select(self._folder(F.col("node"), width).alias(PART)).distinct(), "folders")
            beside = lookup_join(self._stored(), folders, [PART], "left_semi").withColumn(PART, self._range())
            beside = lookup_join(beside, new.withColumnRenamed("node", PART), [PART], "left_anti").select(*df.columns)
            df = df.unionByName(materialize(beside, "beside"))
        self._write_rows(df, width, "dynamic")
        self._tree(df.columns).write.mode("overwrite").parquet(f"{self.path}/tree")

    def _tree(self, columns: list[str]) -> DataFrame:
        rows = self._stored()
        row = F.xxhash64(*columns, F.array(*[F.col(c).isNull() for c in columns]))
        other = F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)")
        level = rows.groupBy(self._range().alias("node")).agg(
            F.count(F.lit(1)).alias("rows"), F.bit_xor(row).alias("mix"), F.sum(other).cast("decimal(38,0)").alias("total")
        )
        level = materialize(level, "tree-leaves")
        tree, number = level.withColumn("level", F.lit(0)), 0
        ends = level.agg(F.min("node").alias("lo"), F.max("node").alias("hi")).first()
        low, high = ends.lo or 0, ends.hi or 0
        # Nodes -1 and 0 hold the keys below and above zero: no level joins them.
        while low < -1 or high > 0:
            number += 1
            low, high = low // self.fanout, high // self.fanout
            level = level.groupBy(_floor_div(F.col("node"), self.fanout).alias("node")).agg(
                F.sum("rows").alias("rows"), F.bit_xor("mix").alias("mix"), F.sum("total").cast("decimal(38,0)").alias("total")
            )
            tree = tree.unionByName(level.withColumn("level", F.lit(number)))
        return tree.select(*[F.col(c.split()[0]).cast(c.split(" ")[1]).alias(c.split()[0]) for c in TREE.split(", ")])

    def _meta(self):
        return self.spark.read.schema(META).json(f"{self.path}/columns").first()

    def _width(self) -> int:
        return self._meta().width or 1

    def _stored(self) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self._meta().columns)).add(PART, T.LongType())
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def tree(self) -> DataFrame:
        return self.spark.read.schema(TREE).parquet(f"{self.path}/tree")

    def rows(self, ranges: DataFrame | None = None) -> DataFrame:
        """All rows, or those of ``ranges`` (node): folders that hold none of them are not read."""
        whole = self._stored()
        if ranges is None:
            return whole.drop(PART)
        width, columns = self._width(), whole.columns[:-1]
        folders = ranges.select(self._folder(F.col("node"), width).alias(PART)).distinct()
        whole = lookup_join(whole, folders, [PART], "left_semi").select(*columns)
        if width > 1:
            whole = lookup_join(whole.withColumn(PART, self._range()), ranges.select(F.col("node").alias(PART)), [PART], "left_semi")
        return whole.select(*columns)


def differing_ranges(left: RangedTable, right: RangedTable) -> DataFrame:
    """(node) of the ranges whose content differs, found from the roots down: only children of unequal nodes are looked at."""
    if (left.key, left.span, left.fanout) != (right.key, right.span, right.fanout):
        raise ValueError("the tables are stored by different ranges")
    a, b = left.tree(), right.tree()
    heights = [t.agg(F.max("level")).first()[0] or 0 for t in (a, b)]

    def at(tree: DataFrame, level: int, side: str, parents: DataFrame | None) -> DataFrame:
        nodes = tree.where(F.col("level") == level).select("node", F.struct("rows", "mix", "total").alias(side))
        if parents is None:
            return nodes
        up = nodes.withColumn("parent", _floor_div(F.col("node"), left.fanout))
        return up.join(parents.withColumnRenamed("node", "parent"), "parent", "left_semi").drop("parent")

    unequal = None
    # Above the lower tree's top nothing is ruled out.
    for level in range(min(heights), -1, -1):
        both = at(a, level, "l", unequal).join(at(b, level, "r", unequal), "node", "full_outer")
        unequal = materialize(both.where(~F.col("l").eqNullSafe(F.col("r"))).select("node"), "unequal-nodes")
    return unequal


def tree_difference(left: RangedTable, right: RangedTable) -> DataFrame:
    """``keyed_difference`` of two stored tables with unique keys, reading only the ranges that differ."""
    ranges = differing_ranges(left, right)
    return keyed_difference(left.rows(ranges), right.rows(ranges), [left.key])
