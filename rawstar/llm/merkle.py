"""Merkle manifest of a dataset: one tree for each source, and one over the sources' roots.

A row's leaf is the SHA-256 of its five fields, each ``-`` if null, else its UTF-8 byte count,
``:`` and its value. Leaves of a source ascend by doc_id. Every ``fanout`` consecutive nodes
become the SHA-256 of their concatenated hex digests, until one is left, the subroot;
subroots, ascending by source (null first), likewise give the root.

Each level is one equijoin of the nodes with themselves: a node of slot zero computes the
index of every sibling in its run (XOR in a binary tree, slot offsets otherwise), looks the
siblings up and emits the parent, with the children's digests beside it. Proofs go down from
the root: a node's siblings are its run without itself, then what its parent's proof holds.
Positions come from a range partitioning, and joins go by (tree, run), so a source of any
size is spread; no level, source or proof passes through one task or the driver.

Null ids come before all others and are never presented changed; rows of one id follow
their leaf; a row listed twice is two leaves. A null, empty or long text is a value like any
other. An empty table gives no rows. Columns other than the five are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.operators.numbering import dense_ids, group_positions
from rawstar.operators.skew import lookup_join
from rawstar.session import materialize

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Characters of a digest as hex text.
HEX = 64
PATH = "array<struct<slot:int,siblings:string>>"


def leaf_digest(*fields: Column) -> Column:
    def counted(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[counted(f) for f in fields]), 256)


@dataclass(frozen=True)
class Forest:
    """``leaves``: tree, idx, n (of the tree), digest. ``runs[k]``: the parents k+1 levels above
    the leaves, tree, idx, n, digest, children. ``tops``: tree, height, digest."""

    leaves: DataFrame
    runs: list[DataFrame]
    tops: DataFrame
    fanout: int


@dataclass(frozen=True)
class Manifest:
    """``sources`` has one tree for each source, ``whole`` one tree over their roots."""

    sources: Forest
    whole: Forest

    def subroots(self) -> DataFrame:
        """source, subroot."""
        return self.sources.tops.select(_source_of(F.col("tree")).alias("source"), F.col("digest").alias("subroot"))

    def root(self) -> DataFrame:
        return self.whole.tops.select(F.col("digest").alias("root"))


def _tree_of(source: Column) -> Column:
    """Null before all others, the rest in the order of their bytes; never null."""
    return F.coalesce(F.concat(F.lit("1"), source), F.lit("0"))


def _source_of(tree: Column) -> Column:
    return F.when(tree != "0", tree.substr(F.lit(2), F.length(tree)))


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    first, slot = F.col("idx"), F.col("slot")
    sibling = first.bitwiseXOR(slot) if fanout == 2 else first + slot
    asked = (
        nodes.where(first % fanout == 0)
        .select("tree", "idx", "n", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("slot"))
        .select("tree", "n", F.col("idx").alias("first"), "slot", sibling.alias("idx"))
        .where(F.col("idx") < F.col("n"))
    )
    found = asked.join(nodes.select("tree", "idx", "digest"), ["tree", "idx"])
    # A run holds ``fanout`` nodes at most.
    runs = found.groupBy("tree", "first").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("slot", "digest"))).alias("run")
    )
    return runs.select(
        "tree",
        F.expr(f"first div {fanout}").alias("idx"),
        F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
        F.array_join(F.transform("run", lambda x: x["digest"]), "").alias("children"),
    ).withColumn("digest", F.sha2("children", 256))


def grow(leaves: DataFrame, fanout: int = FANOUT) -> Forest:
    """Trees over ``leaves``: tree, idx (from 0, gapless), n, digest; stored."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    level, runs = leaves, []
    tops = level.where("n = 1").select("tree", F.lit(0).alias("height"), "digest")
    while largest > 1:
        level = materialize(_parents(level.where("n > 1"), fanout), "merkle-level")
        runs.append(level)
        largest = -(-largest // fanout)
        tops = tops.unionByName(level.where("n = 1").select("tree", F.lit(len(runs)).alias("height"), "digest"))
    return Forest(leaves, runs, tops, fanout)


def _step(slot: Column, children: Column) -> Column:
    """One step of a path: the own slot, and the digests of the others from left to right."""
    rest = F.concat(children.substr(F.lit(1), slot * HEX), children.substr(slot * HEX + HEX + 1, F.length(children)))
    return F.array(F.struct(slot.cast("int").alias("slot"), rest.alias("siblings"))).cast(PATH)


def paths(forest: Forest, above: DataFrame) -> DataFrame:
    """The leaves with ``path``, bottom up, and the other columns of ``above``, one row for each
    tree: tree, path (of its top), ..."""
    carried = [c for c in above.columns if c not in ("tree", "path")]
    tops = forest.tops.select("tree", "height").join(above, "tree")
    tops = materialize(tops.withColumn("idx", F.lit(0).cast("long")), "merkle-tops")

    def ending(height: int) -> DataFrame:
        return tops.where(F.col("height") == height).drop("height")

    at = ending(len(forest.runs))
    for height in range(len(forest.runs), 0, -1):
        opened = forest.runs[height - 1].select("tree", "idx", "children").join(at, ["tree", "idx"])
        if height > 1:
            slots = F.sequence(F.lit(0).cast("long"), F.expr(f"length(children) div {HEX} - 1"))
            kids = opened.withColumn("slot", F.explode(slots)).withColumn("path", F.concat(_step(F.col("slot"), F.col("children")), "path"))
            kids = kids.withColumn("idx", F.col("idx") * forest.fanout + F.col("slot")).drop("slot", "children")
            at = kids.unionByName(ending(height - 1))
    # The leaves look up their run, so that a path is sent once for each run and not for each leaf.
    single = ending(0).withColumn("children", F.lit(None).cast("string"))
    runs = opened.unionByName(single) if forest.runs else single
    runs = runs.withColumnRenamed("idx", "run")
    found = forest.leaves.withColumn("run", F.expr(f"idx div {forest.fanout}")).join(runs, ["tree", "run"])
    own = _step(F.col("idx") % forest.fanout, F.col("children"))
    full = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat(own, "path"))
    return found.select(*forest.leaves.columns, full.alias("path"), *carried)


def fold(digest: Column, path: Column) -> Column:
    """The root that ``digest`` gives with the siblings of ``path``."""

    def up(own: Column, step: Column) -> Column:
        before = step["slot"] * HEX
        siblings = step["siblings"]
        run = F.concat(siblings.substr(F.lit(1), before), own, siblings.substr(before + 1, F.length(siblings)))
        return F.sha2(run, 256)

    return F.aggregate(path, digest, up)


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: x["siblings"]), ""), 256)


def manifest(docs: DataFrame, presented: Column | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of ``docs``. ``presented`` is the text shown at a later audit, kept as the
    digest ``claimed`` beside each leaf; by default the text itself."""
    fields = [F.col(c) for c in FIELDS]
    leaf = leaf_digest(*fields)
    claimed = leaf if presented is None else leaf_digest(*fields[:-1], presented)
    rows = docs.select("doc_id", _tree_of(F.col("source")).alias("tree"), leaf.alias("digest"), claimed.alias("claimed"))
    rows = materialize(rows, "merkle-leaves")
    counts = materialize(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    placed = group_positions(rows, ["tree"], ["doc_id", "digest"], "idx").withColumn("idx", F.col("idx") - 1)
    sources = grow(materialize(lookup_join(placed, counts, ["tree"]), "merkle-placed"), fanout)
    tops = materialize(sources.tops.select("tree", "digest"), "merkle-subroots")
    size = tops.agg(F.count(F.lit(1)).alias("n"))
    numbered = dense_ids(tops.withColumnRenamed("tree", "member"), ["member"], "idx", start=0)
    numbered = numbered.withColumn("tree", F.lit("all")).withColumn("n", size.scalar())
    return Manifest(sources, grow(materialize(numbered, "merkle-members"), fanout))


def proofs(made: Manifest) -> DataFrame:
    """Every leaf with doc_id, digest, claimed, subroot, root and its ``path`` to the root."""
    top = made.whole.tops.select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    members = paths(made.whole, top)
    above = members.select(F.col("member").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    return paths(made.sources, above)


def audit(docs: DataFrame, presented: Column) -> DataFrame:
    """Each row's leaf, roots, proof, and what its presented text folds to."""
    found = proofs(manifest(docs, presented))
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered() -> Column:
    """Text as presented: where 5 divides the id's crc32, A-Z are lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(hit, lower).otherwise(F.col("text"))
