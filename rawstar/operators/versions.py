"""Version history, registration, the data dictionary's links, upserts and key chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.operators.checks import unique_violations
from rawstar.operators.skew import lookup_join
from rawstar.session import materialize

# Width of a version code, and the code of a table without versions.
CODE_WIDTH = 4
FIRST_CODE = "0000"


def version_code(number: Column) -> Column:
    """Zero-padded to four digits; longer numbers stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(CODE_WIDTH), F.length(text)), F.lit("0"))


def next_versions(versions: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_name, next_code) of every table: last code + 1, or the first code."""
    last = versions.groupBy("table_name").agg(F.max(F.col("version_code").cast("bigint")).alias("last"))
    return (
        tables.select("table_name")
        .distinct()
        .join(last, "table_name", "left")
        .select("table_name", F.coalesce(version_code(F.col("last") + 1), F.lit(FIRST_CODE)).alias("next_code"))
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """The newest version row of each table; picked map-side, no window."""
    others = [c for c in versions.columns if c != "table_name"]
    newest = F.max_by(F.struct(*others), F.col("version_code").cast("bigint"))
    return versions.groupBy("table_name").agg(newest.alias("_v")).select("table_name", "_v.*")


def history(versions: DataFrame, table_name: str) -> DataFrame:
    """All versions of one table, newest first."""
    return versions.where(F.col("table_name") == table_name).orderBy(F.col("version_code").cast("bigint").desc())


def register_once(versions: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` (job_id, table_name, ...) that are not registered yet, once each."""
    fresh = new.dropDuplicates(["job_id", "table_name"])
    done = versions.select("job_id", "table_name").distinct()
    return fresh.join(done, ["job_id", "table_name"], "left_anti")


def dependency_counts(versions: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(table_name, versions, deps): number of versions, dependencies of the first one."""
    per_table = versions.groupBy("table_name").agg(F.count(F.lit(1)).alias("versions"), F.min("id").alias("first_id"))
    per_version = dependencies.groupBy(F.col("table_version_id").alias("first_id")).agg(F.count(F.lit(1)).alias("deps"))
    return per_table.join(per_version, "first_id", "left").select(
        "table_name", "versions", F.coalesce("deps", F.lit(0)).alias("deps")
    )


def usage_counts(dictionary: DataFrame, usage: DataFrame) -> DataFrame:
    """(standard_name, usage_count) of every dictionary entry, unused ones too."""
    used = usage.groupBy("standard_name").agg(F.count(F.lit(1)).alias("n"))
    return dictionary.select("standard_name").join(used, "standard_name", "left").select(
        "standard_name", F.coalesce("n", F.lit(0)).alias("usage_count")
    )


def link_orphans(usage: DataFrame, columns: DataFrame) -> DataFrame:
    """Dictionary links whose (table_name, column_name) is gone."""
    return usage.join(columns.select("table_name", "column_name").distinct(), ["table_name", "column_name"], "left_anti")


def unlinked_columns(columns: DataFrame, usage: DataFrame) -> DataFrame:
    """Columns without a dictionary link."""
    return link_orphans(columns, usage)


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """``stored`` with the rows of ``new`` inserted, or replacing the row with their key.

    Of several new rows with one key the greatest ``order`` wins. One shuffle, and
    rows of a key are reduced map-side.
    """
    others = [c for c in stored.columns if c not in keys]
    rank = F.col(order) if order else F.lit(0)
    both = stored.select("*", F.struct(F.lit(0).alias("n"), rank.alias("o")).alias("_rank")).unionByName(
        new.select(*stored.columns, F.struct(F.lit(1).alias("n"), rank.alias("o")).alias("_rank"))
    )
    return both.groupBy(*keys).agg(F.max_by(F.struct(*others), "_rank").alias("_v")).select(*keys, "_v.*").select(
        *stored.columns
    )


def _follow(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(child, at) of the children whose chain ends at ``at``, and of those whose chain never ends.

    Pointer jumping: every round doubles the distance followed, so a chain of length n
    takes log2(n) rounds. A child whose end is known leaves the loop: it is stored once,
    and later rounds only look it up. Many nodes may point at one parent; the lookup join
    splits such hot parents off.
    """
    if not unique_violations(edges, ["child"]).isEmpty():
        raise ValueError("a child has more than one parent")
    open_ = materialize(edges.select("child", F.col("parent").alias("at")), "chain")
    ended = None
    for _ in range(max(open_.count(), 1).bit_length() + 1):
        known = open_.select(F.col("child").alias("at"), F.col("at").alias("next"), F.lit(False).alias("ends"))
        if ended is not None:
            known = known.unionByName(ended.select(F.col("child").alias("at"), F.col("at").alias("next"), F.lit(True).alias("ends")))
        met = lookup_join(open_, known, ["at"], "left")
        met = materialize(met.select("child", F.coalesce("next", "at").alias("at"), F.coalesce("ends", F.lit(True)).alias("ends")), "chain")
        new = met.where("ends").drop("ends")
        ended = new if ended is None else ended.unionByName(new)
        open_ = met.where("not ends").drop("ends")
        if open_.isEmpty():
            return ended, None
    return ended, open_


def resolve_chain(edges: DataFrame) -> DataFrame:
    """(child, root): follow child -> parent to the end, for all nodes at once. A cycle never ends and is an error."""
    ended, endless = _follow(edges)
    if endless is not None:
        members = endless.select("at").distinct()
        first = [str(r["at"]) for r in members.orderBy("at").limit(20).collect()]
        raise ValueError(f"the relationships contain a cycle: {members.count()} members, first {', '.join(first)}")
    return ended.select("child", F.col("at").alias("root"))


def cycle_members(edges: DataFrame) -> DataFrame:
    """(member) of every cycle of child -> parent; children that only lead into one are not members.

    A chain followed for more steps than there are edges stands on its cycle, and the
    members of a cycle, all followed equally far, stand on all of its members.
    """
    endless = _follow(edges)[1]
    if endless is None:
        return edges.select(F.col("child").alias("member")).limit(0)
    return endless.select(F.col("at").alias("member")).distinct()


def chain_ends(edges: DataFrame) -> DataFrame:
    """(child, root) of the children whose chain ends; those that lead into a cycle are left out."""
    return _follow(edges)[0].select("child", F.col("at").alias("root"))
