"""Full runs that can be stopped anywhere and run again.

Layout under ``base``: ``staging/<request>/part=i`` (typed staging by key range),
``checkpoints/<request>/part=i`` (the range's rows and fingerprint when it was staged),
``runs/<job>/<table>`` (the outputs), ``published/<job>`` (written last, in one commit: a run
without it did not happen), ``versions`` (append-only registration).

A request is a source, a scope and the recipes; a job is a request over one state of the
source. The state is a fingerprint of every key range, payloads included, taken in one scan. Ranges are
staged together in one partitioned write, and only those whose fingerprint changed or whose
staged rows are not all there.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawstar import layout
from rawstar.operators import manifest, scope, versions
from rawstar.operators.rules import Reference, RowTest, Rule, Unique, not_null, violations
from rawstar.plans import expand, staging
from rawstar.session import materialize
from rawstar.sources.snapshots import path_exists

CHECKPOINT_SCHEMA = "part int, lo bigint, hi bigint, rows bigint, mark string"
# Raise it when a recipe changes what it computes: finished jobs are then run again.
RECIPE_VERSION = 2
VERSION_SCHEMA = "job_id string, table_name string, version_code string, row_count bigint, manifest string"
# Ranges staged by one write; a run that is stopped loses no more than these.
WAVE = 64


def job_id(source: str, labels: list[str], recipes: list[str], state: str = "") -> str:
    """Same source, scope, recipes and source state give the same job."""
    request = {"source": source, "raw_schemas": labels, "recipes": recipes, "version": RECIPE_VERSION, "state": state}
    return hashlib.sha256(json.dumps(request, sort_keys=True).encode()).hexdigest()


@dataclass(frozen=True)
class Ranges:
    """Key ranges of ``width`` ids; number 0 begins at ``base``."""

    base: int
    width: int

    def number(self, key: Column) -> Column:
        offset = key - self.base
        return F.call_function("div", offset - F.pmod(offset, F.lit(self.width)), F.lit(self.width)).cast("int")

    def ends(self, part: int) -> tuple[int, int]:
        return self.base + part * self.width, self.base + (part + 1) * self.width - 1


def fingerprints(raw_table: DataFrame, ranges: Ranges) -> DataFrame:
    """(part, rows, mark) of each key range: everything a recipe can read decides the mark."""
    row = F.xxhash64("raw_id", "raw_schema", "raw_hash", "raw_tab", "raw")
    # Copies of a row cancel out in the xor; the sum of their low bits counts them.
    return raw_table.groupBy(ranges.number(F.col("raw_id")).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(":", F.bit_xor(row).cast("string"), F.sum(row.bitwiseAND(F.lit(0x7FFFFFFF))).cast("string")).alias("mark"),
    )


def resume_plan(checkpoints: DataFrame, stored: DataFrame) -> DataFrame:
    """(part, lo, hi, rows, found, reuse): a part is reused if it has the rows it must have."""
    return (
        checkpoints.join(stored.select("part", F.col("rows").alias("found")), "part", "left")
        .withColumn("reuse", F.coalesce(F.col("rows") == F.col("found"), F.lit(False)))
        .select("part", "lo", "hi", "rows", "found", "reuse")
    )


def delta_plan(now: DataFrame, checkpoints: DataFrame, stored: DataFrame) -> DataFrame:
    """(part, rows, mark, found, reuse): a part is reused if it was staged from what the source holds now, and is whole."""
    seen = checkpoints.select("part", F.col("rows").alias("_rows"), F.col("mark").alias("_mark"))
    same = (F.col("rows") == F.col("_rows")) & (F.col("mark") == F.col("_mark")) & (F.col("rows") == F.col("found"))
    return (
        now.join(seen, "part", "left")
        .join(stored.select("part", F.col("rows").alias("found")), "part", "left")
        .select("part", "rows", "mark", "found", F.coalesce(same, F.lit(False)).alias("reuse"))
    )


@dataclass
class Survey:
    """The source as one run sees it: its ranges, and (part, rows, mark, found, reuse) of each, a bounded list."""

    ranges: Ranges | None
    parts: list = field(default_factory=list)

    @property
    def state(self) -> str:
        marks = sorted((p.part, p.rows, p.mark) for p in self.parts)
        base = (self.ranges.base, self.ranges.width) if self.ranges else ()
        return hashlib.sha256(json.dumps([base, marks]).encode()).hexdigest()


@dataclass
class Run:
    """One expansion request and where its files are."""

    spark: SparkSession
    base: str
    source: str
    labels: list[str]
    parts: int = 8
    state: str = ""
    wave: int = WAVE

    @property
    def request(self) -> str:
        return job_id(self.source, self.labels, expand.RUN_ORDER)

    @property
    def latest(self) -> str:
        """Where the job of this request that was published last is named."""
        return f"{self.base.rstrip('/')}/latest/{self.request}"

    @property
    def job(self) -> str:
        """By the source state seen in this run; before one is seen, the job published last."""
        if not self.state and self._done(self.latest):
            return self.spark.read.schema("job_id string").json(self.latest).first()[0]
        return job_id(self.source, self.labels, expand.RUN_ORDER, self.state)

    def path(self, kind: str, *rest: str) -> str:
        return "/".join([self.base.rstrip("/"), kind, self.job, *rest])

    def _by_request(self, kind: str) -> str:
        return f"{self.base.rstrip('/')}/{kind}/{self.request}"

    def _done(self, path: str) -> bool:
        return path_exists(self.spark, f"{path}/_SUCCESS")

    # ---- staging ----

    def _checkpoints(self) -> DataFrame:
        path = self._by_request("checkpoints")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], CHECKPOINT_SCHEMA)
        return self.spark.read.schema(CHECKPOINT_SCHEMA).json(path)

    def _staged(self, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self._by_request("staging"))

    def _stored(self) -> DataFrame:
        """Rows of each staged part, from file footers."""
        if not path_exists(self.spark, self._by_request("staging")):
            return self.spark.createDataFrame([], "part int, rows bigint")
        return self._staged("raw_id bigint, part int").groupBy("part").agg(F.count(F.lit(1)).alias("rows"))

    def _ranges(self, scoped: DataFrame) -> Ranges | None:
        """The ranges of the first run; a source that grows gets further ones."""
        first = self._checkpoints().limit(1).collect()
        if first:
            width = first[0].hi - first[0].lo + 1
            return Ranges(first[0].lo - first[0].part * width, width)
        ends = scoped.agg(F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi")).first()
        if ends.lo is None:
            return None
        return Ranges(ends.lo, -(-(ends.hi - ends.lo + 1) // self.parts))

    def survey(self, raw_table: DataFrame) -> Survey:
        """One scan of the scoped source; sets the state and with it the job."""
        scoped = scope.in_scope(raw_table, self.labels)
        ranges = self._ranges(scoped)
        plan = []
        if ranges:
            # One row for each key range.
            plan = delta_plan(fingerprints(scoped, ranges), self._checkpoints(), self._stored()).collect()
        found = Survey(ranges, sorted(plan, key=lambda p: p.part))
        self.state = found.state
        return found

    def stage(self, raw_table: DataFrame, stop_after: int | None = None, survey: Survey | None = None) -> DataFrame:
        """The staging table of all ranges; whole ranges of an unchanged source are kept, others written again.

        Raw ids follow ingest order, so a range filter skips the row groups of
        other ranges. ``stop_after`` ends early after that many waves (for tests).
        """
        scoped = scope.in_scope(raw_table, self.labels)
        seen = survey or self.survey(raw_table)
        if not seen.parts:
            return staging.stage(scoped)
        stale = [p for p in seen.parts if not p.reuse]
        for done, a in enumerate(range(0, len(stale), self.wave)):
            if stop_after is not None and done >= stop_after:
                raise InterruptedError("stopped before all parts were staged")
            self._stage_parts(scoped, seen.ranges, stale[a : a + self.wave])
        schema = staging.stage(scoped).schema.add("part", T.IntegerType())
        gone = self._checkpoints().join(
            self.spark.createDataFrame([(p.part,) for p in seen.parts], "part int"), "part", "left_anti"
        )
        # Ranges the source no longer has: normally none.
        left = [r.part for r in gone.select("part").collect()]
        whole = self._staged(schema)
        return (whole.where(~F.col("part").isin(left)) if left else whole).drop("part")

    def _stage_parts(self, scoped: DataFrame, ranges: Ranges, parts: list) -> None:
        """Stage some ranges in one write, check their rows, and note their fingerprints."""
        spans: list[list[int]] = []
        for p in parts:
            lo, hi = ranges.ends(p.part)
            if spans and spans[-1][1] + 1 == lo:
                spans[-1][1] = hi
            else:
                spans.append([lo, hi])
        inside = F.lit(False)
        for lo, hi in spans:
            inside = inside | F.col("raw_id").between(lo, hi)
        rows = staging.stage(scoped.where(inside)).withColumn("part", ranges.number(F.col("raw_id")))
        self._replace_parts(rows).parquet(self._by_request("staging"))
        numbers = [p.part for p in parts]
        found = {r.part: r.rows for r in self._stored().where(F.col("part").isin(numbers)).collect()}
        short = [p.part for p in parts if found.get(p.part) != p.rows]
        if short:
            raise ValueError(f"the source changed while these ranges were staged: {short}")
        noted = [(p.part, *ranges.ends(p.part), p.rows, p.mark) for p in parts]
        checkpoints = self.spark.createDataFrame(noted, CHECKPOINT_SCHEMA).coalesce(1)
        self._replace_parts(checkpoints).json(self._by_request("checkpoints"))

    @staticmethod
    def _replace_parts(rows: DataFrame):
        """Only the partitions that ``rows`` has are replaced."""
        return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part")

    # ---- outputs ----

    def tables(self) -> dict[str, DataFrame]:
        """The published outputs of this job."""
        if not self._done(self.path("published")):
            raise ValueError("this job is not published")
        return self._outputs()

    def _outputs(self) -> dict[str, DataFrame]:
        return {
            name: self.spark.read.schema(layout.DESTINATION_COLUMNS[name]).parquet(self.path("runs", name))
            for name in expand.RUN_ORDER
        }

    def write(self, raw_table: DataFrame) -> None:
        """Stage, write, check, publish. Does nothing for a job that is published."""
        survey = self.survey(raw_table)
        if self._done(self.path("published")):
            return
        source = self.stage(raw_table, survey=survey)
        groups = materialize(manifest.manifest_groups(source), "manifest")
        manifest.require_scopes(groups, self.labels)
        expand.write_star(lambda _: source, lambda name: self.path("runs", name))
        outputs = self._outputs()
        problems = star_problems(outputs).where("violations > 0").collect()
        if problems:
            raise ValueError("; ".join(f"{p.rule}: {p.violations}" for p in problems))
        self._publish(groups, outputs)

    def _publish(self, groups: DataFrame, outputs: dict[str, DataFrame]) -> None:
        """One row per destination with its row count and the manifest totals, in one commit."""
        totals = manifest.manifest_totals(groups)
        rows = manifest.row_counters(outputs).withColumn(
            "manifest", F.to_json(totals.select(F.struct("*")).scalar())
        )
        rows.withColumn("job_id", F.lit(self.job)).coalesce(1).write.mode("overwrite").json(self.path("published"))
        named = self.spark.createDataFrame([(self.job,)], "job_id string")
        named.coalesce(1).write.mode("overwrite").json(self.latest)

    # ---- registration ----

    def _versions(self) -> DataFrame:
        path = f"{self.base.rstrip('/')}/versions"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], VERSION_SCHEMA)
        return self.spark.read.schema(VERSION_SCHEMA).parquet(path)

    def register(self) -> int:
        """One version per destination of a published job, once; returns how many were added."""
        published = self.spark.read.schema("job_id string, table_name string, row_count bigint, manifest string").json(
            self.path("published")
        )
        known = self._versions()
        codes = versions.next_versions(known, published).withColumnRenamed("next_code", "version_code")
        fresh = versions.register_once(known, published).join(codes, "table_name")
        # A handful of rows, one per destination.
        rows = [tuple(r) for r in fresh.select("job_id", "table_name", "version_code", "row_count", "manifest").collect()]
        if rows:
            self.spark.createDataFrame(rows, VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(
                f"{self.base.rstrip('/')}/versions"
            )
        return len(rows)

    def execute(self, raw_table: DataFrame) -> int:
        self.write(raw_table)
        return self.register()


def _star_rules() -> list[Rule]:
    rules: list[Rule] = []
    for name in expand.RUN_ORDER:
        rules += [
            Unique(f"{name} primary key", name, ("id_column_1",)),
            not_null(f"{name} primary key set", name, "id_column_1"),
        ]
    kinds = ", ".join(f"'{k}'" for k in layout.KIND_TOKENS)
    rules += [
        Unique("table1 source row unique", "table1", ("id_column_3",)),
        not_null("table1 source row set", "table1", "id_column_3"),
        Reference("table1 reference", "table1", ("id_column_4",), "table3", ("id_column_1",)),
        Unique("table2 position unique", "table2", ("id_column_2", "integer_column_1")),
        not_null("table2 set", "table2", "id_column_2", "integer_column_1"),
        RowTest("table2 kind", "table2", f"text_column_1 IS NULL OR text_column_1 IN ({kinds})"),
        Unique("table5 one per fact", "table5", ("id_column_2",), "id_column_3 IS NULL"),
        Unique("table5 other id", "table5", ("id_column_3",), "id_column_3 IS NOT NULL"),
        Unique("table6 pair unique", "table6", ("id_column_2", "id_column_3")),
        Reference("table6 code", "table6", ("id_column_3",), "table4", ("id_column_1",)),
    ]
    for name in ("table2", "table5", "table6"):
        rules += [
            Reference(f"{name} fact", name, ("id_column_2",), "table1", ("id_column_1",)),
            not_null(f"{name} fact set", name, "id_column_2"),
        ]
    return rules


STAR_RULES = _star_rules()


def star_problems(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations) of every key, reference and check of the six tables."""
    return violations(tables, STAR_RULES)
