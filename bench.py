"""Headline timings. Prints one JSON line.

The raw table is written once before the clock starts, as a run finds it stored.
Every figure is the median of three runs after two warm-up runs; ``first_run`` has
the cold times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rawstar import testbed  # noqa: E402
from rawstar.operators import compare, facets, manifest  # noqa: E402
from rawstar.plans import expand, staging  # noqa: E402
from rawstar.plans.resume import Run  # noqa: E402
from rawstar.session import build_session, scratch_path  # noqa: E402

FACET_SQL = """select o_orderkey as row_key, o_orderstatus, c_mktsegment, o_orderpriority,
  cast(o_totalprice as decimal(18,2)) as price from {orders} left join {customer} on c_custkey = o_custkey"""


def stored_raw(spark, sf_dir):
    path = scratch_path(spark, "bench-raw")
    testbed.raw(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    return spark.read.parquet(path)


def expand_staged(spark, raw, sf_dir):
    """Stage once, then write all six destinations."""
    out = scratch_path(spark, "bench-run")
    staging.stage(raw).write.parquet(f"{out}/staging")
    source = spark.read.parquet(f"{out}/staging")
    expand.write_star(lambda _: source, lambda name: f"{out}/{name}")


def run_execute(spark, raw, sf_dir):
    """The whole job: stage by parts, write, check, publish, register."""
    labels = ["group001", "group002", "group003"]
    Run(spark, scratch_path(spark, "bench-job"), "public.raw_data", labels, parts=4).execute(raw)


def expand_direct(spark, raw, sf_dir):
    """Nothing is staged: every destination parses the headers it reads."""
    out = scratch_path(spark, "bench-run")
    expand.write_star(expand.sources_of(raw), lambda name: f"{out}/{name}")


def stage_only(spark, raw, sf_dir):
    staging.stage(raw).write.parquet(scratch_path(spark, "bench-stage"))


def manifest_groups(spark, raw, sf_dir):
    manifest.manifest_totals(manifest.manifest_groups(raw)).collect()


def facet_counts(spark, raw, sf_dir):
    df = spark.sql(
        FACET_SQL, orders=testbed.table(spark, sf_dir, "orders"), customer=testbed.table(spark, sf_dir, "customer")
    )
    facets.facet_counts(df, ["o_orderstatus", "c_mktsegment", "o_orderpriority", "price"]).write.format("noop").mode(
        "overwrite"
    ).save()


def digest(spark, raw, sf_dir):
    compare.logical_digest(raw, "raw").collect()


WARM_UPS = 2
QUERIES = [expand_staged, run_execute, expand_direct, stage_only, manifest_groups, facet_counts, digest]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rawstar-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = stored_raw(spark, sf_dir)
    rows = raw.count()
    seconds, first = {}, {}
    for query in QUERIES:
        runs = []
        for _ in range(WARM_UPS + 3):
            began = time.perf_counter()
            query(spark, raw, sf_dir)
            runs.append(time.perf_counter() - began)
        first[query.__name__] = round(runs[0], 3)
        seconds[query.__name__] = round(statistics.median(runs[WARM_UPS:]), 3)
    print(
        json.dumps(
            {
                "metric": "cross-table expand with staging, six destinations",
                "value": seconds["expand_staged"],
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "raw_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
