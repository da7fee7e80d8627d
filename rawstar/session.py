"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}

# Wide projections compile into small methods that the JIT accepts.
SMALL_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(app_name: str = "rawstar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes.

    ANSI casts raise on bad text, timestamps are read in UTC, and the adaptive
    planner may split skewed partitions even if that costs one more shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **SMALL_METHODS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compile_small(spark: SparkSession) -> None:
    """What the wide projections need in a session that ``build_session`` did not make."""
    for key, value in SMALL_METHODS.items():
        spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own, since
    no other machine has to read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="rawstar-")
    return _LOCAL_DIRS[app]


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/rawstar/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str = "step") -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The written table survives lost executors, keeps column pruning, and gives
    the planner true file sizes, so later joins pick broadcast only when small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
