"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every layer relies on.  The date of a timestamp (daily marts) depends
# on the session time zone, so it is pinned.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot order's payments are split even where the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods above 8 KB, and the decode projection is one of them as a whole stage; above this size
    # Spark runs the operators one by one, their expressions cut into small methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Parquet codec of topics, layers and staged rows: message texts take half the room they take with snappy.
CODEC = "zstd"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and benchmarks (clusters bring their own session)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        # the decode projection compiles to methods above the JVM's 8 KB JIT
        # limit; let the JIT compile them (set the same on executors of a cluster)
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) is a fresh local folder
    created and registered, so lineage cuts and streaming state always land in
    the folder the cluster configured.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = sc._jsc.sc().getCheckpointDir()
        if existing.isDefined():
            # SparkContext puts a per-application uuid folder under the configured one
            return existing.get()
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # nothing configured in local mode (tests): register a fresh folder; later
        # calls find it through the SparkContext
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
        return sc._jsc.sc().getCheckpointDir().get()
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def shuffles_freed(spark: SparkSession):
    """Each write started inside frees its shuffle files when it ends.

    Else Spark keeps them until the driver's garbage collection finds their plan unused, so the shuffles
    of all steps of a query add up on the executors' disks."""
    return setting(spark, FREE_SHUFFLES, "true")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write the rows under ``path`` once and continue from the written copy."""
    spark = df.sparkSession
    with shuffles_freed(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Free a staged folder of this run that no later step reads."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
