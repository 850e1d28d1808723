"""Session helpers: local test sessions and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "posetide") -> SparkSession:
    """Session for tests and the bench. On a cluster, pass the cluster's own
    session to the operators instead; nothing here is required there."""
    master = master or os.environ.get("POSETIDE_MASTER", "local[8]")
    b = SparkSession.builder
    if os.environ.get("POSETIDE_JIT_HUGE", "0") == "1":
        # let the JVM JIT very wide generated methods (unrolled joint arithmetic)
        b = (b.config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
              .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods"))
    spark = (
        b.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    tune_session(spark)
    return spark


def tune_session(spark: SparkSession) -> None:
    """Session settings the operators rely on for speed, applied only where
    the user left Spark's default. Whole-stage methods above HotSpot's JIT
    limit (8000 bytes of bytecode) would run interpreted; with the limit set
    to 8000 Spark falls back to split, JIT-compiled per-operator code for
    such stages (the setting Spark documents for HotSpot)."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that wins.
    Only when it is unset (local tests) do we pick a scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a "
                "shared folder to cut lineage on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="posetide-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor
    loss; never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
