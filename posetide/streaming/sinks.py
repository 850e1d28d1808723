"""Stream sinks that hold each micro-batch exactly once.

A stream that restarts hands its last micro-batch on again. Each batch is
written to a folder of its own, ``batch=<id>`` under the target, so a batch
that was cut off is written anew in its place, and one that the target already
holds whole (Spark's committer left its ``_SUCCESS`` there) is not written at
all. The state lies in the target, next to the rows, not in a second store.
Readers see whole batches only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def _folder(spark: SparkSession, path: str):
    """Hadoop's view of a folder: its file system and its path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def is_written(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether the target holds this batch whole."""
    fs, p = _folder(spark, batch_path(path, batch_id) + "/_SUCCESS")
    return fs.exists(p)


def write_batch_once(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                     partition_by: list[str] | None = None) -> bool:
    """Write a micro-batch unless the target holds it; True if it wrote.

    What an attempt that was cut off left behind is replaced. A batch without
    rows leaves an empty folder, so that it is not computed again either."""
    if is_written(df.sparkSession, path, batch_id):
        return False
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(batch_path(path, batch_id))
    return True


def write_once(stream: DataFrame, path: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] | None = None,
               fmt: str = "parquet", partition_by: list[str] | None = None) -> DataStreamWriter:
    """A writer (call ``start()``) that puts each micro-batch into ``path`` once.

    ``shape`` turns the batch's rows into the rows to write, for example
    ``sources.sinks.pose_frames_json``: it sees a plain table, so its grouping
    is within the batch. Event-time operators before it decide which rows
    a batch holds."""
    def each(df: DataFrame, batch_id: int) -> None:
        write_batch_once(df if shape is None else shape(df), path, batch_id, fmt, partition_by)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def written_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches that the target holds whole, in order."""
    fs, p = _folder(spark, path.rstrip("/") + "/batch=*/_SUCCESS")
    found = fs.globStatus(p) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def read_written(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """The rows of all whole batches, with their ``batch`` id. ``schema`` is
    that of the rows written, so that no batch yet is an empty table."""
    done = [batch_path(path, b) for b in written_batches(spark, path)]
    if not done:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
    rows = spark.read.format(fmt).schema(schema + ", batch long").option("basePath", path).load(done)
    return rows
