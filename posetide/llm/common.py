"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from posetide.session import ensure_checkpoint_dir

U64 = np.uint64
#: Bytes of words (and what a table of them takes besides) that one worker's
#: cache holds before it is emptied, and the longest word that is kept.
CACHE_BYTES, WORD_COST, LONGEST_KEPT = 48_000_000, 150, 200


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The folder is the session's ``spark.checkpoint.dir``, which driver and
    executors share, so the table outlives any executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that no later plan
    reads; the session's shared folder is the only place this touches."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tables/" in f and root.split(":", 1)[-1].strip("/") in f:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], out: str,
                 rows_per_task: int = 200_000) -> DataFrame:
    """Add ``out``: 0, 1, 2 ... without gaps within each ``keys`` group.

    A group may hold any share of all rows: it is cut into hashed parts of
    about ``rows_per_task`` rows, rows are numbered within a part, and each
    part starts where the parts before it end. ``df`` is read three times, so
    pass a stored table."""
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-largest // rows_per_task))
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    starts = (cut.groupBy(*keys, "_part").count()
              .withColumn("_start", F.sum("count").over(
                  Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
              .select(*keys, "_part", F.coalesce("_start", F.lit(0)).alias("_start")))
    at = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    return (cut.withColumn("_at", at).join(starts, [*keys, "_part"])
            .withColumn(out, (F.col("_start") + F.col("_at") - 1).cast("long"))
            .drop("_part", "_start", "_at"))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on demand; long words and lines are
    hashed without being kept."""

    size = 0

    def __missing__(self, word: bytes) -> int:
        value = xxh3_64_intdigest(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = value
            self.size += len(word) + WORD_COST
        return value

    def clear(self) -> None:
        super().clear()
        self.size = 0

    def bound(self) -> None:
        if self.size > CACHE_BYTES:
            self.clear()

    def of(self, words: list[bytes]) -> np.ndarray:
        self.bound()
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


#: One cache a worker, for all operators that run in it.
HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hash of every run of ``n`` consecutive values."""
    if len(h) < n:
        return h[:0]
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = mix(out + U64(0x9E3779B97F4A7C15)) ^ h[k: len(h) - n + 1 + k]
    return mix(out)


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
