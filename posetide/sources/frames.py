"""Frame sources (A4, A5).

A video enters as a table of frames ``(video_id, frame_idx, ts, path)``.
Frames stored as image files named ``.../<video>/<frame>.<ext>`` are listed
with Spark's ``binaryFile`` source (batch) or the same source as a stream
(``readStream``, new files per trigger); decoding happens later, inside the
scoring stage that needs the pixels. Rotation (D2) is applied there too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FRAME_RE = r"([^/]+)/(\d+)\.[A-Za-z0-9]+$"
FRAME_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _frame_columns(df: DataFrame, fps: float | None) -> DataFrame:
    vid = F.regexp_extract("path", _FRAME_RE, 1)
    idx = F.regexp_extract("path", _FRAME_RE, 2).cast("int")
    ts = (F.timestamp_seconds(idx / F.lit(fps)) if fps else F.col("modificationTime"))
    return df.select(vid.alias("video_id"), idx.alias("frame_idx"), ts.alias("ts"), "path")


def read_frames(spark: SparkSession, path: str, fps: float | None = None, glob: str = "*") -> DataFrame:
    """A4: frame table from image files; event time = frame_idx / fps when
    the rate is known, else the file time."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return _frame_columns(df, fps)


def frame_stream(spark: SparkSession, path: str, fps: float | None = None, glob: str = "*",
                 max_files_per_trigger: int = 1000) -> DataFrame:
    """A5: the same frame table as a stream of newly arriving files."""
    df = (spark.readStream.format("binaryFile").schema(FRAME_FILE_SCHEMA).option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files_per_trigger).load(path))
    return _frame_columns(df, fps)
