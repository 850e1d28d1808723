"""Structured Streaming forms of the stateful operators (H2, H6, H9).

Rows may come in any order and a frame may be split over files. ``transformWithState``
keeps the rows of a video (or series) in a list state until the watermark has
passed their event time; a timer then hands them on in order, so that the
result is that of the batch operator. What comes after the watermark is dropped
by Spark and counted in the query's progress (``numRowsDroppedByWatermark``).

A row without a frame (or, in a series, without a value and with ``close``)
closes a video: its time is taken to be the delay after the last frame, so it
moves the watermark past that frame, and when the frames before it are walked,
nothing is kept of the video. ``idle`` does the same after a stretch of event
time without frames.

Frames with no detection must arrive as a row with null box fields (the
producer's frame marker), exactly as in the batch operator.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from posetide.operators import track as T

TRACK_OUT = T.TRACK_SCHEMA
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keyed_state_store(spark: SparkSession) -> None:
    """List states and timers need the RocksDB state store; set it where the
    user left Spark's default."""
    if not spark.conf.get(PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKS)


def milliseconds(interval: str, spark: SparkSession) -> int:
    """Length of an interval such as ``10 minutes``."""
    end = spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"interval {interval}")))
    return int(end.first()[0])


class InOrder(StatefulProcessor):
    """Rows of a key in the order of their times, once they are complete.

    Held rows are tuples (due, closes, *values): ``due`` is the event time in
    milliseconds from which on a row may be walked. Without a delay the rows of
    a micro-batch count as complete and are walked at once."""

    def __init__(self, columns: list[str], held: str, delay: int | None, idle: int | None):
        self.columns, self.held, self.delay, self.idle = columns, held, delay, idle

    def walk(self, key, rows: list[tuple], state: dict | None) -> tuple[pd.DataFrame, dict]:
        """Output of complete rows (values, in any order) and the state after them."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"due long, closes boolean, {self.held}")
        self.state = handle.getValueState("state", "state string")
        self.alarm = handle.getValueState("alarm", "at long")

    def _ring_at(self, at: int) -> None:
        """One timer a key: the earliest time at which something is due."""
        if self.alarm.exists():
            (old,) = self.alarm.get()
            if old <= at:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due = []
        for pdf in rows:
            closes = pdf["row_closes"].to_numpy(bool)
            # a closing row stands the delay behind the last frame
            at = pdf["row_ms"].to_numpy(np.int64) - np.where(closes, self.delay or 0, 0)
            values = pdf[self.columns].astype(object).where(pdf[self.columns].notna(), None)
            new = list(zip(at.tolist(), closes.tolist(), *(values[c] for c in self.columns)))
            if self.delay is None:
                due += new
            elif new:
                self.waiting.appendList(new)
                due += [(min(at.tolist()),)]
        if self.delay is None:
            yield from self._hand_on(key, due)
        elif due:
            self._ring_at(min(d[0] for d in due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.alarm.exists():
            self.alarm.clear()
        rows = list(self.waiting.get()) if self.waiting.exists() else []
        later = [r for r in rows if r[0] > watermark]
        due = [r for r in rows if r[0] <= watermark]
        if later:
            self.waiting.put(later)
            self._ring_at(min(r[0] for r in later))
        elif rows:
            self.waiting.clear()
        if not rows:    # the timer of an idle key
            self.state.clear()
            return
        yield from self._hand_on(key, due)
        if self.idle and not later and self.state.exists():
            self._ring_at(max(r[0] for r in due) + self.idle)

    def _hand_on(self, key, due: list[tuple]) -> Iterator[pd.DataFrame]:
        rows = [tuple(r[2:]) for r in due if not r[1]]
        if rows:
            state = json.loads(self.state.get()[0]) if self.state.exists() else None
            out, state = self.walk(key, rows, state)
            self.state.update((json.dumps(state),))
            if len(out):
                yield out
        if any(r[1] for r in due) and self.state.exists():
            self.state.clear()

    def close(self) -> None:
        pass


class Tracker(InOrder):
    """H2 on a stream: a video's frames through :class:`posetide.operators.track.SortState`."""

    NAMES = [c.split()[0] for c in T.TRACK_SCHEMA.split(", ")]

    def __init__(self, delay, idle, **options):
        super().__init__(["frame_idx", *T.BOX, "place"], "frame int, x1 double, y1 double, x2 double, y2 double, score double, place double", delay, idle)
        self.options = options

    def walk(self, key, rows, state):
        tracker = T.SortState(**self.options)
        last = -1
        if state:
            tracker.load(state["tracks"])
            last = state["frame"]
        frames: dict[int, list[tuple]] = {}
        for frame, *box in rows:
            # without a delay, a frame of an earlier micro-batch cannot be walked any more
            if frame > last:
                frames.setdefault(frame, []).append(tuple(box))
        parts = []
        for frame in sorted(frames):
            boxes = [b for b in frames[frame] if None not in b[:5]]
            boxes.sort(key=lambda b: (b[5] is not None, b[5] or 0, -b[4], *b[:4]))
            got, scores, ids = tracker.step(np.array([b[:5] for b in boxes], np.float64).reshape(-1, 5))
            if len(ids):
                parts.append(np.column_stack([np.full(len(ids), frame), np.arange(len(ids)), ids, got, scores]))
            last = frame
        out = pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, 8)), columns=self.NAMES[1:])
        out.insert(0, "video_id", key[0])
        out = out.astype({"video_id": "int64", "frame_idx": "int32", "emit_rank": "int32", "track_id": "int64"})
        return out, {"tracks": tracker.dump(), "frame": last}


def _ordered(df: DataFrame, processor: InOrder, keys: list[str], schema: str, ts: str | None, delay: str) -> DataFrame:
    keyed_state_store(df.sparkSession)
    if ts:
        df = df.withWatermark(ts, delay).withColumn("row_ms", F.unix_millis(F.col(ts).cast("timestamp")))
    else:
        df = df.withColumn("row_ms", F.lit(0).cast("long"))
    # pandas rows lose names that begin with an underscore, so none is used here
    chosen = df.select(*keys, "row_ms", "row_closes", *[c for c in processor.columns if c not in keys], *([ts] if ts else []))
    return chosen.groupBy(*keys).transformWithStateInPandas(
        processor, schema, "append", "EventTime" if ts else "None")


def track_stream(dets: DataFrame, max_age: int = 1, min_hits: int = 3, iou_threshold: float = 0.3,
                 order_col: str | None = None, ts: str | None = None, delay: str = "10 seconds",
                 idle: str | None = None) -> DataFrame:
    """H2 streaming: input rows video_id, frame_idx, x1, y1, x2, y2, score (null
    box = frame marker; null frame = the video is closed) and an optional
    detector-order column. Output as the batch ``track_boxes``.

    ``ts`` is the event time, the same for all rows of a frame and rising with
    the frames; rows may come up to ``delay`` late, in any order. Without ``ts`` the
    frames must come in order, each within one micro-batch."""
    spark = dets.sparkSession
    order = F.col(order_col).cast("double") if order_col else F.lit(None).cast("double")
    rows = dets.withColumn("row_closes", F.col("frame_idx").isNull()).withColumn("place", order)
    processor = Tracker(milliseconds(delay, spark) if ts else None, milliseconds(idle, spark) if idle and ts else None,
                        max_age=max_age, min_hits=min_hits, iou_threshold=iou_threshold)
    return _ordered(rows, processor, ["video_id"], TRACK_OUT, ts, delay)


class Smoother(InOrder):
    """H6-H8 on a stream: a series' samples through one filter a value column."""

    def __init__(self, keys, time, values, names, delay, idle, **options):
        samples = [f"sample_{i}" for i in range(len(values))]
        super().__init__(["sample_at", *samples], ", ".join(f"{c} double" for c in ["sample_at", *samples]), delay, idle)
        self.keys, self.time, self.names, self.options = keys, time, names, options
        self.width = len(values)
        self.values = values

    def walk(self, key, rows, state):
        filters = [T.AdaptiveLowPass(**self.options, state=tuple(s)) for s in state["filters"]] if state else [
            T.AdaptiveLowPass(**self.options) for _ in range(self.width)]
        last = state["time"] if state else None
        out = []
        for at, *samples in sorted(rows, key=lambda r: (r[0], [(x is None, x) for x in r[1:]])):
            if self.delay is None and last is not None and at <= last:
                continue
            given = [float("nan") if x is None else x for x in samples]
            out.append((*key, at, *samples, *(f.next(x, at) for f, x in zip(filters, given))))
            last = at
        return pd.DataFrame(out, columns=self.names), {"filters": [f.state for f in filters], "time": last}


def smooth_stream(df: DataFrame, keys: list[str], time: str, value, min_cutoff=1.7, beta=0.3,
                  fps: float = 30.0, gap: str = "reset", ts: str | None = None, delay: str = "10 seconds",
                  idle: str | None = None) -> DataFrame:
    """H6-H8 streaming: One-Euro per series, with the columns of the batch
    ``one_euro`` over keys, time and values (``value``: a column, adding ``smoothed``,
    or a list, adding ``<col>_smooth``); both gap rules. Rows with a null time
    close their series.

    ``ts`` is the event time; rows may come up to ``delay`` late, in any order.
    Without ``ts`` samples must come in order (``gap`` and values as in the batch)."""
    spark = df.sparkSession
    values = [value] if isinstance(value, str) else list(value)
    added = ["smoothed"] if isinstance(value, str) else [f"{v}_smooth" for v in values]
    types = dict(df.dtypes)
    names = [*keys, time, *values, *added]
    processor = Smoother(keys, time, values, names, milliseconds(delay, spark) if ts else None,
                         milliseconds(idle, spark) if idle and ts else None,
                         min_cutoff=min_cutoff, beta=beta, rate=fps, gap=gap)
    rows = (df.withColumn("row_closes", F.col(time).isNull()).withColumn("sample_at", F.col(time).cast("double"))
            .withColumns({f"sample_{i}": F.col(v).cast("double") for i, v in enumerate(values)}))
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), f"{time} double", *(f"{v} double" for v in [*values, *added])])
    out = _ordered(rows, processor, keys, schema, ts, delay)
    return out.withColumns({c: F.col(c).cast(types[c]) for c in [time, *values]})


def summary_stream(poses: DataFrame, ts: str = "ts", video: str = "video_id", frame: str = "frame_idx",
                   window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """H9 streaming: frames and poses per video and tumbling event-time
    window; rows older than the watermark are dropped by Spark."""
    return (poses.withWatermark(ts, watermark)
            .groupBy(video, F.window(ts, window).alias("w"))
            .agg(F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame"),
                 F.count(F.lit(1)).alias("n_poses"))
            .select(video, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "first_frame", "last_frame", "n_poses"))
