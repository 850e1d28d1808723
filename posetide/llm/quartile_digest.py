"""Document fingerprints: a quartile bucket digest.

Every three consecutive bytes of the UTF-8 text are hashed into one of 256
buckets. The quartiles of the bucket counts turn each bucket into two bits;
the digest also holds the length on a logarithmic scale and how the quartiles
lie to one another. Two digests differ by the steps between their buckets (a
bucket at opposite ends counts double) and between their heads; the score is
bounded, and a likeness from 0 to 1 is what is left of the bound.
"""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
#: Difference of bucket codes -> score.
STEPS = np.array([0, 1, 2, 6])
#: Scores from here on count as unlike; independent codes differ by 416.
BOUND = 400
LENGTH_BASE = 1.1


def digest(text: str) -> np.ndarray:
    """259 small numbers: length, two quartile ratios, a code a bucket."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    out = np.zeros(3 + BUCKETS, np.uint8)
    out[0] = min(255, round(math.log(len(raw) + 1, LENGTH_BASE)))
    if len(raw) < 3:
        # nothing to count: the bytes themselves stand in for the codes
        out[3: 3 + len(raw)] = raw & 3
        out[3 + 8: 3 + 8 + len(raw)] = raw >> 6
        return out
    b = raw.astype(np.uint32)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)
    counts = np.bincount(h >> 24, minlength=BUCKETS)
    ranked = np.sort(counts)
    q1, q2, q3 = (int(ranked[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    out[1], out[2] = (15 * q1 // q3, 15 * q2 // q3) if q3 else (0, 0)
    out[3:] = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    return out


def to_text(d: np.ndarray) -> str:
    """Digest as hexadecimal digits: head, then four buckets a byte."""
    c = d[3:].reshape(-1, 4)
    body = c[:, 0] << 6 | c[:, 1] << 4 | c[:, 2] << 2 | c[:, 3]
    return bytes([d[0], d[1] << 4 | d[2]]).hex() + body.astype(np.uint8).tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    body = np.stack([raw[2:] >> s & 3 for s in (6, 4, 2, 0)], axis=1).ravel()
    return np.concatenate([[raw[0], raw[1] >> 4, raw[1] & 15], body]).astype(np.uint8)


def difference(a: np.ndarray, b: np.ndarray) -> int:
    gap = np.abs(a.astype(np.int16) - b)
    return int(STEPS[gap[3:]].sum()) + min(int(gap[0]), 60) + int(gap[1]) + int(gap[2])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - min(difference(a, b), BOUND) / BOUND


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint of each whole text; null counts as empty, equal
    texts have equal fingerprints, no documents give no rows, other columns are
    ignored."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        for b in batches:
            prints = [to_text(digest(t or "")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, fingerprint string"))


def in_ranges(docs: DataFrame, rows_per_range: int = 200_000) -> DataFrame:
    """(doc_id, text, _range, _ghost): documents dealt by ranges of doc_id, one
    range a partition and sorted, each followed by a ghost of the document that
    comes next: the first of the next range, after the last range the first of
    all. Ties of doc_id go by text; a null doc_id comes first."""
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    docs = docs.select("doc_id", "text", place.alias("_at"))
    n = docs.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_range))
    cuts = docs.approxQuantile("_at", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if n else []
    edges = np.array(sorted(set(cuts)))

    @F.pandas_udf("int")
    def range_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, at.to_numpy(), "left").astype("int32"))

    ranged = docs.withColumn("_range", range_of("_at"))
    # one row a range
    heads = sorted((r["_range"], r["head"]) for r in ranged.groupBy("_range").agg(F.min("_at").alias("head")).collect())
    if not heads:
        return ranged.withColumn("_ghost", F.lit(0)).drop("_at")
    ghosts = spark.createDataFrame([(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)], "_at long, _before int")
    own = F.struct(F.col("_range").alias("r"), F.lit(0).alias("g"))
    both = F.when(F.col("_before").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.col("_before").alias("r"), F.lit(1).alias("g"))))
    return (ranged.join(F.broadcast(ghosts), "_at", "left").withColumn("_to", F.explode(both))
            .select("doc_id", "text", "_at", F.col("_to.r").alias("_range"), F.col("_to.g").alias("_ghost"))
            .repartitionById(max(r for r, _ in heads) + 1, F.col("_range"))
            .sortWithinPartitions("_range", "_ghost", "_at", "text").drop("_at"))


def _edited(batches):
    """Each document against its edited text and the next document."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held = None  # the document that waits for the next one: id array, text, digest
    for batch in batches:
        out = [[] for _ in names]
        ids = []
        texts = batch.column("text").to_pylist()
        ghost = batch.column("_ghost").to_pylist()
        for i, text in enumerate(texts):
            text = text or ""
            own = digest(text)
            if held:
                cut = len(held[1]) // 4
                other = held[1][: len(held[1]) - cut] + text[:cut]
                of_other = digest(other)
                ids.append(held[0])
                for col, v in zip(out[1:], (len(held[1]), sha256(other.encode()).hexdigest(), to_text(held[2]),
                                            to_text(of_other), likeness(held[2], of_other), likeness(held[2], own))):
                    col.append(v)
            held = None if ghost[i] else (batch.column("doc_id")[i], text, own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.as_py() for x in ids], batch.schema.field("doc_id").type),
             *(pa.array(c, t) for c, t in zip(out[1:], (pa.int64(), pa.string(), pa.string(), pa.string(),
                                                       pa.float64(), pa.float64())))], names=names)


def edit_check(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each text and its edited text: the last quarter (rounded
    down, in code points) replaced by the first as many of the next document by
    ascending doc_id (after the last: the first).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited and the next text). Null
    texts are empty. Rows with one doc_id follow one another by text, a null
    doc_id comes first; a document alone is its own next. Other columns are
    ignored; no documents give no rows. A partition is read once, in order,
    holding one text at a time."""
    kind = dict(docs.dtypes)[doc_id]
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return in_ranges(chosen).mapInArrow(
        _edited, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
