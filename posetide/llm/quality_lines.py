"""Quality rules by cross-document line frequency.

Each line is normalised (words joined by one space, A-Z lower-cased) and
hashed; the number of distinct documents that hold it is counted for each
host. A line above its host's limit is boilerplate and is removed; a document
that loses most of its words that way is depleted and rejected.

Copies of one document are not distinct documents: they are counted by a
hash of the whole text, so a page that was crawled many times does not turn
its own lines into boilerplate. Texts that differ anywhere are distinct, as
the pages of one template are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import U64, HASHES, stored, text_bytes, windows

#: Base rules.
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50  # per cent of the words
SYMBOLS = b"#*$%&|<>"
#: A line is boilerplate in at least this many distinct documents of its host
#: and at least this share of the host's distinct documents, and in any host
#: from ``ENOUGH`` distinct documents on.
MIN_DOCUMENTS = 5
MIN_SHARE = 0.05
ENOUGH = 1000
#: A document that keeps less than this share of its words is depleted.
MIN_LEFT = 0.3

_NOT_CONTINUATION = bytes(range(0x80, 0xC0))

PROFILE = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "_print long, _lines array<struct<line:long,words:int>>")


def line_key(line: bytes) -> bytes:
    """A line as it is compared between documents."""
    return b" ".join(line.split()).lower()


def profile(text: bytes):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    fingerprint, [(line hash, words)]) of one text; each different line once,
    with the words of all its places."""
    words, seen, repeated, lines = [], set(), 0, {}
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        words += own
        if line in seen:
            repeated += 1
        seen.add(line)
        key = b" ".join(own).lower()
        lines[key] = lines.get(key, 0) + len(own)
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0, []
    joined = b"".join(words)
    chars = len(joined.translate(None, _NOT_CONTINUATION))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    h = HASHES.of(words)
    runs = windows(h, 3)
    again = 0
    if len(runs):
        order = np.argsort(runs, kind="stable")
        same = runs[order[1:]] == runs[order[:-1]]
        if same.any():
            hit = np.zeros(len(runs), bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            cover = np.zeros(n, bool)
            for k in range(3):
                cover[k: k + len(runs)] |= hit
            again = int(cover.sum())
    # signed hashes, as Spark's long has no unsigned form
    keys = np.array([HASHES[k] for k in lines], U64).view(np.int64).tolist()
    return n, chars, symbols, repeated, again, xxh3_64_intdigest(text) >> 1, list(zip(keys, lines.values()))


def _profiles(batches):
    for batch in batches:
        rows = [profile(t) for t in text_bytes(batch.column("_text"))]
        HASHES.bound()
        cols = list(zip(*rows)) or [[]] * 7
        counts = np.cumsum([0, *map(len, cols[6])])
        flat = [x for r in cols[6] for x in r]
        lines = pa.ListArray.from_arrays(
            pa.array(counts, pa.int32()),
            pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int64()),
                                        pa.array([x[1] for x in flat], pa.int32())], names=["line", "words"]))
        keep = [c for c in batch.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), *(pa.array(c, pa.int64()) for c in cols[:6]), lines],
            names=[*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_print", "_lines"])


def line_profiles(docs: DataFrame, keep: list[str], text: str, host: str) -> DataFrame:
    """Stored table of the columns ``keep``, a host, a row number and what
    :func:`profile` gives. A null host is one host of its own."""
    kinds = dict(docs.dtypes)
    chosen = docs.select(*keep, F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
                         F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text"))
    ids = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return stored(chosen.mapInArrow(_profiles, f"{ids}, _host string, _row long, {PROFILE}"), "line-profiles")


def boilerplate(profiles: DataFrame, min_documents: int = MIN_DOCUMENTS, min_share: float = MIN_SHARE,
                enough: int = ENOUGH) -> DataFrame:
    """(_host, line) of the lines above their host's limit."""
    hosts = profiles.where("n_words > 0").groupBy("_host").agg(F.count_distinct("_print").alias("documents"))
    lines = (profiles.select("_host", "_print", F.explode("_lines.line").alias("line"))
             .groupBy("_host", "line").agg(F.count_distinct("_print").alias("holders"))
             .where(F.col("holders") >= min_documents))
    return (lines.join(hosts, "_host").where(F.col("holders") >= F.least(F.col("documents") * min_share, F.lit(enough)))
            .select("_host", "line"))


def judged(profiles: DataFrame, limits: DataFrame, min_left: float = MIN_LEFT) -> DataFrame:
    """Profiles with n_removed_words, _removed (line hashes), base_failed and kept."""
    gone = (profiles.select("_row", "_host", F.inline("_lines")).join(limits, ["_host", "line"])
            .groupBy("_row").agg(F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("_removed")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    return (profiles.drop("_lines", "_host", "_print").join(gone, "_row", "left")
            .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words"))))


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """A verdict for each document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_removed_words, base_failed, kept.

    A null or empty text has no words and fails; a null host counts as one
    host. Repeated rows are judged alike and count as one document. Lines that
    tie with a limit are above it. No documents give no rows. Other columns
    are ignored."""
    profiles = line_profiles(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host")),
                             ["doc_id"], "text", "host")
    return judged(profiles, boilerplate(profiles)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
        "base_failed", "kept")


def _without(batches):
    """Texts without the lines whose hashes are listed."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, gone in enumerate(batch.column("_removed").to_pylist()):
            if gone:
                gone = set(gone)
                texts[i] = b"\n".join(
                    x for x in texts[i].encode().split(b"\n")
                    if not x.split() or int(np.int64(U64(HASHES[line_key(x)]))) not in gone).decode()
        HASHES.bound()
        names = [c for c in batch.schema.names if c != "_removed"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)


def clean(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that are kept, without boilerplate lines; same columns
    (``text``, ``host``, ``doc_id`` and ``n_chars`` among them, the last counted
    anew). Empty input gives none; see :func:`quality` for the verdict."""
    key = F.md5(F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.coalesce(F.col(host), F.lit("")), F.coalesce("text", F.lit(""))))
    keyed = docs.withColumn("_key", key)
    profiles = line_profiles(keyed, ["_key"], "text", host)
    # equal rows have equal verdicts, so one a key is enough
    verdicts = (judged(profiles, boilerplate(profiles)).where("kept")
                .groupBy("_key").agg(F.any_value("_removed").alias("_removed")))
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    out = (keyed.join(verdicts, "_key").drop("_key")
           .mapInArrow(_without, schema))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
