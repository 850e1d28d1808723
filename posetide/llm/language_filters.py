"""Language identification with bitmask n-gram filters.

For every learned language the n-grams of letters that hold a least share of
its n-grams are put into a Bloom filter, for each of a few shares (``BANDS``) one
filter. All filters have the same size and hash functions and are kept as
slices of one table: a slot holds one bit a filter. So one look-up of an n-gram
(the AND of its slots) gives all languages that contain it as a bitmask. The
popcounts of a text's masks, a language at a time, are corrected for the share
of false positives that the fill of each slice predicts; the greatest sum
decides.

An n-gram needs a share of ``BANDS[0]`` of those of its length, so a language
has ``1 / BANDS[0]`` n-grams of a length at most: the table that is sent to the
workers is bounded by the number of languages (``MOST_LANGUAGES``), not by the
corpus. What is counted to choose them covers all labelled rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, mix, stored

#: Lengths of n-grams, in letters; a run of other characters counts as one blank.
SIZES = (2, 3, 4)
#: Least shares of a language's n-grams of one length, one filter each.
BANDS = (2.0 ** -16, 2.0 ** -13, 2.0 ** -10)
HASHES_A_GRAM = 2
#: Slots for each n-gram of the fullest filter.
ROOM = 8
MOST_LANGUAGES = 256
#: Letters of a text handled at once; an n-gram counts once a part in learning.
PART = 1 << 16
#: N-grams held by a task before they are counted.
HELD = 4_000_000
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, 0 for what is no letter."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for c in map(chr, range(0x110000)):
            if c.isalpha():
                table[ord(c)] = ord(c.lower()[0])
        _letters = table
    return _letters


def letters(text: str | None) -> np.ndarray:
    """A text's letters, a 0 between words and at both ends; empty without letters."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.zeros(len(codes) + 2, np.uint64)
    low[1:-1] = letter_table()[codes]
    low = low[1:][(low[1:] != 0) | (low[:-1] != 0)]
    return np.concatenate([np.zeros(1, U64), low]) if len(low) else low


def grams(x: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-grams of letters and blanks."""
    if len(x) < size:
        return x[:0]
    n = len(x) - size + 1
    key = x[:n] + U64(size << 40)
    for k in range(1, size):
        key = key * U64(0x9E3779B97F4A7C15) + x[k:k + n]
    return mix(key)


def parts(x: np.ndarray):
    """Cut letters into parts that share no n-gram and miss none."""
    for at in range(0, len(x), PART):
        yield x[at:at + PART + max(SIZES) - 1], PART


def part_grams(x: np.ndarray, size: int) -> np.ndarray:
    return grams(x[:PART + size - 1], size)


class Filters:
    """Bit-sliced Bloom filters over ``slices`` (language, band) pairs."""

    def __init__(self, languages: list[str], slots: int):
        self.languages = languages
        width = len(languages) * len(BANDS)
        self.kind = np.uint8 if width <= 8 else np.uint16 if width <= 16 else np.uint32 if width <= 32 else U64
        bits = np.dtype(self.kind).itemsize * 8
        self.table = np.zeros((-(-width // bits), slots), self.kind)
        self.bits = [(s // bits, self.kind(1 << (s % bits))) for s in range(width)]
        self.false = np.zeros(width)

    def slots(self, gram: np.ndarray):
        """The places of n-grams, an array a hash function."""
        last = U64(self.table.shape[1] - 1)
        yield gram & last
        for k in range(1, HASHES_A_GRAM):
            yield (gram >> U64(32 // k)) & last if k == 1 else mix(gram + U64(k)) & last

    def add(self, slice_: int, gram: np.ndarray) -> None:
        row, bit = self.bits[slice_]
        for at in self.slots(gram):
            self.table[row, at] |= bit

    def close(self) -> None:
        """Note the share of false positives that each slice's fill predicts."""
        fill = [np.count_nonzero(self.table[row] & bit) / self.table.shape[1] for row, bit in self.bits]
        self.false = np.array(fill) ** HASHES_A_GRAM

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """Bitmasks of the filters that contain each n-gram (rows: words of the mask)."""
        found = None
        for at in self.slots(gram):
            found = self.table[:, at] if found is None else found & self.table[:, at]
        return found

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, int]:
        """Corrected sums of hits by language, and the number of n-grams."""
        hits, n = np.zeros(len(self.bits)), 0
        for part, _ in parts(x):
            gram = np.concatenate([part_grams(part, size) for size in SIZES])
            if not len(gram):
                continue
            found = self.masks(gram)
            hits += [np.count_nonzero(found[row] & bit) for row, bit in self.bits]
            n += len(gram)
        real = np.clip((hits - n * self.false) / (1 - self.false), 0, None)
        return real.reshape(len(self.languages), len(BANDS)).sum(axis=1), n


def _counted(batches):
    """(lang, size, gram, holders): a language's n-grams, once a part of a text."""
    held: dict[tuple[str, int], list[np.ndarray]] = {}
    n = 0

    def flush():
        for (lang, size), arrays in held.items():
            gram, count = np.unique(np.concatenate(arrays), return_counts=True)
            for at in range(0, len(gram), 200_000):
                part = gram[at:at + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(np.full(len(part), size), pa.int32()),
                     pa.array(part.view(np.int64)), pa.array(count[at:at + 200_000])],
                    names=["lang", "size", "gram", "holders"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part, _ in parts(letters(text.as_py())):
                for size in SIZES:
                    gram = np.unique(part_grams(part, size))
                    held.setdefault((lang, size), []).append(gram)
                    n += len(gram)
            if n > HELD:
                yield from flush()
                n = 0
    yield from flush()


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text") -> tuple[Filters, int] | None:
    """(filters, place of the commonest language) from labelled texts; None
    without a label. Rows without a label or text are left out."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if not known:
        return None
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in known)
    counts = stored(rows.mapInArrow(_counted, "lang string, size int, gram long, holders long")
                    .groupBy("lang", "size", "gram").agg(F.sum("holders").alias("holders")), "language-grams")
    totals = counts.groupBy("lang", "size").agg(F.sum("holders").alias("total"))    # a row a language and size
    share = F.col("holders") / F.col("total")
    kept = (counts.join(F.broadcast(totals), ["lang", "size"]).where(share >= BANDS[0])
            .select("lang", "gram", sum((share >= b).cast("int") for b in BANDS).alias("bands")).toArrow())
    place = {name: i for i, name in enumerate(languages)}
    of = np.array([place[x] for x in kept.column("lang").to_pylist()], np.int64)
    gram = kept.column("gram").to_numpy().view(U64)
    bands = kept.column("bands").to_numpy()
    fullest = max(1, int(np.bincount(of, minlength=1).max())) if len(of) else 1
    filters = Filters(languages, 1 << (ROOM * fullest - 1).bit_length())
    for i in range(len(languages)):
        for b in range(len(BANDS)):
            filters.add(i * len(BANDS) + b, gram[(of == i) & (bands > b)])
    filters.close()
    return filters, place[known[0]["lang"]]


def predict(docs: DataFrame, model: tuple[Filters, int] | None, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred`` and ``score`` (the share of the
    chosen language in the corrected hits of all).

    A null text or one without a letter is ``und`` with score 0, and so is every
    text if nothing was learned. A text of which no n-gram is known gets the
    commonest language with score 0. Ties go to the first name. Texts are read
    whole, in parts; equal texts have equal results; no rows give none. The two
    added columns take the place of columns of their names."""
    added = ("lang_pred", "score")
    keep = [(c, t) for c, t in docs.dtypes if c != text and c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)    # bounded, see above

    def run(batches):
        for batch in batches:
            names, scores = [], []
            for value in batch.column(len(keep)):
                x = letters(value.as_py())
                if not len(x) or shared.value is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                filters, common = shared.value
                sums, _ = filters.scores(x)
                total = float(sums.sum())
                best = int(sums.argmax()) if total > 0 else common
                names.append(filters.languages[best])
                scores.append(float(sums[best]) / total if total > 0 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*(c for c, _ in keep), *added])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in keep), "lang_pred string, score double"])
    return docs.select(*(f"`{c}`" for c, _ in keep), f"`{text}`").mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1):
    """Whether a document's id falls into the fold that is not learned from;
    false for a null id (which is not learned from either)."""
    part = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(part == fold, F.lit(False))


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the
    labelled documents of the other folds."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = learn(rows.where(F.col("doc_id").isNotNull() & ~held_out()))
    return predict(rows.select("doc_id", held_out().alias("held_out"), "text"), model)
