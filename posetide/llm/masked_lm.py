"""LM scoring by masked pseudo-likelihood.

A small network predicts every token of a text from the two tokens on either
side of it. The summed conditional log-probabilities score the text.

Words are hashed into ``BUCKETS``; their counts over all documents group the
buckets into ``CLASSES`` of about equal mass, the commonest words alone in
theirs. The network sees classes and predicts the class in the middle; the
share of the word's bucket in its class gives the rest of its probability.

Training is data parallel and covers every token: each task starts from the
same weights, walks through its part of the corpus in mini-batches, and returns
its weights times its tokens as whole numbers; Spark sums them, so the mean
does not depend on the order in which tasks end, and a lost task is run again
from the same start. What reaches the driver is one model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, text_bytes

BUCKETS = 1 << 16
CLASSES = 128
HIDDEN = 16
#: Places of the window, from the token that is predicted.
PLACES = (-2, -1, 1, 2)
ROUNDS = 2
BATCH = 2048
RATE = 0.1
#: Logits under this bound in size need no shift before they are raised.
SAFE = 40.0
#: Weights travel as multiples of this.
UNIT = 1.0 / (1 << 24)
SEED = 7
#: Bytes of text that are hashed together (a longer word is taken whole).
BLOCK = 1 << 18
FACTOR = U64(0x9E3779B97F4A7C15)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def text_buckets(raw: bytes) -> np.ndarray:
    """Bucket of each word of a text, in turn: a polynomial of its bytes,
    mixed. Texts are cut between words into blocks, which bounds the memory."""
    out, data, at = [np.zeros(0, np.int64)], np.frombuffer(raw, np.uint8), 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and not BLANK[data[end]]:
            # to the next blank, looking ever further ahead
            ahead = np.flatnonzero(BLANK[data[end: end + BLOCK]])
            end = end + int(ahead[0]) if len(ahead) else min(end + BLOCK, len(data))
        out.append(_hashed(data[at:end]))
        at = end
    return np.concatenate(out)


def buckets(words: list[bytes]) -> np.ndarray:
    return text_buckets(b"\n".join(words))


def _hashed(data: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~BLANK[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = turns[::2], turns[1::2] - turns[::2]
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    letters = data[inside[1:-1].view(bool)].astype(np.uint64) + U64(1)
    first = ends - sizes
    place = np.arange(ends[-1]) - np.repeat(first, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), FACTOR, np.uint64))
    values = np.add.reduceat(letters * powers[place], first)
    return (mix(values) >> U64(64 - 16)).astype(np.int64)


ONES = np.ones(CLASSES, np.float32)


class Network:
    """Class tables a place, one hidden layer, a softmax over classes."""

    def __init__(self, weights: np.ndarray | None = None, unigram: np.ndarray | None = None):
        shapes = [(len(PLACES), CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]
        self.sizes = [int(np.prod(s)) for s in shapes]
        if weights is None:
            r = np.random.default_rng(SEED)
            weights = np.concatenate([r.normal(0, 0.1, self.sizes[0]), np.zeros(HIDDEN), r.normal(0, 0.02, self.sizes[2]),
                                      np.log(unigram)])
        self.flat = np.array(weights, np.float32)
        ends = np.cumsum([0, *self.sizes])
        self.table, self.bias, self.out, self.base = (
            self.flat[a:b].reshape(s) for a, b, s in zip(ends, ends[1:], shapes))
        self.last = self.flat[ends[2]:].reshape(HIDDEN + 1, CLASSES)  # out, and base below it

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Hidden layer, and a last column of ones for the base."""
        wide = np.ones((len(context), HIDDEN + 1), np.float32)
        total = self.bias + self.table[0][context[:, 0]]
        for k in range(1, len(PLACES)):
            total += self.table[k][context[:, k]]
        np.tanh(total, out=wide[:, :HIDDEN])
        return wide

    def odds(self, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unscaled probabilities of the classes, their sums)."""
        odds = hidden @ self.last
        # hidden values lie within -1 and 1, which bounds the logits
        if float(np.abs(self.last).sum(axis=0).max()) > SAFE:
            odds -= odds.max(axis=1, keepdims=True)
        np.exp(odds, out=odds)
        return odds, odds @ ONES

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        odds, total = self.odds(self.hidden(context))
        return np.log(np.maximum(odds[np.arange(len(target)), target], np.finfo(np.float32).tiny) / total)

    def gradient(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Gradient of the mean loss. The division by the sums of the odds and
        by the number of tokens is done on the hidden layer's side, which is
        much narrower than the classes."""
        n = len(target)
        hidden = self.hidden(context)
        d, total = self.odds(hidden)
        d[np.arange(n), target] -= total
        scale = (1 / (total * n))[:, None]
        inner = hidden[:, :HIDDEN]
        d_total = (d @ self.out.T) * ((1 - inner * inner) * scale)
        tables = np.zeros_like(self.table)
        for k in range(len(PLACES)):
            order = np.argsort(context[:, k], kind="stable")
            ranked = context[order, k]
            starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            tables[k, ranked[starts]] = np.add.reduceat(d_total[order], starts, axis=0)
        return np.concatenate([tables.ravel(), d_total.sum(0), ((hidden * scale).T @ d).ravel()])


def contexts(classes: np.ndarray) -> np.ndarray:
    """Classes at the window's places around each token; outside the text the
    extra class ``CLASSES``."""
    reach = max(PLACES)
    wide = np.full(len(classes) + 2 * reach, CLASSES, np.int16)
    wide[reach: reach + len(classes)] = classes
    return np.stack([wide[reach + p: reach + p + len(classes)] for p in PLACES], axis=1)


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each bucket, log share of the bucket in its class). Buckets by
    falling count fill classes of about equal mass; each counts once more, so
    that words that training has not seen have a probability."""
    smooth = counts + 1.0
    order = np.argsort(-smooth, kind="stable")
    total, classes, at, used = smooth.sum(), np.zeros(len(counts), np.int64), 0, 0.0
    ranked = smooth[order]
    labels = np.zeros(len(counts), np.int64)
    left = total
    for i, m in enumerate(ranked):
        labels[i] = at
        used += m
        if at < CLASSES - 1 and used >= left / (CLASSES - at):
            left -= used
            at, used = at + 1, 0.0
    classes[order] = labels
    mass = np.bincount(classes, smooth, CLASSES)
    return classes.astype(np.int16), np.log(smooth / np.maximum(mass[classes], 1e-30))


def _counted(batches):
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        counts += np.bincount(text_buckets(b"\n".join(text_bytes(batch.column(0)))), minlength=BUCKETS)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], names=["bucket", "n"])


def corpus_counts(texts: DataFrame) -> np.ndarray:
    """Words a bucket over all texts (``BUCKETS`` numbers at most)."""
    counts = np.zeros(BUCKETS, np.int64)
    for r in texts.mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def train_part(net: Network, streams) -> int:
    """Walk the class sequences in mini-batches (Adagrad); tokens seen."""
    power = np.full(len(net.flat), 1e-4, np.float32)
    held, size, seen = [], 0, 0

    def step():
        nonlocal held, size
        context = np.concatenate([h[0] for h in held])
        target = np.concatenate([h[1] for h in held])
        held, size = [], 0
        for at in range(0, len(target), BATCH):
            g = net.gradient(context[at: at + BATCH], target[at: at + BATCH])
            np.add(power, g * g, out=power)
            net.flat -= RATE * g / np.sqrt(power)

    for classes in streams:
        if len(classes):
            held.append((contexts(classes), classes))
            size += len(classes)
            seen += len(classes)
            if size >= BATCH:
                step()
    if held:
        step()
    return seen


def train(texts: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, class of each bucket, log share) from all texts."""
    spark = texts.sparkSession
    counts = corpus_counts(texts)
    classes, share = classes_of(counts)
    unigram = np.bincount(classes, counts + 1.0, CLASSES)
    weights = Network(unigram=np.maximum(unigram, 1.0) / unigram.sum()).flat
    for _ in range(rounds):
        start = spark.sparkContext.broadcast((weights, classes))  # one model

        def local(batches, start=start):
            weights, classes = start.value
            net = Network(weights)
            seen = train_part(net, (classes[text_buckets(t)] for b in batches for t in text_bytes(b.column(0))))
            if seen:
                moved = np.rint(net.flat.astype(np.float64) / UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(moved)), pa.int32()), pa.array(moved), pa.array(np.full(len(moved), seen))],
                    names=["place", "weight", "seen"])

        parts = texts.mapInArrow(local, "place int, weight long, seen long")
        product = F.col("weight").cast("decimal(20,0)") * F.col("seen").cast("decimal(18,0)")
        rows = parts.groupBy("place").agg(F.sum(product).alias("total"), F.sum("seen").alias("seen")).collect()  # one model
        if not rows:
            break
        weights = weights.copy()
        for r in rows:
            weights[r["place"]] = float(r["total"]) / r["seen"] * UNIT
    return weights, classes, share


def log_likelihood(net: Network, classes: np.ndarray, share: np.ndarray, words: list[bytes]) -> float:
    """Sum over a text's words of their log-probability given both sides."""
    return likelihood(net, classes, share, buckets(words))


def likelihood(net: Network, classes: np.ndarray, share: np.ndarray, b: np.ndarray) -> float:
    """The same, of the words' buckets."""
    total = 0.0
    c = classes[b]
    context = contexts(c)
    for at in range(0, len(c), BATCH):
        target = c[at: at + BATCH]
        total += float(net.log_probabilities(context[at: at + BATCH], target).sum(dtype=np.float64))
    return total + float(share[b].sum())


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on all texts, then score each whole text: doc_id, n_tokens,
    log_likelihood (summed) and score (its mean a token).

    Words are runs without ASCII white space. A null or empty text has no
    tokens, a sum of 0 and a null score. Equal texts have equal scores;
    repeated rows count in training as often as given; no documents give no
    rows; other columns are ignored."""
    kind = dict(docs.dtypes)[doc_id]
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(chosen.select("text"), rounds))

    def run(batches):
        weights, classes, share = model.value
        net = Network(weights)
        for batch in batches:
            words = [text_buckets(t).astype(np.uint16) for t in text_bytes(batch.column(1))]
            sums = [likelihood(net, classes, share, w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(sums, pa.float64()),
                 pa.array([s / len(w) if len(w) else None for s, w in zip(sums, words)], pa.float64())],
                names=["doc_id", "n_tokens", "log_likelihood", "score"])
    return chosen.mapInArrow(run, f"doc_id {kind}, n_tokens long, log_likelihood double, score double")
