"""Substring dedup with suffix automata.

A window is ``WINDOW`` consecutive words. Every window has an anchor: the
least hash of its runs of ``GRAM`` words. Equal windows have equal anchors, and
neighbouring windows mostly share one, so a document falls into segments, each
the words of the windows with one anchor. Only anchors that occur more than
once can stand for repeated windows; all else is left out by hashes alone.

The segments of the anchors that are left are the reference. They are split
into shards by anchor, and each shard's segments become one suffix automaton
with the number of places each of its strings occurs at. Every segment is then
streamed through the automaton of its shard: its matching statistics say how
long a string ends at each word that also occurs elsewhere, and the maximal
spans of ``WINDOW`` words or more are removed. As equal windows meet in one
shard, no automaton has to see all documents and none is sent to all
executors, which could not hold with a growing reference.

Equal segments are one string with a count. An anchor with more than
``SEGMENTS`` different segments, or ``SHARD_WORDS`` words in them (a passage in very
many documents), would make an automaton without bound; there, single windows
are counted by their hashes.
"""

from __future__ import annotations

import re
from array import array
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, HASHES, mix, stored, text_bytes, windows

WINDOW = 35
GRAM = 8
#: Different segments of an anchor that one automaton takes.
SEGMENTS = 4000
#: Words of an automaton. An anchor whose segments have more is not given to one.
SHARD_WORDS = 60_000

_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int):
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(_UNDO, k, 1 << 64))])
        return self.up, self.down


_POWERS = _Powers()


def segments(words: list[bytes], window: int = WINDOW):
    """(anchors, content hashes, first words, numbers of words) of a document."""
    n = len(words)
    if n < window:
        return (np.zeros(0, np.int64),) * 4
    h = HASHES.of(words)
    least = grams = windows(h, min(GRAM, window))
    wide, have = window - min(GRAM, window) + 1, 1
    while have * 2 <= wide:  # least of ``have`` neighbours, doubled
        least, have = np.minimum(least[:-have], least[have:]), have * 2
    if have < wide:
        least = np.minimum(least[: len(least) - (wide - have)], least[wide - have:])
    # a window starts a segment if its least run is another, or the one before it
    # has just left with its first word; so no segment repeats one of its windows
    left = grams[: len(least) - 1] == least[:-1]
    first = np.flatnonzero(np.r_[True, left | (least[1:] != least[:-1])])
    size = np.r_[first[1:], len(least)] - first + window - 1
    up, down = _POWERS.to(n + 1)
    sums = np.r_[U64(0), np.cumsum(mix(h) * up[:n], dtype=U64)]
    content = mix((sums[first + size] - sums[first]) * down[first] + size.astype(U64))
    return least[first].view(np.int64), content.view(np.int64), first, size


def _segmented(window: int):
    def run(batches):
        for batch in batches:
            out = [segments(t.split(), window) for t in text_bytes(batch.column("_text"))]
            offsets = pa.array(np.cumsum([0, *(len(o[0]) for o in out)]), pa.int32())
            cols = [np.concatenate([o[k] for o in out]) if out else [] for k in range(4)]
            inner = pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["anchor", "content", "first", "size"])
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_text_key"), pa.ListArray.from_arrays(offsets, inner)],
                                             names=["_row", "_text_key", "_segments"])
    return run


class Automaton:
    """Suffix automaton of several word sequences, with occurrence counts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.count = array("i", [-1]), array("i", [0]), array("i", [0])

    def add(self, words, times: int) -> None:
        nxt, link, length, count = self.next, self.link, self.len, self.count
        last = 0
        for w in words:
            at = nxt[last].get(w)
            if at is not None:  # the string so far is known
                if length[at] != length[last] + 1:
                    at = self._split(last, w, at)
                count[at] += times
                last = at
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            count.append(times)
            p = last
            while p != -1 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p != -1:
                q = nxt[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
            last = new

    def _split(self, p: int, w, q: int) -> int:
        """Give the strings of ``q`` up to one word past ``p`` their own state."""
        nxt, link, length = self.next, self.link, self.len
        own = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        self.count.append(0)
        link[q] = own
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = own
            p = link[p]
        return own

    def close(self) -> None:
        """Sum occurrences up the suffix links, longest strings first."""
        for state in np.argsort(-np.frombuffer(self.len, np.int32), kind="stable").tolist():
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def statistics(self, words, least: int = 2):
        """Length of the longest string that ends at each word and occurs at
        least ``least`` times."""
        nxt, link, length, count = self.next, self.link, self.len, self.count
        state = matched = 0
        for w in words:
            to = nxt[state].get(w)
            while (to is None or count[to] < least) and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(w)
            if to is not None and count[to] >= least:
                state, matched = to, matched + 1
            yield matched


def covered(statistics, window: int) -> list[tuple[int, int]]:
    """(first word, words) of the maximal spans that long matches cover."""
    spans: list[tuple[int, int]] = []
    for i, n in enumerate(statistics):
        if n >= window:
            start = i - n + 1
            if spans and start <= spans[-1][0] + spans[-1][1]:
                start = min(start, spans[-1][0])
                while len(spans) > 1 and spans[-2][0] + spans[-2][1] >= start:
                    spans.pop()
                    start = min(start, spans[-1][0])
                spans[-1] = (start, i + 1 - start)
            else:
                spans.append((start, i + 1 - start))
    return spans


def _matched(window: int):
    """Segments sorted by anchor -> spans of those that occur once; several
    anchors share an automaton, an anchor is never split."""
    def spans_of(group):
        automaton, rows = Automaton(), []
        for words, times, *_ in group:
            automaton.add(words, times)
        automaton.close()
        for words, times, row, first in group:
            if times == 1:
                rows += [(row, first + a, n) for a, n in covered(automaton.statistics(words), window)]
        return rows

    def batch_of(rows):
        cols = list(zip(*rows)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32()))],
                                          names=["_row", "first", "size"])

    def run(batches):
        group, held, before, seen = [], 0, None, set()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("anchor", "content", "times", "_row", "first", "_words", "_total")]
            for anchor, content, times, row, first, words, total in zip(*cols):
                if anchor != before:
                    if held + total > SHARD_WORDS:
                        yield batch_of(spans_of(group))
                        group, held = [], 0
                    before, seen = anchor, set()
                if content not in seen:  # a text that several rows have came more than once
                    seen.add(content)
                    words = words.split(b" ")
                    group.append((words, min(times, 2), row, first))
                    held += len(words)
        yield batch_of(spans_of(group))
    return run


def _single_windows(window: int):
    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for row, first, times, words in zip(*(batch.column(c).to_pylist() for c in ("_row", "first", "times", "_words"))):
                runs = windows(HASHES.of(words.split(b" ")), window).view(np.int64)
                out[0].append(np.full(len(runs), row))
                out[1].append(first + np.arange(len(runs)))
                out[2].append(np.full(len(runs), times))
                out[3].append(runs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["_row", "first", "times", "_window"])
    return run


def _cut_out(batches):
    """A row a document with the segments asked for -> a row a segment with its words."""
    for batch in batches:
        cols = [[] for _ in range(6)]
        for row, text, asked in zip(batch.column("_row").to_pylist(), text_bytes(batch.column("_text")), batch.column("_asked").to_pylist()):
            words = text.split()
            for s in asked:
                for col, v in zip(cols, (s["anchor"], s["content"], s["times"], row, s["first"], b" ".join(words[s["first"]: s["first"] + s["size"]]))):
                    col.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            names=["anchor", "content", "times", "_row", "first", "_words"])


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, segments_max: int = SEGMENTS) -> DataFrame:
    """(_text_key, _spans): for each text (md5 of its bytes, null as empty) the
    spans of words (first, size) that lie in a repeated window."""
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.md5(body).alias("_text_key"), body.alias("_text"), F.monotonically_increasing_id().alias("_row"))
    found = stored(keyed.mapInArrow(_segmented(window), "_row long, _text_key string, _segments array<struct<anchor:long,content:long,first:int,size:int>>"), "segments")
    keys = found.select("_row", "_text_key")
    every = found.select("_row", F.inline("_segments"))
    again = every.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor")
    places = stored(every.join(again, "anchor"), "places")
    strings = (places.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min(F.struct("_row", "first", "size")).alias("_one")))
    strings = stored(strings.select("anchor", "content", "times", "_one.*"), "strings")
    kinds = strings.groupBy("anchor").agg(F.count("*").alias("_kinds"), F.sum("size").alias("_total"))

    # a string that is there twice is covered from end to end
    whole = places.join(strings.where("times > 1").select("anchor", "content"), ["anchor", "content"]).select("_row", "first", "size")

    # the others need their words
    asked = strings.join(kinds.where("_kinds > 1").select("anchor"), "anchor")
    of_row = asked.groupBy("_row").agg(F.collect_list(F.struct("anchor", "content", "times", "first", "size")).alias("_asked"))
    texts = keyed.select("_text_key", "_text")
    cut = (texts.join(of_row.join(keys, "_row"), "_text_key")
           .mapInArrow(_cut_out, "anchor long, content long, times long, _row long, first int, _words binary"))
    cut = stored(cut, "reference").join(kinds, "anchor")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    bounded = (F.col("_kinds") <= segments_max) & (F.col("_total") <= SHARD_WORDS)
    matched = (cut.where(bounded).drop("_kinds")
               .repartition(parts, "anchor").sortWithinPartitions("anchor")
               .mapInArrow(_matched(window), "_row long, first int, size int"))
    single = (cut.where(~bounded).dropDuplicates(["anchor", "content"])
              .mapInArrow(_single_windows(window), "_row long, first int, times long, _window long"))
    single = stored(single, "windows")
    twice = single.groupBy("_window").agg(F.sum("times").alias("_n")).where("_n > 1").select("_window")
    hot = single.join(twice, "_window").select("_row", "first", F.lit(window).alias("size"))

    spans = whole.unionByName(matched).unionByName(hot)
    by_row = spans.groupBy("_row").agg(F.collect_list(F.struct("first", "size")).alias("_spans"))
    # rows with one text have the same spans
    by_text = by_row.join(keys, "_row").groupBy("_text_key").agg(F.min_by("_spans", "_row").alias("_spans"))
    return by_text


def _mask(n: int, spans) -> np.ndarray:
    gone = np.zeros(n + 1, np.int32)
    for s in spans or ():
        gone[s["first"]] += 1
        gone[s["first"] + s["size"]] -= 1
    return np.cumsum(gone[:n]) > 0


def _digests(batches):
    for batch in batches:
        cols = [[], [], []]
        for text, spans in zip(text_bytes(batch.column("_text")), batch.column("_spans").to_pylist()):
            words = text.split()
            n = len(words)
            if spans:
                words = [w for w, gone in zip(words, _mask(n, spans).tolist()) if not gone]
            for col, v in zip(cols, (n, n - len(words), sha256(b" ".join(words)).hexdigest())):
                col.append(v)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string())))],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What is left of each document without its repeated passages: doc_id,
    n_words, n_removed and kept_sha256 (of the kept words joined by a space).

    A word goes if any window of 35 words that covers it starts anywhere else,
    in the same document too. Null and empty texts have no words; repeated rows
    repeat all their windows; texts under 35 words stay whole. No documents
    give no rows; other columns are ignored."""
    spans = repeated_spans(docs, text)
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), body.alias("_text"), F.md5(body).alias("_text_key"))
    kind = dict(keyed.dtypes)["doc_id"]
    return (keyed.join(spans, "_text_key", "left").drop("_text_key")
            .mapInArrow(_digests, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _shortened(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, spans in enumerate(batch.column("_spans").to_pylist()):
            if spans:
                raw = texts[i].encode()
                parts = _WORD.findall(raw)
                lead = len(raw) - sum(map(len, parts))
                texts[i] = (raw[:lead] + b"".join(p for p, gone in zip(parts, _mask(len(parts), spans).tolist()) if not gone)).decode()
        names = [c for c in batch.schema.names if c != "_spans"]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the words that :func:`removals` counts, each with
    the white space behind it; n_chars is counted anew; same columns and rows."""
    spans = repeated_spans(docs)
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    key = F.md5(F.coalesce("text", F.lit("")))
    joined = docs.withColumn("_text_key", key).join(spans, "_text_key", "left").select(*docs.columns, "_spans")
    return joined.mapInArrow(_shortened, schema).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
