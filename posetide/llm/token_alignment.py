"""Alignment of two tokenizers' tokens of the same text.

Both token sequences are turned into arrays of byte ends. Where both are cut at
the same byte, a group ends. Most groups are one token to one, so the arrays
mostly agree at a fixed shift of their indices (a diagonal): from an agreement
on, windows of 4, 8, 16 ... ends are compared at that shift until one differs,
whose first difference is found at once, and the whole stretch is jumped. Where
the ends differ, the smaller one is advanced until they meet; that irregular group
changes the shift.

The last tokens of a group end together and are linked. How often an id pair is
linked is counted over the corpus. Texts are dealt with in blocks (the Arrow
batches, or parts of them): a block sends each of its different pairs once to the counts and gets
them back once, so a pair that every text holds is one row a block, not one a
text.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Characters given to a tokenizer at a time; longer texts are cut between words.
AT_ONCE = 1 << 18
#: Ends compared by the first probe of a stretch; each further one doubles.
FIRST_STEP = 4
#: Links of a block, which is handled in one piece.
BLOCK_LINKS = 2_000_000
#: Characters whose classes (letter, number, space) all versions of Unicode agree on.
OTHER = re.compile("[^\x00-\u024f]")
#: A run without a break from which on merging pairs needs a heap.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
#: A blank between two letters begins a token of a byte-level tokenizer.
BETWEEN = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes in order for characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def cut_text(text: str) -> list[str]:
    """A long text in parts that a byte-level tokenizer encodes as the whole."""
    out, at = [], 0
    while len(text) - at > AT_ONCE:
        found = BETWEEN.search(text, at + AT_ONCE)
        if not found:
            break
        out.append(text[at:found.start()])
        at = found.start()
    return [*out, text[at:]]


class ByteTokens:
    """A byte-level tokenizer file: ids and bytes of tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        alphabet = byte_alphabet()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in parsed["model"]["vocab"].items():
            self.bytes[i] = bytes(alphabet[c] for c in token)
        for token in parsed["added_tokens"]:
            self.bytes[token["id"]] = token["content"].encode()
        self.sizes = np.array(list(map(len, self.bytes)))
        self.lossless = not parsed["normalizer"] and {bytes([b]) for b in range(256)} <= set(self.bytes)
        self.quick = self._quick(parsed)

    def _quick(self, parsed):
        """A faster encoder with the file's ranks, if the file is plain: every
        merge makes the next id, no normaliser, the usual splitting."""
        model, split = parsed["model"], parsed["pre_tokenizer"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if (parsed["normalizer"] or model.get("dropout") or split["type"] != "ByteLevel" or split["add_prefix_space"]
                or [model["vocab"].get(m) for m in merged] != list(range(256, 256 + len(merged)))):
            return None
        import tiktoken
        ranks = {self.bytes[i]: i for i in range(256 + len(merged))}
        # fixed value: how byte-level tokenizers split a text
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("ranks of the file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the texts, a bounded amount of text at a time."""
        out: list = [[] for _ in texts]
        waiting, where, size = [], [], 0
        for i, text in enumerate(texts):
            if self.quick and not OTHER.search(text) and (len(text) < 4000 or not LONG_RUN.search(text)):
                out[i] = self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
                continue
            for part in cut_text(text):
                waiting.append(part)
                where.append(i)
                size += len(part)
                if size > AT_ONCE:
                    self._flush(waiting, where, out)
                    size = 0
        self._flush(waiting, where, out)
        return [x if isinstance(x, np.ndarray) else np.array(x, np.int64) for x in out]

    def _flush(self, waiting, where, out):
        for i, e in zip(where, self.tokenizer.encode_batch_fast(waiting, add_special_tokens=False)):
            out[i] = out[i] + e.ids if out[i] else e.ids
        waiting.clear()
        where.clear()


class PieceTokens:
    """A sentencepiece file: ids and bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                      for i, p in enumerate(pieces)]
        self.sizes = np.array(list(map(len, self.bytes)))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def diagonal_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens up to each common end, for two increasing arrays of ends
    with the same last one."""
    flat_a, flat_b = ends_a.astype("<u8").tobytes(), ends_b.astype("<u8").tobytes()
    a, b = memoryview(flat_a).cast("Q"), memoryview(flat_b).cast("Q")
    i = j = 0
    n = len(a)
    found: list[int] = []   # first common end of a stretch on both sides, and how many follow one to one
    while i < n:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        k, step = 1, FIRST_STEP
        while True:
            x, y = flat_a[8 * (i + k):8 * (i + k + step)], flat_b[8 * (j + k):8 * (j + k + step)]
            if x != y or not x:
                break
            k += len(x) // 8
            step *= 2
        if x and y:  # the ends of the window that still agree
            differ = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
            k += ((differ & -differ).bit_length() - 1) // 64 if len(x) == len(y) else _agreeing(x, y)
        found += (i, j, k)
        i += k
        j += k
    first_a, first_b, sizes = np.array(found, np.int64).reshape(-1, 3).T
    inside = np.arange(1, int(sizes.sum()) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(first_a, sizes) + inside, np.repeat(first_b, sizes) + inside


def _agreeing(x: bytes, y: bytes) -> int:
    """Leading 8-byte values that two windows of unequal size share."""
    size = min(len(x), len(y))
    if x[:size] == y[:size]:
        return size // 8
    differ = int.from_bytes(x[:size], "little") ^ int.from_bytes(y[:size], "little")
    return ((differ & -differ).bit_length() - 1) // 64


class Aligner:
    """Aligns the tokens of two tokenizer files; made once a worker."""

    made: dict[tuple[str, str], "Aligner"] = {}

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        # an id and the sign behind it: more of its side, the other side, the next group
        most = max(len(self.a.bytes), len(self.b.bytes))
        self.shown = [f"{i}{sign}" for i in range(most) for sign in ",|;"]

    @classmethod
    def of(cls, a: str, b: str) -> "Aligner":
        if (a, b) not in cls.made:
            cls.made[a, b] = cls(a, b)
        return cls.made[a, b]

    def align(self, raw: bytes, ids_a: list[int], ids_b: list[int]):
        """(ids of A, of B, tokens up to each cut on both sides); None if a
        side's bytes are not ``raw``."""
        a, b = np.asarray(ids_a), np.array(ids_b)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        # a byte-level side with all 256 bytes gives back any text
        if ends_a[-1] != len(raw) or ends_b[-1] != len(raw) or b"".join(map(self.b.bytes.__getitem__, ids_b)) != raw:
            return None
        if not self.a.lossless and b"".join(map(self.a.bytes.__getitem__, a.tolist())) != raw:
            return None
        return a, b, *diagonal_cuts(ends_a, ends_b)

    def written(self, a, b, cuts_a, cuts_b) -> str:
        """``a1,a2|b1;a3|b2,b3``: the groups' ids on both sides."""
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[cuts_a - 1] = 1
        ends_b[cuts_b - 1] = 2
        # a token stands behind all of the other side's tokens of earlier groups (B: and of its own)
        group_a = np.cumsum(ends_a) - ends_a
        group_b = np.cumsum(ends_b // 2) - ends_b // 2
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.concatenate([[0], cuts_b])[group_a]] = 3 * a + ends_a
        out[np.arange(len(b)) + cuts_a[group_b]] = 3 * b + ends_b
        return "".join(map(self.shown.__getitem__, out.tolist()))[:-1]

    def batch(self, texts: list[str | None]):
        """n_a, n_b, groups, different linked id pairs and how often, of each text."""
        present = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in present]
        none = np.zeros(0, np.int64)
        rows: list[tuple[int, int, str, np.ndarray, np.ndarray]] = [(0, 0, "", none, none)] * len(texts)
        for i, text, ids_a, ids_b in zip(present, given, self.a.encode([" " + t for t in given]), self.b.encode(given)):
            got = self.align((" " + text).encode(), ids_a, ids_b)
            if got:
                a, b, cuts_a, cuts_b = got
                pairs, times = np.unique(a[cuts_a - 1] << 32 | b[cuts_b - 1], return_counts=True)
                rows[i] = len(a), len(b), self.written(*got), pairs, times
        return rows


def _slices(texts: list[str | None]):
    """Ranges of texts of bounded length together."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > AT_ONCE:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def alignments(docs: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with n_a, n_b, ``groups`` (``a1,a2|b1;a3|b2,b3``, ids in
    order), ``links`` (different linked pairs, as A id * 2**32 + B id) and ``times``
    (how often each; they add up to the number of groups).

    ``a`` is a byte-level tokenizer file, given a blank and the text, ``b`` a
    sentencepiece file that adds the blank. Strings of special tokens inside a
    text are text. A text that is null, empty, or not given back by either
    side's bytes has no tokens: zeros, an empty string, no links. Texts are
    aligned whole; equal texts have equal results; no rows give none. The added
    columns take the place of columns of their names."""
    added = ("n_a", "n_b", "groups", "links", "times")
    keep = [(c, t) for c, t in docs.dtypes if c != text and c not in added]

    def run(batches):
        aligner = Aligner.of(a, b)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for begin, end in _slices(texts):
                rows = aligner.batch(texts[begin:end])
                n_a, n_b, groups, links, times = zip(*rows)
                ends = pa.array(np.cumsum([0, *map(len, links)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(begin, end - begin) for i in range(len(keep))),
                     pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(groups, pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(links))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times), pa.int32()))],
                    names=[*(c for c, _ in keep), *added])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in keep), "n_a long, n_b long, groups string, links array<bigint>, times array<int>"])
    return docs.select(*(f"`{c}`" for c, _ in keep), f"`{text}`").mapInArrow(run, schema)


def _dealt(batches, width: int):
    """Batches cut so that each has about ``BLOCK_LINKS`` links, or one row."""
    for batch in batches:
        ends = batch.column(width).offsets.to_numpy()
        begin = 0
        while begin < len(batch):
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + BLOCK_LINKS, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def _blocked(width: int, names: list[str]):
    """Deal rows into blocks: a row keeps the places of its links among the
    block's different pairs; one more row a block holds these and their counts.
    The last two columns given are links and times."""
    def run(batches):
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(_dealt(batches, width)):
            rows = len(batch)
            links = batch.column(width)
            sizes = np.diff(links.offsets.to_numpy())
            times = batch.column(width + 1).flatten()
            places, pairs = pd.factorize(links.flatten().to_numpy())
            counts = np.bincount(places, weights=times.to_numpy(), minlength=len(pairs)).astype(np.int64)
            ends = np.cumsum([0, *sizes])
            block = pa.array(np.full(rows + 1, (part << 32) + number), pa.int64())
            ends = pa.array([*ends, ends[-1]], pa.int32())
            whole = pa.array([0] * (rows + 1) + [len(pairs)], pa.int32())
            columns = [pa.concat_arrays([batch.column(i), pa.nulls(1, batch.column(i).type)]) for i in range(width)]
            yield pa.RecordBatch.from_arrays(
                [*columns, block, pa.array([False] * rows + [True]),
                 pa.ListArray.from_arrays(ends, pa.array(places, pa.int32())),
                 pa.ListArray.from_arrays(ends, times),
                 pa.ListArray.from_arrays(whole, pa.array(pairs)),
                 pa.ListArray.from_arrays(whole, pa.array(counts))],
                names=[*names, "_block", "_pairs_row", "_places", "_times", "_pairs", "_counts"])
    return run


def link_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` without ``links`` and ``times``, with n_links, n_best (links whose pair's count
    is the highest of their B id, ties included) and count_sum (of the links'
    counts). Names that begin with an underscore and end the list of the block
    columns must not be in ``aligned``.

    Pairs are counted over all rows. Rows without links have zeros."""
    added = ("n_links", "n_best", "count_sum")
    keep = [(c, t) for c, t in aligned.dtypes if c not in ("links", "times", *added)]
    names = [c for c, _ in keep]
    kept = ", ".join(f"`{c}` {t}" for c, t in keep)
    blocks = stored(aligned.select(*(f"`{c}`" for c in names), "links", "times").mapInArrow(
        _blocked(len(keep), names),
        f"{kept}, _block long, _pairs_row boolean, _places array<int>, _times array<int>, _pairs array<bigint>, _counts array<bigint>"),
        "alignment-blocks")
    held = blocks.where("_pairs_row").select("_block", F.posexplode(F.arrays_zip("_pairs", "_counts")).alias("_at", "_row"))
    held = held.select("_block", "_at", F.col("_row._pairs").alias("_pair"), F.col("_row._counts").alias("_n"))
    counts = stored(held.groupBy("_pair").agg(F.sum("_n").alias("_count")), "alignment-pairs")
    right = F.col("_pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = counts.groupBy(right.alias("_right")).agg(F.max("_count").alias("_most"))
    known = (counts.withColumn("_right", right).join(best, "_right")
             .select("_pair", "_count", (F.col("_count") == F.col("_most")).alias("_best")))
    answers = (held.join(known, "_pair").groupBy("_block")
               .agg(F.collect_list(F.struct("_at", "_count", "_best")).alias("_answers"))    # a block's pairs
               .withColumnRenamed("_block", "_of"))

    def scored(rows: pa.Table, answer: pa.Table) -> pa.Table:
        rows, answer = rows.combine_chunks(), answer.combine_chunks()
        n = len(rows)
        kept_columns = [rows.column(i) for i in range(len(keep))]
        count, best_ = np.zeros(1, np.int64), np.zeros(1, np.int64)
        if len(answer):
            flat = answer.column("_answers").combine_chunks().flatten()
            at = flat.field("_at").to_numpy()
            count, best_ = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            count[at] = flat.field("_count").to_numpy()
            best_[at] = flat.field("_best").to_numpy(zero_copy_only=False)
        places = rows.column("_places").combine_chunks()
        sizes = np.diff(places.offsets.to_numpy())
        at, times_ = places.flatten().to_numpy(), rows.column("_times").combine_chunks().flatten().to_numpy()
        owner = np.repeat(np.arange(n), sizes)
        sums = []
        for value in (times_.astype(np.int64), times_ * best_[at], times_ * count[at]):
            total = np.zeros(n, np.int64)
            np.add.at(total, owner, value)
            sums.append(pa.array(total))
        return pa.Table.from_arrays([*kept_columns, *sums], names=[*names, *added])

    texts = blocks.where("not _pairs_row").select(*(f"`{c}`" for c in names), "_block", "_places", "_times")
    return (texts.groupBy("_block").cogroup(answers.groupBy("_of"))
            .applyInArrow(scored, f"{kept}, n_links long, n_best long, count_sum long"))
