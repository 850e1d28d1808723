"""Packing by minimum bin slack.

A document's tokens are cut into full windows and one remainder. The packing
of the remainders depends only on how many there are of each length, a table
of at most ``window`` rows, so one small plan packs any number of documents:
the longest remaining length opens a sequence, and a bitset subset-sum
programme over the remaining lengths finds the reachable total closest to the
window; backtracking through the bitsets gives how many pieces of each length
make it up. The same filling is repeated as often as the counts allow, so
the plan has about as many entries as there are lengths. Remainders of one
length are interchangeable: each is numbered among its equals, and its number
says which sequence and place it takes.

Fillings with slack are not used as they are. Their pieces are laid end to end
and cut at the windows' edges, and what is left over behind the last full
window is cut at powers of two, where no padding is needed. So only documents
that fit no full window are cut a second time, and nothing is padded.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASHES, gapless_rank, stored, text_bytes
from .token_alignment import byte_alphabet

WINDOW = 2048
END_ID = 1
#: Words held by one worker's table before it is emptied.
CACHE_WORDS = 200_000
#: Characters of a run from which on merging pairs needs a heap.
LONG_RUN = 1000
#: Lower-case letters and signs whose runs the rules cut like any
#: other's; apostrophes (contractions), the sign that opens special tokens and
#: the mark put behind runs are not among them.
LETTERS = "a-zß-öø-ÿ"
SIGNS = r"!-&(-/:;=-@\[-`{-}"
BLANKS = r" \t-\r"
RUN = re.compile(f"[{LETTERS}]+|[0-9]|[{SIGNS}]+")
#: Any other character, and words with one.
ODD = re.compile(f"[^{LETTERS}A-ZÀ-ÖØ-Þ0-9{SIGNS}{BLANKS}]")
SPECIAL = re.compile(f"[^{BLANKS}]*[^{LETTERS}A-ZÀ-ÖØ-Þ0-9{SIGNS}{BLANKS}][^{BLANKS}]*")
MARK, STAND_IN = "~", "\x02"
UNBROKEN = re.compile(f"[^{MARK}]{{{LONG_RUN}}}")
PLAIN = re.compile(rb"[!-&(-;=-~]+")
#: Runs of letters in one call of the tokenizer.
TOGETHER = 1000
RUNS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


class WordIds(dict):
    """word (bytes) -> its ids as little-endian 32-bit bytes.

    The vocabulary's rules drop white space and never reach across it, so a
    text's ids are those of its words in turn. Each distinct word is given to
    the tokenizer once. A plain ASCII word is looked up by its runs of letters,
    single digits and runs of signs, at which the rules cut, in lower case,
    which they make of it; words with an apostrophe (contractions) or the mark
    that opens special tokens are not plain.

    A call of the tokenizer costs more than a short run does, so texts go to a
    plain pair merger with the file's own ranks, if its merges can be put so: a
    mark is written behind each run of letters, digit and run of signs, and
    takes part as the end of a word does, joined to the last byte before
    anything else is joined. Only words with other characters are looked up
    here, a stand-in keeps their places. Without a merger, runs of letters go
    to the tokenizer many at a time with a single digit between them: the rules
    cut at every digit, and no run of letters has a digit's id."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        (self.digit,) = self._ids("0")
        self.merger = self._merger(path)

    def _merger(self, path: str):
        """A pair merger and the stand-in's id, or None unless each merge of the
        file makes the next id, behind those of all bytes and ends."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix")
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = [vocabulary.get(m) for m in made]
        alphabet = byte_alphabet()
        singles = [c for a in alphabet for c in (a, a + end)] if end else []
        if (model["type"] != "BPE" or model.get("dropout") or not ids or not singles or not all(c in vocabulary for c in singles)
                or ids != list(range(ids[0], ids[0] + len(ids))) or max(vocabulary[c] for c in singles) >= ids[0]):
            return None
        import tiktoken
        ranks = {}
        for token in (*singles, *made):
            body, last = (token[:-len(end)], MARK.encode()) if token.endswith(end) else (token, b"")
            raw = bytes(alphabet[c] for c in body)
            if not any(c in raw for c in (MARK + STAND_IN).encode()):
                ranks[raw + last] = vocabulary[token]
        mark = max(vocabulary.values()) + 1
        ranks |= {MARK.encode(): mark, STAND_IN.encode(): mark + 1}
        pattern = f"[{LETTERS}]+{MARK}|[0-9]{MARK}|[{SIGNS}]+{MARK}|{STAND_IN}"
        return tiktoken.Encoding("ranks of the file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), mark + 1

    def of_texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts."""
        if not self.merger:
            words = [t.split() for t in texts]
            self.learn(set().union(*words))
            return [b"".join(map(self.__getitem__, w)) for w in words]
        merger, stand_in = self.merger
        texts = [t.decode() for t in texts]
        special = [SPECIAL.findall(t) if ODD.search(t) else [] for t in texts]
        self.learn({w.encode() for some in special for w in some})
        out = []
        for text, some in zip(texts, special):
            marked = RUN.sub(rf"\g<0>{MARK}", (SPECIAL.sub(STAND_IN, text) if some else text).lower())
            if len(marked) > 4 * LONG_RUN and UNBROKEN.search(marked):
                words = text.encode().split()
                self.learn(set(words))
                out.append(b"".join(map(self.__getitem__, words)))
                continue
            ids = merger.encode_to_numpy(marked, disallowed_special=()).astype("<u4")
            if some:
                at = (4 * np.flatnonzero(ids == stand_in)).tolist()
                raw = ids.tobytes()
                parts = [raw[a + 4:b] for a, b in zip([-4, *at], [*at, len(raw)])]
                ids = b"".join([parts[0], *(x for w, p in zip(some, parts[1:], strict=True) for x in (self[w.encode()], p))])
                out.append(ids)
            else:
                out.append(ids.tobytes())
        return out

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn_letters(self, runs: list[bytes]) -> None:
        """Take up runs of letters."""
        for at in range(0, len(runs), TOGETHER):
            part = runs[at: at + TOGETHER]
            ids = np.array(self._ids((b"0".join(part) + b"0").decode()), "<u4")
            ends = np.flatnonzero(ids == self.digit)
            raw, low = ids.tobytes(), 0
            for run, end in zip(part, (4 * ends).tolist(), strict=True):
                self[run] = raw[low:end]
                low = end + 4

    def learn(self, words: set[bytes]) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        parts = {w: RUNS.findall(w.lower()) if PLAIN.fullmatch(w) else [w] for w in new}
        once = set().union(*parts.values()).difference(self)
        self._learn_letters([p for p in once if p.isalpha()])
        once = list(once.difference(self))
        for part, e in zip(once, self.tokenizer.encode_batch_fast([p.decode() for p in once], add_special_tokens=False)):
            self[part] = np.array(e.ids, "<u4").tobytes()
        for word, runs in parts.items():
            if len(runs) > 1 or runs[0] != word:
                self[word] = b"".join([self[r] for r in runs])


_TOKENIZERS: dict[str, WordIds] = {}


def _cut(path: str, window: int):
    """Arrow function: documents -> pieces of at most ``window`` ids."""
    def run(batches):
        table = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, WordIds(path))
        end = END_ID.to_bytes(4, "little")
        HASHES.clear()  # what earlier stages left in this worker
        for batch in batches:
            # few rows at a time, as the words of a batch are held together
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, starts, lengths, crcs, totals, rest = [], [], [], [], [], []
                for row, ids in enumerate(table.of_texts(text_bytes(part.column(1)))):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        rows.append(row)
                        starts.append(start)
                        lengths.append(min(window, total - start))
                        crcs.append(zlib.crc32(ids[4 * start: 4 * (start + window)]))
                        totals.append(total)
                        rest.append(ids[4 * start:] if start + window > total else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())),
                     *(pa.array(c, pa.int64()) for c in (starts, lengths, crcs, totals)), pa.array(rest, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def pieces(docs: DataFrame, path: str, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Full windows and one remainder of each document, with their checksums,
    the remainder's ids, and a row number that is fixed once the table is
    stored."""
    kind = dict(docs.dtypes)[doc_id]
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(_cut(path, window), PIECES.format(id=kind))
            .withColumn("_row", F.monotonically_increasing_id()))


def best_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how many of each make the greatest total up to ``room``."""
    reach, trail = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        trail.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:  # 1, 2, 4 ... copies: every count up to the number left
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        used = 0
        while not before >> total & 1:
            total, used = total - length, used + 1
        if used:
            chosen[length] = used
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int], int]]:
    """(how often, {length: pieces}, tokens) of each kind of sequence."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        filling = best_filling(rest, window - longest)
        filling[longest] = filling.get(longest, 0) + 1
        often = min(left[n] // k for n, k in filling.items())
        out.append((often, filling, sum(n * k for n, k in filling.items())))
        for n, k in filling.items():
            left[n] -= k * often
            if not left[n]:
                del left[n]
    return out


def _recut(window: int, tokens: int, first: int):
    """Arrow function: pieces laid end to end -> pieces cut at sequence edges.
    ``tokens`` is the length of the whole line, ``first`` its first sequence."""
    whole = tokens // window
    tail, at = [], whole * window  # (edge, sequence) behind the last full window
    for bit in reversed(range(window.bit_length())):
        if tokens - whole * window >> bit & 1:
            tail.append((at, first + whole + len(tail)))
            at += 1 << bit
    tail.append((at, None))

    def sequence(place: int) -> tuple[int, int, int]:
        """(sequence, its start on the line, its end) at a place."""
        if place < whole * window:
            n = place // window
            return first + n, n * window, (n + 1) * window
        return next((s, a, b) for (a, s), (b, _) in zip(tail, tail[1:]) if a <= place < b)

    def run(batches):
        for batch in batches:
            rows, out = [], [[] for _ in range(6)]
            cols = [batch.column(c).to_pylist() for c in ("start", "doc_tokens", "_place", "ids")]
            for row, (start, total, place, ids) in enumerate(zip(*cols)):
                end, done = place + len(ids) // 4, 0
                while place < end:
                    seq, low, high = sequence(place)
                    take = min(high, end) - place
                    rows.append(row)
                    for col, v in zip(out, (start + done, take, zlib.crc32(ids[4 * done: 4 * (done + take)]), total, seq, place - low)):
                        col.append(v)
                    place, done = place + take, done + take
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in out)],
                names=["doc_id", *PACKED])
    return run


PACKED = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Sequences of a stored table of pieces."""
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # ``window`` rows at most
    uses: dict[int, list[tuple]] = {n: [] for n in counts}
    taken = dict.fromkeys(counts, 0)
    first = 0
    for often, filling, total in plan(counts, window):
        if total < window:
            continue
        offset = 0
        for n in sorted(filling, reverse=True):
            k = filling[n]
            uses[n].append((taken[n], taken[n] + k * often, k, first, offset))
            taken[n] += k * often
            offset += n * k
        first += often
    line, starts = 0, {}  # the pieces of the other fillings, end to end
    for n in counts:
        starts[n] = line
        line += n * (counts[n] - taken[n])
    # a row a length; the plan's entries are bounded by the window, not the input
    table = spark.createDataFrame(
        [(n, u, taken[n], starts[n]) for n, u in uses.items()],
        "length long, uses array<struct<lo:long,hi:long,each:long,first:long,offset:long>>, _taken long, _line long")
    ranked = gapless_rank(cut.drop("ids"), ["length"], ["doc_id", "_row"], "_rank").join(F.broadcast(table), "length")
    use = F.filter("uses", lambda u: (u["lo"] <= F.col("_rank")) & (F.col("_rank") < u["hi"]))[0]
    whole = (ranked.where("_rank < _taken").withColumn("_use", use)
             .withColumn("_nth", F.col("_rank") - F.col("_use.lo"))
             .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                     (F.col("_use.first") + F.floor(F.col("_nth") / F.col("_use.each"))).cast("long").alias("sequence_id"),
                     (F.col("_use.offset") + F.col("_nth") % F.col("_use.each") * F.col("length")).cast("long").alias("offset")))
    if not line:
        return whole
    kind = dict(cut.dtypes)["doc_id"]
    loose = (ranked.where("_rank >= _taken")
             .select("_row", "doc_id", "start", "doc_tokens",
                     (F.col("_line") + (F.col("_rank") - F.col("_taken")) * F.col("length")).alias("_place"))
             .join(cut.select("_row", "ids"), "_row"))
    return whole.unionByName(loose.mapInArrow(
        _recut(window, line, first), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in PACKED)))


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack every id of every document into sequences of at most ``window``.

    Returns a row a piece: doc_id, start (the document's ids before it),
    length, ids_crc32 (of its ids as little-endian 32-bit numbers),
    doc_tokens, sequence_id, offset (gapless from 0 in the sequence). A
    document's ids end with id 1, so a null or empty text is one piece of one
    id. Repeated rows are packed as often as given; null ids are kept; no
    documents give no pieces; other columns are ignored. A long text is cut
    into full windows, so no row or group grows with it."""
    return pack(stored(pieces(docs, path, window, doc_id, text), "pieces"), window)
