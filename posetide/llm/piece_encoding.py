"""Sub-word encoding and decoding that keeps offsets.

A model file is read for its pieces, scores and normaliser. Normalisation
walks the text and at each place takes the longest prefix that the compiled
character map (a double-array trie over UTF-8 bytes) knows, noting for every
byte it writes which source bytes it came from. The normalised text is cut
where no piece could reach across, each distinct chunk is merged once (best
score first, leftmost among equals; short chunks many at a time, plain
ones by a pair merger that is given the pieces' order), and every piece is projected through the
alignment to a span of the original bytes. Characters that no piece has
become byte pieces.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_CHUNKS = 400_000
#: Characters of a chunk that is merged with others, and how many at once.
SHORT, TOGETHER = 64, 20_000
#: Stands between chunks that are merged in one call; no piece has it.
MARK = "\x00"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharMap:
    """Longest-prefix normalisation by a compiled character map.

    The map is a length, that many bytes of a double-array trie of 32-bit
    units, and the replacements, each ended by a zero byte. A unit holds its
    label in the low byte, the offset to its children from bit 10 (times 256 if
    bit 9 is set) and in bit 8 whether a key ends there; the value of a key is
    where its replacement starts."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4: 4 + size], "<u4").tolist()
        self.texts = blob[4 + size:]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest key at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units) or units[node] & 0x800000FF != raw[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]: self.texts.index(0, found[1])]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


def is_plain(chunk: str) -> bool:
    """ASCII characters and single spaces; pieces of several spaces have equal
    scores, which ranks cannot say."""
    return SPACE * 2 not in chunk and chunk.replace(SPACE, " ").isascii()


class Chunks(dict):
    """Chunk of normalised text -> its ids, and the bytes that each covers, as
    32-bit numbers."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def learn(self, chunks: set[str]) -> None:
        """Merge what is new: short chunks of known characters all at once, the
        others one by one."""
        if len(self) > CACHE_CHUNKS:
            self.clear()
        new = [c for c in chunks if c not in self]
        known = self.model.known
        short = [c for c in new if len(c) <= SHORT and known.issuperset(c)]
        plain = [c for c in short if is_plain(c)] if self.model.quick else []
        others = [c for c in short if not is_plain(c)] if self.model.quick else short
        for merge, some in ((self.model.merge_plain, plain), (self.model.merge_all, others)):
            for at in range(0, len(some), TOGETHER):
                part = some[at: at + TOGETHER]
                ids, sizes, ends = merge(part)
                ids, sizes, low = ids.tobytes(), sizes.tobytes(), 0
                for chunk, end in zip(part, (4 * ends).tolist()):
                    self[chunk] = ids[low:end], sizes[low:end]
                    low = end
        for chunk in new:
            if chunk not in self:
                # no merge crosses a place whose two characters no piece has side by side
                joints = self.model.joints
                cuts = [i for i in range(1, len(chunk)) if chunk[i - 1: i + 1] not in joints]
                parts = [self.model.chunk_ids(chunk[a:b]) for a, b in zip([0, *cuts], [*cuts, len(chunk)])]
                self[chunk] = tuple(np.array([x for p in parts for x in p[k]], "<i4").tobytes() for k in (0, 1))


class Model:
    """Pieces, scores and normaliser of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        m = proto.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        if m.trainer_spec.model_type != m.trainer_spec.BPE or not m.trainer_spec.byte_fallback:
            raise ValueError("a merge model with byte fallback is needed")
        if any(p.type in (USER, UNUSED) for p in m.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        spec = m.normalizer_spec
        if not spec.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model must write spaces as prefixes")
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.map = CharMap(spec.precompiled_charsmap)
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in m.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
        # the characters that stand next to each other in some piece
        self.joints = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self._pair_table()
        self.quick = self._plain_merger()
        # runs that no merge leaves: spaces in front, then neither space nor line break
        closed = all(not (b == SPACE and a != SPACE) and "\n" not in (a, b) for a, b in self.joints)
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if closed else r"(?s).+")
        self.cache = Chunks(self)

    # -- normalisation ----------------------------------------------------
    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """Normalised text, and for each of its UTF-8 bytes and its end the
        source byte that it starts from (None: as by :meth:`_plain`)."""
        if not text:
            return "", None
        if not self.map.units and not self.squeeze:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), None
        raw = text.encode("utf-8")
        space = SPACE.encode()
        units = []  # (source byte, replacement)
        at = 0
        while at < len(raw):
            hit = self.map.longest(raw, at)
            if hit:
                taken, new = hit
            else:
                lead = raw[at]
                taken = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = raw[at: at + taken]
            units.append((at, new))
            at += taken
        if self.squeeze:
            while units and not units[0][1].strip(b" "):
                units.pop(0)
        if not units:
            return "", np.array([len(raw)])
        out, source = bytearray(), []

        def put(piece: bytes, frm: int) -> None:
            out.extend(piece)
            source.extend([frm] * len(piece))

        if self.prefix:
            put(space, units[0][0])
        spaced = self.squeeze
        for frm, new in units:
            while spaced and new.startswith(b" "):
                new = new[1:]
            if new:
                put(b"".join(space if c == 32 else bytes([c]) for c in new), frm)
                spaced = self.squeeze and new.endswith(b" ")
        end = len(raw)
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space):]
                end = source[-len(space)]
                del source[-len(space):]
        source.append(end)
        return out.decode("utf-8", "replace"), np.array(source)

    def _plain(self, text: str, normal: str) -> np.ndarray:
        """Alignment of a text of which only the spaces were rewritten."""
        raw = np.frombuffer(text.encode(), np.uint8)
        width = np.where(raw == 32, len(SPACE.encode()), 1)
        body = np.repeat(np.arange(len(raw)), width)
        return np.concatenate([np.zeros(len(SPACE.encode()) * self.prefix, np.int64), body, [len(raw)]])

    # -- merging ------------------------------------------------------------
    def _pair_table(self) -> None:
        """Every pair of symbols that makes a piece. Symbols are the pieces and
        the characters in them; ``rank`` orders pieces by falling score, equal
        scores alike."""
        pieces = list(self.ids)
        symbol = {p: i for i, p in enumerate(dict.fromkeys(chain(pieces, *pieces)))}
        values = sorted(set(self.scores.values()), reverse=True)
        place = dict(zip(values, range(len(values))))
        pairs = sorted((symbol[l] * len(symbol) + symbol[r], symbol[p])
                       for p in pieces for k in range(1, len(p))
                       if (l := p[:k]) in symbol and (r := p[k:]) in symbol)
        self.pairs, self.joined = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        self.rank = np.array([place[self.scores[p]] if p in self.scores else len(values) for p in symbol], np.int64)
        self.symbol_ids = np.array([self.ids.get(p, -1) for p in symbol], "<i4")
        self.symbol_bytes = np.array([len(p.encode()) for p in symbol], "<i4")
        # characters that are pieces, so that nothing made of them needs byte pieces
        self.known = {p for p in pieces if len(p) == 1}
        self.of_character = np.zeros(1 + max(map(ord, self.known), default=0), np.int64)
        for p in self.known:
            self.of_character[ord(p)] = symbol[p]

    def _plain_merger(self):
        """A pair merger for plain chunks (:func:`is_plain`), with the place of a
        piece by falling score as its rank; None if pieces that merges make have
        equal scores or the mark between chunks is a piece's character."""
        plain = {p: s for p, s in self.scores.items() if is_plain(p)}
        merged = [s for p, s in plain.items() if len(p) > 1]
        if len(set(merged)) < len(merged) or any(MARK in p or " " in p for p in plain) or not plain:
            return None
        import tiktoken
        order = sorted(plain, key=lambda p: -plain[p])
        ranks = {p.replace(SPACE, " ").encode(): i for i, p in enumerate(order)} | {MARK.encode(): len(order)}
        self.plain_ids = np.array([self.ids[p] for p in order] + [-1], "<i4")
        self.plain_bytes = np.array([len(p.encode()) for p in order] + [0], "<i4")
        return tiktoken.Encoding("pieces by score", pat_str=f"[^{MARK}]+|{MARK}", mergeable_ranks=ranks, special_tokens={})

    def merge_plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`merge_all` for known ASCII characters and spaces: the pair that
        makes the best piece is joined first, the leftmost of equal ones."""
        joined = (MARK.join(chunks) + MARK).replace(SPACE, " ")
        places = self.quick.encode_to_numpy(joined, disallowed_special=())
        marks = places == len(self.plain_ids) - 1
        ends = np.flatnonzero(marks) - np.arange(len(chunks))
        places = places[~marks]
        return self.plain_ids[places], self.plain_bytes[places], ends

    def merge_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge many chunks of known characters side by side: in each round
        every chunk joins its leftmost pair of the best score. Returns ids,
        sizes in bytes and where each chunk ends."""
        symbols = self.of_character[np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")]
        owner = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        done, width, never = [], len(self.symbol_ids), len(self.rank) + 1

        def look(left, right, same):
            """(rank, symbol made) of pairs; ``never`` if they make none."""
            code = left * width + right
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            made = np.where(same & (self.pairs[at] == code), self.joined[at], -1)
            return np.where(made >= 0, self.rank[made], never), made

        if len(symbols) and len(self.pairs):
            # pair i is that of symbols i and i + 1; the last has no partner
            rank, made = look(symbols, np.r_[symbols[1:], 0], np.r_[owner[1:] == owner[:-1], False])
        while len(symbols) and len(self.pairs):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            best = np.minimum.reduceat(rank, starts)
            live = np.repeat(best < never, sizes)
            if not live.all():  # chunks with nothing to join are set aside
                done.append((owner[~live], symbols[~live]))
                symbols, owner, rank, made = symbols[live], owner[live], rank[live], made[live]
                sizes, best = sizes[best < never], best[best < never]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            hits = hits[np.r_[True, owner[hits][1:] != owner[hits][:-1]]]
            symbols[hits] = made[hits]
            stay = np.ones(len(symbols), bool)
            stay[hits + 1] = False
            symbols, owner, rank, made = symbols[stay], owner[stay], rank[stay], made[stay]
            hits -= np.arange(len(hits))  # one symbol went behind each hit
            # only the pairs on either side of a joined symbol have changed
            touched = np.concatenate([hits, hits[hits > 0] - 1])
            after = np.minimum(touched + 1, len(symbols) - 1)
            rank[touched], made[touched] = look(
                symbols[touched], symbols[after], (owner[touched] == owner[after]) & (after > touched))
        done.append((owner, symbols))
        owner, symbols = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(owner, kind="stable")
        symbols = symbols[order]
        ends = np.cumsum(np.bincount(owner, minlength=len(chunks)))
        return self.symbol_ids[symbols], self.symbol_bytes[symbols], ends

    def merge(self, chunk: str) -> list[str]:
        """Pieces of a chunk: the adjacent pair with the best score is joined
        until none is a piece; leftmost first among equal scores."""
        score = self.scores
        parts: list[str | None] = list(chunk)
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-score[p], i, p, i + 1) for i in range(n - 1) if (p := chunk[i: i + 2]) in score]
        heapq.heapify(heap)
        while heap:
            _, i, joined, j = heapq.heappop(heap)
            if parts[i] is None or j >= n or parts[j] is None or after[i] != j or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := joined + parts[after[i]]) in score:
                    heapq.heappush(heap, (-score[p], i, p, after[i]))
            if (k := before[i]) >= 0 and (p := parts[k] + joined) in score:
                heapq.heappush(heap, (-score[p], k, p, i))
        return [p for p in parts if p is not None]

    def chunk_ids(self, chunk: str) -> tuple[list[int], list[int]]:
        """Ids of a chunk and the bytes that each covers (only the last byte
        piece of a character covers it)."""
        ids, sizes = [], []
        for piece in self.merge(chunk):
            if (i := self.ids.get(piece)) is not None:
                ids.append(i)
                sizes.append(len(piece.encode()))
            else:
                raw = piece.encode()
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(raw)]
        return ids, sizes

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, first byte and end byte of each piece in the original text. A
        character's byte pieces all span the whole character."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """:meth:`encode` of several texts, whose chunks are merged together."""
        normal = [self.normalise(t) for t in texts]
        chunks = [self.chunks.findall(n) for n, _ in normal]
        self.cache.learn(set().union(*chunks))
        return [self._projected(t, n, source, c) for t, (n, source), c in zip(texts, normal, chunks)]

    def _projected(self, text: str, normal: str, source: np.ndarray | None, chunks: list[str]):
        if not chunks:
            return (np.zeros(0, np.int32),) * 3
        parts = list(map(self.cache.__getitem__, chunks))
        ids, sizes = (np.frombuffer(b"".join(map(itemgetter(k), parts)), "<i4") for k in (0, 1))
        if source is None:
            source = self._plain(text, normal)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        if sizes.all():
            return ids, source[starts], source[ends]
        # bytes of one character: all but the last have size 0 and end early
        last = np.flatnonzero(sizes)
        of = np.searchsorted(last, np.arange(len(sizes)))
        return ids, source[starts[last][of]], source[ends[last][of]]

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, starts and ends (bytes of the original text) and decoded of
    each whole text. Null and empty texts have no pieces; equal texts are
    encoded alike; repeated rows are kept; other columns are ignored; no
    documents give no rows."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        m = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = m.encode_all([t or "" for t in part.column(1).to_pylist()])
                offsets = pa.array(np.cumsum([0, *(len(o[0]) for o in out)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0),
                     *(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([o[k] for o in out]), pa.int32())) for k in range(3)),
                     pa.array([m.decode(o[0].tolist()) for o in out], pa.string())],
                    names=["doc_id", "ids", "starts", "ends", "decoded"])
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string"))
