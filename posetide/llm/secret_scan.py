"""Secret scans: fixed patterns and a password guess-cost programme.

The base patterns find assignments, access keys and long hexadecimal runs.
The method looks at values in a wider credential context (``pwd``,
``passphrase``, ``auth`` ..., quoted or not) and asks how many guesses an
attacker needs: dynamic programming over the value's prefixes picks the
cheapest segmentation into words, dates, repeats, keyboard walks and
brute-force spans. A value that is expensive to guess is a secret.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
BASE = {
    "assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    # a run of the class is as long as it can be, so asking for the least
    # length in the pattern drops the same matches as a test behind it
    "access": (re.compile(r"AKIA[A-Z0-9]{16,}"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
#: The keyword may stand anywhere in a name (``DB_PWD``, ``dbPassword``,
#: ``aws_secret_access_key``, ``auth_token_v2``); short ones not behind a
#: letter (compass), and none before one (secretary).
CONTEXT = re.compile(
    r"""(?ai)(?:pass(?:word|wd|phrase|code)|pwd|secret|token|(?<![a-z])(?:pass|auth|credential|(?:api|access|private|secret)[_-]?key))s?"""
    r"""(?![a-z])[\w.-]{0,255}["']?[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>]+))""")
#: A value is a secret from this many guesses (as a power of ten) on, if it
#: has this many characters of at least two classes.
LEAST_COST = 8.0
LEAST_CHARS = 8

# Common words of passwords, by rank.
WORDS = """password admin welcome login letmein master dragon monkey qwerty abc secret shadow sunshine princess
football baseball superman batman trustno iloveyou hello freedom whatever love money summer winter spring autumn
test testing guest user root default changeme temp server access system manager office computer internet
example sample dummy placeholder your key token value none null true false company house family friend
michael jordan daniel thomas george charlie robert jessica ashley michelle andrew matthew jennifer hunter
killer soccer hockey ranger tigger cookie banana orange purple silver golden diamond flower angel lucky
star magic power ninja matrix phoenix eagle tiger lion horse snake wolf bear apple google phone home""".split()
RANKS = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
# Runs of neighbouring keys.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "1qaz2wsx3edc4rfv5tgb6yhn7ujm")
SWAPPED = str.maketrans("@4310$57!", "aaeiosstl")
STEPS = {a + b for w in WALKS for a, b in (*zip(w, w[1:]), *zip(w[::-1], w[::-1][1:]))}
DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/.]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
REPEAT = re.compile(r"(.{1,8}?)\1+", re.S)


def _class_size(c: str) -> int:
    if c.isascii():
        return 10 if c.isdigit() else 26 if c.isalpha() else 33
    return 100


def guess_cost(value: str) -> float:
    """:func:`cheapest` of a value; short values are remembered."""
    return _remembered(value) if len(value) <= 64 else cheapest(value)


@lru_cache(20_000)
def _remembered(value: str) -> float:
    return cheapest(value)


def cheapest(value: str) -> float:
    """Power of ten of the guesses that the cheapest segmentation needs.

    A segment costs the logarithm of its choices: a word its rank (twice for
    capitals, twice for swapped characters), a date the days of 130 years, a
    repeat its unit and count, a walk its start and length, a brute-force span
    the classes of its characters. Each segment but the first doubles the
    guesses, for its place."""
    n = len(value)
    low = value.lower()
    plain = low.translate(SWAPPED)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # end -> (start, cost)
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            rank = RANKS.get(low[i:j])
            swapped = rank is None
            rank = rank or RANKS.get(plain[i:j])
            if rank:
                ends[j].append((i, math.log10(rank * (1 + (value[i:j] != low[i:j])) * (1 + swapped) + 1)))
        if (m := DATE.match(value, i)):
            full = m.end() - i > 4
            ends[m.end()].append((i, math.log10(130 * 365 if full else 130)))
        if i == 0 or low[i - 1: i + 1] not in STEPS:
            j = i + 1
            while j < n and low[j - 1: j + 1] in STEPS:
                j += 1
                if j - i >= 3:
                    ends[j].append((i, math.log10(47 * (j - i) * 2)))
    for m in REPEAT.finditer(value):
        unit = m[1]
        if m.end() - m.start() >= 3:
            ends[m.end()].append((m.start(), sum(math.log10(_class_size(c)) for c in unit)
                                  + math.log10((m.end() - m.start()) // len(unit))))
    best = [0.0] + [math.inf] * n
    brute = [False] * (n + 1)  # the cheapest way to here ends with a brute-force character
    for j in range(1, n + 1):
        joint = 0.0 if j == 1 or brute[j - 1] else math.log10(2)
        best[j], brute[j] = best[j - 1] + math.log10(_class_size(value[j - 1])) + joint, True
        for i, cost in ends[j]:
            if (whole := best[i] + cost + (math.log10(2) if i else 0)) < best[j]:
                best[j], brute[j] = whole, False
    return best[n]


def _classes(value: str) -> int:
    return (any(c.isdigit() for c in value) + any(c.islower() for c in value) + any(c.isupper() for c in value)
            + any(not c.isalnum() for c in value))


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets in a text, by start, then by kind."""
    found = [(m.start(), m.end(), kind) for kind, (pattern, group, least) in BASE.items()
             for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    base = sorted(found)
    for m in CONTEXT.finditer(text):
        group = next(g for g in (1, 2, 3) if m[g] is not None)
        start, end = m.span(group)
        if group == 3:  # punctuation behind a bare value is the sentence's
            end = start + len(m[3].rstrip(".,;:!?)]}"))
        value = text[start:end]
        if (len(value) >= LEAST_CHARS and not any(a <= start and end <= b for a, b, _ in base)
                and _classes(value) >= 2 and guess_cost(value) >= LEAST_COST):
            found.append((start, end, "guess"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scanned(batches):
    for batch in batches:
        out = [[] for _ in range(5)]
        for text in batch.column(1).to_pylist():
            spans = scan(text or "")
            base = [s for s in spans if s[2] != "guess"]
            kinds = [s[2] for s in base]
            for col, v in zip(out, (kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                                    sha256(_joined(base).encode()).hexdigest(), _joined(spans))):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), *(pa.array(c, pa.string()) for c in out[3:])],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of secrets in each whole text: doc_id, n_assign, n_access, n_hex,
    base_sha256 and spans.

    A span is ``kind:start:end`` in code points, end exclusive, of the whole
    match (for ``guess``: of the value). Spans go by start, then kind (assign,
    access, hex, guess); base_sha256 is of the base kinds alone. Null and empty
    texts have no spans. Repeated rows are scanned alike; other columns are
    ignored; no documents give no rows."""
    kind = dict(docs.dtypes)[doc_id]
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(_scanned, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))


def _masked(batches, mark: str = "[secret]"):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, text in enumerate(texts):
            spans = scan(text or "")
            if spans:
                parts, at = [], 0
                for start, end, _ in spans:
                    if end > at:
                        if start >= at:
                            parts += [text[at:start], mark]
                        at = end
                texts[i] = "".join(parts) + text[at:]
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by ``[secret]`` (overlapping
    spans by one mark) and n_chars counted anew; same columns and rows."""
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return (docs.mapInArrow(_masked, schema)
            .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns))
