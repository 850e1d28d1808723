"""Online runs against trying every period."""
import random
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import pytest

from posetide.llm import queries
from posetide.llm import word_runs as wr


def brute(w, least=24, times=3):
    n, out = len(w), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if w[i] == w[i + p]:
                j = i
                while j + p < n and w[j] == w[j + p]:
                    j += 1
                if j + p - i >= max(least, times * p):
                    out.setdefault((i, j + p), p)
                i = j
            i += 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def sequence(r):
    n, k, w = r.randrange(0, 300), r.choice([1, 2, 3, 50]), []
    while len(w) < n:
        c = r.random()
        if c < .4 or not w:
            w += [r.randrange(k) for _ in range(r.randrange(1, 30))]
        elif c < .8:
            u = [r.randrange(k) for _ in range(r.randrange(1, 40))]
            w += u * r.randrange(1, 7) + u[:r.randrange(0, len(u) + 1)]
        else:
            a = r.randrange(len(w))
            w += w[a:a + r.randrange(1, 200)] * r.randrange(1, 4)
    return [b"%d" % x for x in w]


@pytest.mark.parametrize("least,times", [(24, 3), (2, 2), (4, 2), (6, 3), (10, 4)])
def test_runs_whole_and_word_by_word(least, times):
    r = random.Random(least * times)
    for _ in range(60):
        w = sequence(r)
        want = brute(w, least, times)
        assert wr.word_runs(w, least, times) == want
        online, ids, i = wr.RunCatcher(least, times), wr.HASHES.of(w), 0
        while i < len(ids):
            k = r.choice([1, 1, 3, 40])
            online.append(ids[i:i + k])
            i += k
            if r.random() < .05:
                assert online.runs() == brute(w[:i], least, times)
        assert online.runs() == want


def test_long_periodic_texts_stay_cheap():
    assert wr.word_runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    w = ([b"a"] * 100 + [b"b"]) * 300
    assert wr.word_runs(w)[:2] == [(0, 100, 1), (0, 30_300, 101)]


def check(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "documents", lambda *_: df)
    got = Counter(tuple(r) for r in queries.QUERIES["op13_word_runs"](spark, "").select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    want = Counter()
    for d, text in df.select("doc_id", "text").collect():
        w = (text or "").encode().split()
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 3000:
            continue
        runs = brute(w)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        want[(d, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
              sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest(),
              sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())] += 1
    assert not want - got
    assert sum(got.values()) == df.count()
    return want


@pytest.mark.parametrize("case", ["given", "hard", "none"])
def test_query(spark, tables, case, monkeypatch):
    check(spark, tables[case], monkeypatch)


def test_planted_and_extra_columns(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k % 9}" for k in range(90)) if i % 2 else f"x{i} " * 40, "a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words string")
    assert sum(n for x, n in check(spark, df, monkeypatch).items() if x[1]) >= 36
    out = wr.periodic_runs(df)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert out.where("doc_id = 3").first().collapsed == " ".join(f"w{k}" for k in range(9))
