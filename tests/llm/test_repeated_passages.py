"""Substring dedup against counting every window."""
import random
import re
from collections import Counter
from hashlib import sha256

import pytest

from posetide.llm import repeated_passages as rp

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out, left = [], []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        left.append(kept)
        out.append((d, len(w), len(gone), sha256(" ".join(kept).encode()).hexdigest()))
    return Counter(out), left


def check(df):
    got = Counter((g.doc_id, g.n_words, g.n_removed, g.kept_sha256) for g in rp.removals(df).collect())
    want, left = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert got == want
    return left


@pytest.mark.parametrize("case", ["given", "hard", "none"])
def test_every_window(tables, case):
    check(tables[case])


def planted(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    some = lambda n: r.choices(words, k=n)
    passages = [some(n) for n in (34, 35, 36, 50, 90, 200)]
    docs = []
    for _ in range(60):
        d = some(r.randrange(0, 80))
        for _ in range(r.randrange(0, 3)):
            p = r.choice(passages)
            a = r.randrange(0, 10)
            d += p[a: len(p) - r.randrange(0, 10)] + some(r.randrange(0, 50))
        docs.append(d)
    docs += [["x"] * 100, ["a", "b"] * 60, docs[0], docs[0], passages[5] * 2]
    return [(i, "  ".join(d) + "\n", "s") for i, d in enumerate(docs)]


@pytest.mark.parametrize("most", [4000, 2])
def test_planted_passages(spark, monkeypatch, most):
    monkeypatch.setattr(rp.repeated_spans, "__defaults__", ("text", 35, most))  # automata, or single windows
    for seed in (1, 2):
        df = spark.createDataFrame(planted(seed), "doc_id long, text string, _spans string")
        left = check(df)
        assert any(left)


def test_shortened_texts(spark, hard):
    rows = planted(3)
    df = spark.createDataFrame([(i, t, 0) for i, t, _ in rows], "doc_id long, text string, n_chars long")
    _, left = brute([(i, t) for i, t, _ in rows])
    for g in rp.without_repeats(df).collect():
        assert WORD.findall(g.text) == left[g.doc_id] and g.n_chars == len(g.text)
    got = rp.without_repeats(hard)
    assert got.columns == hard.columns and got.count() == hard.count()


def test_automaton():
    r = random.Random(7)
    for _ in range(60):
        texts = [([r.choice("abc") for _ in range(r.randrange(1, 25))], r.randrange(1, 3)) for _ in range(r.randrange(1, 5))]
        a = rp.Automaton()
        for t, k in texts:
            a.add(t, k)
        a.close()
        seen = Counter()
        for t, k in texts:
            for i in range(len(t)):
                for j in range(i + 1, len(t) + 1):
                    seen[tuple(t[i:j])] += k
        probe = [r.choice("abcd") for _ in range(30)]
        want = [max(n for n in range(i + 2) if n == 0 or seen[tuple(probe[i + 1 - n: i + 1])] >= 2) for i in range(30)]
        assert list(a.statistics(probe)) == want


def test_covered_is_the_union_of_matches():
    assert rp.covered([1, 2, 3, 1, 2, 3, 4, 1], 3) == [(0, 7)]
    assert rp.covered([1, 2, 3, 0, 0, 1, 2, 3], 3) == [(0, 3), (5, 3)]
