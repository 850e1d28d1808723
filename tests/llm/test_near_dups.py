"""Near-duplicates against all pairs on small tables."""
import random
import re
from collections import Counter, defaultdict

import pytest

from posetide.llm import near_dups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = WORD.findall(low)
    return set(zip(w, w[1:], w[2:])) if len(w) >= 3 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        least = min((x for x in groups[find(i)] if x is not None), default=None)
        c = least if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return Counter(out)


def check(df):
    got = Counter((g.doc_id, g.n_shingles, g.component_id, g.kept) for g in near_dups.near_duplicates(df).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    return got


@pytest.mark.parametrize("case", ["given", "hard", "none"])
def test_all_pairs(tables, case):
    check(tables[case])


def edits(r, base, n, words):
    out = list(base)
    for _ in range(n):
        out[r.randrange(len(out))] = r.choice(words)
    return out


def planted(seed):
    """A group of near copies, some beyond reach of the others; documents that
    share one passage; a chain; pairs at the limit."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    base = r.choices(words, k=150)
    docs = [edits(r, base, r.choice([0, 1, 2, 3, 4, 5, 8, 20]), words) for _ in range(60)]
    passage = r.choices(words, k=40)
    docs += [passage + r.choices(words, k=r.choice([2, 6, 20, 60])) for _ in range(40)]
    step = r.choices(words, k=120)
    for i in range(12):
        step = edits(r, step, 2, words)
        docs.append(step)
    for n in (3, 4, 8, 20, 31, 33, 34, 40):
        a = r.choices(words, k=n)
        docs += [a, a + [r.choice(words)], [r.choice(words)] + a, a[:-1]]
    r.shuffle(docs)
    return [(i, " ".join(d), "x") for i, d in enumerate(docs)]


@pytest.mark.parametrize("long", [100, 5])
def test_planted_groups(spark, monkeypatch, long):
    monkeypatch.setattr(near_dups, "LONG", long)  # short lists and long ones give the same groups
    for seed in (1, 2):
        check(spark.createDataFrame(planted(seed), "doc_id long, text string, a string"))


def contained(copies):
    """Two families of near copies, the second with a passage more, of whose
    least hashes at least eight are the passage's own."""
    words = [f"w{i}" for i in range(5000)]
    for seed in range(1000):
        r = random.Random(seed)
        a = r.choices(words, k=300)
        b = a + r.choices(words, k=45)
        least = lambda t: near_dups.shingle_set(" ".join(t).encode())[:near_dups.LISTED].tolist()
        if len(set(least(b)) - set(least(a))) >= 9:
            break
    docs = [(i * copies + k, " ".join([*x, f"own{i}x{k}"])) for i, x in enumerate((a, b)) for k in range(copies)]
    return [(i, t, "x") for i, t in docs]


@pytest.mark.parametrize("long, copies", [(100, 110), (5, 12)])
def test_contained_families(spark, monkeypatch, long, copies):
    monkeypatch.setattr(near_dups, "LONG", long)
    got = check(spark.createDataFrame(contained(copies), "doc_id long, text string, a string"))
    assert {g[2] for g in got} == {0}


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    got = {c.node: c.comp for c in near_dups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def test_one_row_of_each_group_stays(hard):
    got = near_dups.without_near_duplicates(hard).collect()
    kept = {g.doc_id for g in near_dups.near_duplicates(hard).where("kept").collect()}
    assert Counter(g.doc_id for g in got) == Counter(kept) and got[0].asDict().keys() == set(hard.columns)


def test_null_and_repeated_ids_drop_no_other_text(spark):
    r = random.Random(6)
    own = [" ".join(f"w{r.randrange(9000)}" for _ in range(60)) for _ in range(8)]
    a, b, c, d, e, f, g, h = own
    rows = [(None, a), (None, a), (None, b), (None, c + " tail"), (1, c),  # null ids: own texts, and a copy of id 1
            (7, d), (7, e), (7, e), (7, f), (2, f + " tail"), (3, g), (9, g), (9, h), (4, None), (4, ""), (None, None)]
    got = near_dups.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = Counter((x.doc_id, x.text) for x in got if x.text)
    assert texts == Counter([(None, a), (None, b), (1, c), (7, d), (7, e), (2, f + " tail"), (3, g), (9, h)])


@pytest.mark.parametrize("own", [130, 30])
def test_pages_of_one_template_are_not_compared_pair_by_pair(spark, monkeypatch, own):
    """Pages that share a template and are not alike (0.43 and 0.77): what is
    compared grows with the pages, not with their square."""
    compared = {}
    for n in (130, 390):
        r = random.Random(own)
        template = [f"t{i}" for i in range(200)]
        rows = [(i, " ".join(template + [f"w{r.randrange(10**6)}" for _ in range(own)])) for i in range(n)]
        rows += [(n, rows[0][1] + " tail"), (n + 1, rows[1][1] + " end")]
        sizes = Counter()

        def counted(df, name, old=near_dups.stored):
            out = old(df, name)
            if name in ("candidates", "clusters"):
                sizes[name] += out.count()
            return out

        with monkeypatch.context() as m:
            m.setattr(near_dups, "stored", counted)
            got = {g.doc_id: g.component_id for g in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {i: i for i in range(n)} | {n: 0, n + 1: 1}
        assert sizes["clusters"] <= n + 2
        compared[n] = sizes["candidates"]
    assert compared[390] <= 4 * compared[130] and compared[390] <= 16 * 392
