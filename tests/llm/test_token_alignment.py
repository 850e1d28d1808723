"""Alignments against common ends found one by one, counts against a Counter."""
import json
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from posetide.llm import queries
from posetide.llm import token_alignment as ta

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    with open(A, encoding="utf-8") as f:
        vocabulary = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    alphabet = ta.byte_alphabet()
    assert sorted(alphabet.values()) == list(range(256))

    def piece(i):
        got = re.fullmatch("<0x([0-9A-F]{2})>", sp.id_to_piece(i))
        return bytes([int(got[1], 16)]) if got else sp.id_to_piece(i).replace("▁", " ").encode()

    out, links = [], []
    counts = Counter()
    for d, text in rows:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        bytes_a, bytes_b = [bytes(alphabet[c] for c in vocabulary[i]) for i in a], [piece(i) for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            out.append((d, 0, 0, ""))
            links.append([])
            continue
        ends = [], []
        for side, tokens in zip(ends, (bytes_a, bytes_b)):
            at = 0
            for t in tokens:
                at += len(t)
                side.append(at)
        groups, pairs, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            pairs.append((a[x - 1], b[y - 1]))
            i, j = x, y
        counts.update(pairs)
        links.append(pairs)
        out.append((d, len(a), len(b), ";".join(groups)))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return Counter(
        (d, n_a, n_b, len(p), len(p), sum(counts[x] == most[x[1]] for x in p), sum(counts[x] for x in p),
         sha256(g.encode()).hexdigest() if g else "") for (d, n_a, n_b, g), p in zip(out, links))


def check(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "documents", lambda *_: df)
    got = Counter(tuple(r) for r in queries.QUERIES["op12_diagonal_alignment"](spark, "").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("case", ["given", "hard", "none"])
def test_query(spark, tables, case, monkeypatch):
    check(spark, tables[case], monkeypatch)


def test_small_blocks_and_cut_texts_change_nothing(spark, hard, monkeypatch):
    # the module's values in the workers: set them where the functions run
    texts = [r.text for r in hard.collect()]
    whole = ta.Aligner(A, B).batch(texts)
    monkeypatch.setattr(ta, "AT_ONCE", 50)
    cut = ta.Aligner(A, B).batch(texts)
    assert [x[:3] for x in whole] == [x[:3] for x in cut]
    assert all((x[k] == y[k]).all() for x, y in zip(whole, cut) for k in (3, 4))
    check(spark, hard.repartition(7), monkeypatch)


def test_diagonals():
    r = random.Random(3)
    for _ in range(300):
        n = r.randrange(1, 80)
        share = r.choice([.1, .5, .9, 1])
        a = [x for x in range(1, n) if r.random() < share] + [n]
        b = [x for x in range(1, n) if r.random() < r.choice([.1, share])] + [n]
        both = sorted(set(a) & set(b))
        got = ta.diagonal_cuts(np.array(a), np.array(b))
        assert [x.tolist() for x in got] == [[a.index(x) + 1 for x in both], [b.index(x) + 1 for x in both]]


def test_quick_ids_are_the_tokenizers_own():
    side = ta.ByteTokens(A)
    assert side.quick and side.lossless
    r = random.Random(5)
    signs = [*map(chr, range(0x250)), *" '  \n\t", "'s", "'ll", " the", "ing", "<|endoftext|>", "don't", "\u00a0", "\x85"]
    texts = ["".join(r.choices(signs, k=r.randrange(0, 60))) for _ in range(3000)]
    texts += ["".join(r.choices("abc de'", k=500)) for _ in range(50)] + ["ab" * 6000, "\u4e2d\u6587 \u2581 \U0001F600"]
    quick = side.encode(texts)
    side.quick = None
    assert all((x == y).all() if len(x) == len(y) else False for x, y in zip(quick, side.encode(texts)))


def test_dealt_blocks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ta, "BLOCK_LINKS", 3)
    rows = [[1, 2], [3], [], [4, 5, 6, 7], [8], []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(rows, pa.list_(pa.int64()))], names=["i", "links"])
    parts = [b.column(1).to_pylist() for b in ta._dealt([batch], 1)]
    assert sum(parts, []) == rows and all(len(p) == 1 or sum(map(len, p)) <= 3 for p in parts)


def test_shared_columns(spark):
    df = spark.createDataFrame([(1, "a tale of two", "x")], "doc_id long, text string, n_links string")
    out = ta.link_counts(ta.alignments(df, A, B))
    assert out.columns == ["doc_id", "n_a", "n_b", "groups", "n_links", "n_best", "count_sum"]
