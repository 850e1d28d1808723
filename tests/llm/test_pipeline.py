"""The pipeline against its stages by brute force, and its contract."""
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from test_near_dups import brute as near_brute
from test_repeated_passages import brute as passages_brute
from test_simple_ops import base_stats
from tokenizers import Tokenizer

import corpus_pipeline
from posetide.llm import quality_lines as ql
from posetide.llm import secret_scan


def quality_brute(docs):
    """docs: (doc_id, text, host) -> kept ones without boilerplate lines."""
    prints, holders, hosts = {}, defaultdict(set), defaultdict(set)
    lines = lambda t: {ql.line_key(x) for x in t.encode().split(b"\n") if x.split()}
    for i, (_, text, host) in enumerate(docs):
        if (text or "").split():
            prints[i] = ql.profile(text.encode())[5]
            hosts[host].add(prints[i])
            for x in lines(text):
                holders[host, x].add(prints[i])
    limit = {k for k, v in holders.items() if len(v) >= ql.MIN_DOCUMENTS and len(v) >= ql.MIN_SHARE * len(hosts[k[0]])}
    out = []
    for d, text, host in docs:
        text = text or ""
        n, _, _, _, again = base_stats(text)
        left = [x for x in text.split("\n") if (host, ql.line_key(x.encode())) not in limit]
        rest = "\n".join(left)
        if n >= 50 and 100 * again <= 50 * n and len(rest.encode().split()) >= ql.MIN_LEFT * n:
            out.append((d, rest if len(left) < text.count("\n") + 1 else text))
    return out


def test_pipeline_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    clean = quality_brute(docs)
    kept = {k[0] for k in near_brute(clean) if k[3]}
    clean = [x for x in clean if x[0] in kept]
    _, left = passages_brute(clean)
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = defaultdict(list)
    for g in corpus_pipeline.run(spark, sf).collect():
        got[g.doc_id].append(g)
    assert set(got) == {d for d, _ in clean}
    for (d, _), words in zip(clean, left):
        text = " ".join(words)
        spans = secret_scan.scan(text)
        for a, b, _ in reversed([s for i, s in enumerate(spans) if not any(t[1] > s[0] for t in spans[:i])]):
            end = max(t[1] for t in spans if t[0] < b and t[1] > a)
            text = text[:a] + "[secret]" + text[end:]
        ids = tok.encode(text, add_special_tokens=False).ids + [1]
        pieces = sorted(got[d], key=lambda g: g.start)
        at = 0
        for g in pieces:
            part = np.array(ids[at: at + g.length], "<u4")
            assert g.start == at and g.doc_tokens == len(ids) and g.ids_crc32 == zlib.crc32(part.tobytes())
            at += g.length
        assert at == len(ids)


def test_stages_keep_their_columns(spark, hard, empty):
    for docs in (hard, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert len(corpus_pipeline.STAGES) == 5
    assert sys.modules["corpus_pipeline"].ORACLE_SQL is None
