"""Masked pseudo-likelihood: gradients, sums and held-out texts."""
import math
import random
from collections import Counter

import numpy as np
import pytest

from posetide.llm import masked_lm as lm


def small_net():
    net = lm.Network(unigram=np.full(lm.CLASSES, 1 / lm.CLASSES))
    r = np.random.default_rng(1)
    net.flat += r.normal(0, 0.2, len(net.flat)).astype(np.float32)
    return net, r


def test_gradient_is_that_of_the_loss():
    net, r = small_net()
    context, target = r.integers(0, lm.CLASSES + 1, (40, 4)), r.integers(0, lm.CLASSES, 40)
    g = net.gradient(context, target)
    for i in [*r.integers(0, len(g), 20), len(g) - 1, net.sizes[0] + 2, net.sizes[0] + net.sizes[1] + 5]:
        kept, ends = net.flat[i], []
        for step in (1e-2, -1e-2):
            net.flat[i] = kept + step
            ends.append(-net.log_probabilities(context, target).astype(np.float64).mean())
        net.flat[i] = kept
        assert abs((ends[0] - ends[1]) / 2e-2 - g[i]) < 2e-3


def test_context_is_both_sides_without_the_token():
    c = lm.contexts(np.array([5, 6, 7, 8]))
    out = lm.CLASSES
    assert c.tolist() == [[out, out, 6, 7], [out, 5, 7, 8], [5, 6, 8, out], [6, 7, out, out]]


def test_sum_by_hand():
    net, r = small_net()
    counts = r.integers(0, 50, lm.BUCKETS)
    classes, share = lm.classes_of(counts)
    assert abs(sum(math.exp(s) for s, c in zip(share, classes) if c == 3) - 1) < 1e-9
    words = [b"the", b"cat", b"sat", b"the", b"mat"]
    want = 0.0
    for i, w in enumerate(words):
        around = [int(classes[lm.buckets([words[j]])[0]]) if 0 <= j < 5 else lm.CLASSES for j in (i - 2, i - 1, i + 1, i + 2)]
        h = np.tanh(net.bias + sum(net.table[k][a] for k, a in enumerate(around)))
        z = (h @ net.out + net.base).astype(np.float64)
        b = int(lm.buckets([w])[0])
        want += z[classes[b]] - math.log(np.exp(z).sum()) + share[b]
    assert abs(lm.log_likelihood(net, classes, share, words) - want) < 1e-4


@pytest.mark.parametrize("case", ["given", "hard", "none"])
def test_every_document_is_scored(tables, case):
    got = lm.scores(tables[case], rounds=1).collect()
    src = tables[case].collect()
    assert Counter((g.doc_id, g.n_tokens) for g in got) == Counter((d.doc_id, len((d.text or "").encode().split())) for d in src)
    for g in got:
        assert (g.score is None) == (g.n_tokens == 0) and g.log_likelihood <= 0


def test_held_out_texts_beat_shuffled_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    texts = [r.text for r in docs.select("text").collect() if r.text and len(r.text) > 400]
    r = random.Random(2)
    r.shuffle(texts)
    train, held = texts[100:], texts[:100]
    df = spark.createDataFrame([(t,) for t in train], "text string").repartition(3)
    weights, classes, share = lm.train(df)
    net, plain = lm.Network(weights), lm.Network(unigram=np.bincount(classes, lm.corpus_counts(df) + 1.0, lm.CLASSES) / (lm.corpus_counts(df) + 1).sum())
    plain.out[:] = 0  # classes by their counts alone
    true, mixed, unigram = 0.0, 0.0, 0.0
    for t in held:
        words = t.encode().split()
        other = words[:]
        r.shuffle(other)
        true += lm.log_likelihood(net, classes, share, words)
        mixed += lm.log_likelihood(net, classes, share, other)
        unigram += lm.log_likelihood(plain, classes, share, words)
    assert true > mixed and true > unigram
