"""Bitmask filters: membership, corrected counts, held-out accuracy."""
import zlib

import numpy as np
import pytest

from posetide.llm import language_filters as lf


def test_letters_and_grams():
    x = lf.letters("Ab1--c É")
    assert "".join(chr(int(c)) if c else " " for c in x) == " ab c é "
    assert len(lf.letters(None)) == len(lf.letters("12 !?")) == 0
    assert len(lf.grams(x, 2)) == len(x) - 1 and len(lf.grams(x[:3], 4)) == 0
    assert len(np.unique(lf.grams(lf.letters("anan"), 2))) == 4     # " a", "an", "na", "n "


def test_parts_lose_no_gram(monkeypatch):
    x = lf.letters("some words that are cut into many small parts")
    whole = np.sort(np.concatenate([lf.grams(x, s) for s in lf.SIZES]))
    monkeypatch.setattr(lf, "PART", 5)
    cut = np.sort(np.concatenate([lf.part_grams(p, s) for p, _ in lf.parts(x) for s in lf.SIZES]))
    assert (whole == cut).all()


@pytest.mark.parametrize("languages", [2, 5, 10, 30])
def test_masks_hold_all_and_false_hits_are_as_predicted(languages):
    r = np.random.default_rng(languages)
    f = lf.Filters([f"l{i:02}" for i in range(languages)], 1 << 14)
    own = {s: r.integers(0, 1 << 63, 2000).astype(np.uint64) for s in range(0, len(f.bits), 2)}
    for s, gram in own.items():
        f.add(s, gram)
    f.close()
    strange = r.integers(0, 1 << 63, 40_000).astype(np.uint64)
    for s, gram in own.items():
        row, bit = f.bits[s]
        assert (f.masks(gram)[row] & bit != 0).all()
        seen = np.count_nonzero(f.masks(strange)[row] & bit) / len(strange)
        assert abs(seen - f.false[s]) < 6 * (f.false[s] / len(strange)) ** .5 + .002
    assert f.false[1] == 0


@pytest.mark.parametrize("case", ["given", "hard", "none"])
def test_every_row_has_a_result(tables, case):
    df = tables[case]
    out = lf.identified(df).collect()
    assert len(out) == df.count()
    text = {}
    for r in df.select("doc_id", "text", "lang").collect():
        text.setdefault(r.doc_id, []).append(r)
    known = {r.lang for rs in text.values() for r in rs if r.lang and r.doc_id is not None}
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in known | {lf.UNKNOWN}
        if len(text[r.doc_id]) == 1:
            t = text[r.doc_id][0].text
            assert (r.lang_pred == lf.UNKNOWN) == (not any(c.isalpha() for c in t or "") or not known)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lf.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 300 and sum(r.lang == r.lang_pred for r in rows) >= .99 * len(rows)


def test_held_out_labels_and_names_play_no_part(spark, docs):
    from pyspark.sql import functions as F
    cols = docs.select("doc_id", "text", F.when(lf.held_out(), F.lit("zz")).otherwise(F.col("lang")).alias("lang"))
    a = {r.doc_id: r.lang_pred for r in lf.identified(cols).collect()}
    b = {r.doc_id: r.lang_pred for r in lf.identified(docs).collect()}
    assert a == b and "zz" not in a.values()


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert lf.identified(df).first().lang_pred == lf.UNKNOWN
    many = spark.createDataFrame([(i, "text", f"l{i}") for i in range(2000)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        lf.learn(many)
