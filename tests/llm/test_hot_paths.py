"""Vectorised inner loops against their plain forms."""
import random

import numpy as np

from posetide.llm import masked_lm as lm
from posetide.llm import piece_encoding as pe
from posetide.llm.queries import tokenizer_path


def test_buckets_do_not_depend_on_blocks(monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choices("abcé中0", k=r.randint(1, 40))).encode() for _ in range(300)] + [b"x" * 500, b"\xff\x00"]
    text = b"".join(r.choice([b" ", b"\n\t ", b"\x0b"]) + w for w in words) + b"  "
    whole = lm.text_buckets(text).tolist()
    assert whole == [int(lm.buckets([w])[0]) for w in words]
    for size in (1, 7, 64, 499):
        monkeypatch.setattr(lm, "BLOCK", size)
        assert lm.text_buckets(text).tolist() == whole
    assert not len(lm.text_buckets(b"")) and not len(lm.text_buckets(b" \n "))


def test_chunks_merged_together_are_as_the_library_has_them(monkeypatch):
    m = pe.Model(tokenizer_path("piece_bpe_32k.model"))
    r = random.Random(4)
    texts = ["", " ", "   ", "\n", "aaaaaaaa" * 5, "é" * 70, "x" * 300, "🙂 \x00 ﷺ", "▁▁ a"]
    texts += ["".join(r.choices("aabetnos  \nüж中🙂1.", k=r.randint(1, 120))) for _ in range(400)]
    for together in (20_000, 1, 3):
        monkeypatch.setattr(pe, "TOGETHER", together)
        m.cache.clear()
        for text, (ids, starts, ends) in zip(texts, m.encode_all(texts), strict=True):
            assert ids.tolist() == m.processor.encode(text)
            assert len(starts) == len(ids) and np.all(starts <= ends)


def test_merging_alone_and_together_agree():
    m = pe.Model(tokenizer_path("piece_bpe_32k.model"))
    r = random.Random(5)
    chunks = ["▁" + "".join(r.choices("etaoinshr", k=r.randint(1, 30))) for _ in range(500)]
    ids, sizes, ends = m.merge_all(chunks)
    for chunk, low, end in zip(chunks, [0, *ends[:-1]], ends, strict=True):
        assert (ids[low:end].tolist(), sizes[low:end].tolist()) == m.chunk_ids(chunk)


def test_plain_chunks_by_rank_agree():
    m = pe.Model(tokenizer_path("piece_bpe_32k.model"))
    assert m.quick
    r = random.Random(6)
    chunks = [pe.SPACE * r.randint(0, 1) + "".join(r.choices("etaoinshrET.,:-0129(){}", k=r.randint(1, 40))) for _ in range(3000)]
    chunks += [p for p in m.ids if pe.is_plain(p)]
    for (ids, sizes, ends), (ids2, sizes2, ends2) in [(m.merge_plain(chunks), m.merge_all(chunks))]:
        assert (ids == ids2).all() and (sizes == sizes2).all() and (ends == ends2).all()


def test_spans_cover_the_pieces(docs):
    m = pe.Model(tokenizer_path("piece_bpe_32k.model"))
    for row in docs.limit(40).collect():
        raw = row.text.encode()
        ids, starts, ends = m.encode(row.text)
        for i, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist()):
            piece = m.processor.id_to_piece(i)
            if not m.processor.is_byte(i):
                assert raw[a:b].decode().replace(" ", pe.SPACE) == (piece[1:] if a == 0 and piece[:1] == pe.SPACE else piece)


def test_texts_by_rank_are_the_tokenizers_own(docs):
    from posetide.llm.slack_packing import WordIds
    table = WordIds(tokenizer_path("word_bpe_49k.json"))
    assert table.merger
    r = random.Random(7)
    texts = [x.text for x in docs.collect()]
    texts += ["".join(r.choices(a, k=r.randint(1, 80))) for a in ("abcdefghijklmnopqrstuvwxyz  ", "aeistßéÀÜ ", "a1.-,$ \n\t", "it's I'LL <|~ %&x ",
                                                                   "aé\u0301 \u00a0\x85\x1c\x02İ日🙂", [chr(c) for c in range(0x180)])
              for _ in range(400)]
    texts += [t[:-4] for t in table.tokenizer.get_vocab() if t.endswith("</w>") and t[:-4].isascii()][::7]
    texts += ["", " ", "ab" * 3000, "don't <|endoftext|> x~y ~ a", "é" * 3000 + " b", "!" * 3000]
    want = [e.ids for e in table.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b, "<u4").tolist() for b in table.of_texts([t.encode() for t in texts])]
    bad = [(t, a, b) for t, a, b in zip(texts, got, want) if a != b]
    assert not bad, bad[:3]
