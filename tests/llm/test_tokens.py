"""Token files and SentencePiece against the libraries."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pieces, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["naïve  café\n\n日本語 text😀 x", "   lead", "a▁b  c", "\n", "\n\nx", "x \ny", "a\tb", "it's we're 12,345.", "word<|endoftext|>x <|ENDOFTEXT|> A", "ÀÉ ß İstanbul Σίσυφος ΣΑΣ", "日本語" * 90, "abcdefgh" * 60, "1234567 89\n 12" * 9, "U.S.A., e.g. 3.5!", "été ,", " nb sp"]


@pytest.fixture(scope="module")
def more(spark, docs):
    rows = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    return docs.select("doc_id", "text").union(rows)


def test_packed():
    r = np.random.default_rng(0)
    for ids in (r.integers(0, 50_000, 5000), r.integers(0, 2**32, 1500, dtype=np.uint64), np.zeros(0), np.array([255, 256, 0])):
        ids = ids.astype(np.uint32)
        p = token_files.Packed(token_files.pack(ids))
        at = r.integers(0, max(1, len(ids)), 300 if len(ids) else 0)
        assert np.array_equal(p.all(), ids) and np.array_equal(p.get(at), ids[at]) and p.count == len(ids)
    with pytest.raises(ValueError):
        token_files.Packed(b"nothing here")


def test_token_files(spark, more, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    path = str(tmp_path / "tokens")
    token_files.write_tokens(more, WORD_BPE, 2, path)
    got = sorted(token_files.read_documents(spark, path, True).collect(), key=lambda r: r["start"])
    t = Tokenizer.from_file(WORD_BPE)
    rows = sorted(((r["doc_id"], r["text"]) for r in more.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (doc_id, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    asked = spark.createDataFrame([(0,), (17,), (start - 1,), (start,)], "position bigint")
    flat = [i for r in got for i in r["ids"]]
    assert {r["position"]: r["token"] for r in token_files.tokens_at(spark, path, asked, 64).collect()} == {p: flat[p] for p in (0, 17, start - 1)}


def test_token_files_of_nothing(spark, empty, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(empty, WORD_BPE, 2, path)
    assert token_files.read_documents(spark, path).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.Model(pieces.model_path())


def scan(model, text, size, whole):
    s = "▁" + text.replace(" ", "▁")
    n = -(-len(s) // size)
    chunks = [pieces.Chunk(model, s[max(0, k * size - 64) : k * size], s[k * size : k * size + size], s[k * size + size : k * size + size + 64], k == 0, k == n - 1) for k in range(n)]
    if whole:
        for c in chunks:
            c.cut = None
    left = right = chunks[0].matrix()
    for c in chunks[1:]:
        left = pieces.combine(left, c.matrix())
    right = chunks[-1].matrix()
    for c in reversed(chunks[:-1]):
        right = pieces.combine(c.matrix(), right)
    assert {e: set(r) for e, r in left.items()} == {e: set(r) for e, r in right.items()}
    ((entry, row),) = left.items()
    states = pieces.between([c.matrix() for c in chunks], entry, max(row, key=row.get))
    return [i for c, a, b in zip(chunks, states, states[1:]) for i in c.trace(a, b)]


@pytest.mark.parametrize("size", [40, 97])
@pytest.mark.parametrize("whole", [False, True])
def test_scan_is_the_library(model, texts, size, whole):
    for text in [*ODD, *[t[:400] for _, t in texts[:6]]]:
        assert scan(model, text, size, whole) == model.sp.encode(text), text[:40]


def test_unigram_scan_is_viterbi(model):
    m = pieces.Model(pieces.model_path())
    m.unigram = True
    text = "hello there wonderful world"
    s, best = "▁" + text.replace(" ", "▁"), [0.0] + [pieces.NONE] * 99
    for i in range(len(s)):
        for p in m.pieces_at(s, i):
            best[i + len(p)] = max(best[i + len(p)], best[i] + m.gain(p))
    ids = scan(m, text, 9, True)
    assert abs(sum(m.sp.get_score(i) for i in ids) - best[len(s)]) < 1e-6


def test_encode_and_decode(spark, more, model, monkeypatch, empty):
    monkeypatch.setattr(pieces, "CHUNK", 256)
    monkeypatch.setattr(pieces, "FAN", 3)
    rows = more.withColumns({"ids": F.lit("x"), "k": F.lit(1)})
    got = pieces.decode(pieces.encode(rows, pieces.model_path()), pieces.model_path()).collect()
    assert len(got) == rows.count()
    for r in got:
        text = r["text"] or ""
        assert r["ids"] == model.sp.encode(text), text[:50]
        assert r["decoded"] == model.sp.decode(model.sp.encode(text)) and r["k"] == 1
    assert pieces.round_trip(empty, pieces.model_path()).count() == 0


def test_decode_of_broken_bytes(spark, model):
    ids = [model.byte[0xE3], 500, 1, 0]
    df = spark.createDataFrame([(ids,), ([],), (None,)], "ids array<int>")
    assert [r["decoded"] for r in pieces.decode(df, pieces.model_path()).collect()] == [model.sp.decode(ids), "", ""]
