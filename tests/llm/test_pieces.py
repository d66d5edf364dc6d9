"""Piece encoding, decoding and token counts against the library itself."""

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tidebar.llm import token_counts as module
from tidebar.llm import units
from tidebar.llm.pieces import Encoder, decode, decode_ids, encode, vocabulary
from tidebar.llm.queries import op3_sentencepiece, op8_token_counts
from tidebar.llm.token_counts import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " ", "  ", "a ", "  a", "\t\n x", "▁", "a▁b", "日本 語𝄞x", "\x00", "<s> </s><0x41> <unk>",
    "é" * 300, "ab" * 900, " " * 100, "a" * 5000, "x  y   z    ", "ÿþ﻿", "a", "a", "Ⅷ" * 40, "12345678901",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(units, "SLICE", 300)
    monkeypatch.setattr(units, "FRESH", 40)
    monkeypatch.setattr(units, "KEEP", 12)


def coded(encoder, texts):
    return [ids for _, part in encoder.slices(texts) for ids in part.to_pylist()]


def test_encode_is_the_librarys(library):
    want = [library.encode(t or "") for t in ODD]
    encoder = Encoder(vocabulary(MODEL))
    assert coded(encoder, pa.array(ODD)) == want
    assert coded(encoder, pa.array(ODD[::-1]).slice(3, 9)) == want[::-1][3:12]


def test_encode_over_many_slices(library, small_slices):
    texts = ODD + [f"w{i % 7} {i} über" for i in range(200)]
    got = coded(Encoder(vocabulary(MODEL)), pa.array(texts))
    assert got == [library.encode(t or "") for t in texts]


def test_decode_undoes_encode_and_takes_odd_ids(library):
    ids = pa.array([library.encode(t or "") for t in ODD], pa.list_(pa.int32()))
    got = decode_ids(vocabulary(MODEL), ids).to_pylist()
    assert got == [(t or "").replace("▁", " ") for t in ODD]
    odd = pa.array([None, [], [None, 99999, -1], [1, 2], [259 - 256 + 0xC3]], pa.list_(pa.int32()))
    assert decode_ids(vocabulary(MODEL), odd.slice(0)).to_pylist() == [None, "", "⁇  ⁇  ⁇ ", "", "�"]


def test_whole_table(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op3_sentencepiece(spark, SF).collect():
        assert r.token_ids == library.encode(docs[r.doc_id] or "")
        assert r.n_tokens == len(r.token_ids) and r.round_trip
    counts = {r.doc_id: r for r in op8_token_counts(spark, SF).collect()}
    assert len(counts) == len(docs)
    for key, text in docs.items():
        n = len(library.encode(text or ""))
        want = (key, len((text or "").encode()), n, n > 4096)
        assert tuple(counts[key]) == want


def test_other_columns_stay_and_clashing_ones_go(spark):
    df = spark.createDataFrame([(1, "a b", "x", [9])], "`doc.id` int, text string, decoded string, token_ids array<int>")
    out = decode(encode(df, MODEL), MODEL)
    assert out.columns == ["doc.id", "text", "token_ids", "decoded"]
    assert out.first()[3] == "a b"
    assert encode(df.limit(0), MODEL).count() == 0


def test_whole_texts_are_encoded_where_words_depend_on_each_other(spark, library, tmp_path, monkeypatch):
    assert module.apart(MODEL)
    monkeypatch.setattr(library.__class__, "normalize", lambda self, text: " ".join(text.split()))
    module.apart.cache_clear()
    assert not module.apart(MODEL)
    batch = pa.record_batch([pa.array([b"x"] * len(ODD)), pa.array([t or "" for t in ODD])], names=["digest", "text"])
    got = next(module._counter(MODEL)(iter([batch])))
    module.apart.cache_clear()
    assert got.column(1).to_pylist() == [len(library.encode(t or "")) for t in ODD]


def test_counts_come_from_the_cache(spark, library, tmp_path):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, "a", 7), (0, "a b", 7)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_tokens int").repartition(3)
    cache = str(tmp_path)

    def run(df):
        return sorted(map(tuple, token_counts(df, MODEL, cache, limit=9).collect()), key=repr)

    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in rows]
    want = sorted(((*w, w[2] > 9) for w in want), key=repr)
    assert run(df) == want
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == len({(t or "").replace("▁", " ") for _, t, _ in rows})
    assert run(df) == want and spark.read.parquet(cache).count() == n
    more = df.unionByName(spark.createDataFrame([(99, "new text", 1)], df.schema))
    assert len(run(more)) == len(rows) + 1 and spark.read.parquet(cache).count() == n + 1
    assert run(df.limit(0)) == []
