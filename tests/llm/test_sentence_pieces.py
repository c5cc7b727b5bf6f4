import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = " \n\tabethinorsT.01" + "".join(map(chr, (0xE9, 0x301, 0x3000, 0x4E2D, 0x1F600, 0xA0)))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return sp.Pieces(PATH)


def ids(model, text):
    return np.frombuffer(model.encode(text), "<u4").tolist()


def test_equals_library(model, library):
    @settings(max_examples=2000, deadline=None)
    @given(st.text(alphabet=ALPHABET, max_size=60))
    def run(text):
        assert ids(model, text) == library.encode(text)
        assert model.decode(model.encode(text)) == text

    run()


def test_runs_of_one_character(model, library):
    for unit in (" ", "a", "\n", "in", "  x", "the", "=", "-"):
        for n in (1, 2, 3, 15, 16, 17, 31, 33, 200):
            assert ids(model, unit * n) == library.encode(unit * n), (unit, n)


def test_long_parts_of_pairs_in_no_piece(model, library):
    """Long runs without a space where hardly any two neighbours share a piece: digits and CJK paragraphs."""
    digits = "".join(str(i * 7919 % 10007) for i in range(13_000))[:50_000]
    ideographs = "".join(chr(0x4E00 + i * 7919 % 20_000) for i in range(50_000))
    for text in (digits, "0" * 50_000, "12" * 25_000, "zq" * 25_000, ideographs, "abc" + ideographs + "the" + digits):
        assert ids(model, text) == library.encode(text)


def test_parts_together_and_alone(model, library, small):
    """New parts of many texts are searched as arrays, one part at a time otherwise; the pieces are the same."""
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{small}/documents.parquet'").fetchall()]
    parts = sorted({p for t in texts for p in model.parts.findall(sp.BAR + t.replace(" ", sp.BAR))})
    grid = sp.Pieces(PATH).grid
    together = [p for p in parts if len(p) <= sp.WIDTH and grid.covers(p)]
    assert len(together) > 5_000
    assert grid.search(together) == [model._part(p) for p in together]
    few = sp.Pieces(PATH)
    odd = ["", None, "a", texts[0], "\u4e2d" * 70 + " x", "y" * 200, texts[1]]
    assert [np.frombuffer(i, "<u4").tolist() for i in few.encode_all(odd)] == [library.encode(t or "") for t in odd]


def test_memory_is_bounded(library, small, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 2_000)
    monkeypatch.setattr(sp, "AT_ONCE", 5_000)
    model = sp.Pieces(PATH)
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{small}/documents.parquet' LIMIT 150").fetchall()]
    for text, found in zip(texts, model.encode_all(texts)):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text)
        assert len(model.older) < 8_000 and len(model.known) < 8_000


def test_window_stays_small(model, library):
    """Ids come out long before the end of a text without a single space, and are the same whenever they are looked for."""
    text = "internationalization" * 500
    whole = list(model.stream(text))
    assert whole == list(model.stream(text, look=1)) == list(model.stream(text, look=10**9))
    read = 0

    class Watched(str):
        def __getitem__(self, key):
            nonlocal read
            read = max(read, key.stop)
            return str.__getitem__(self, key)

    ahead, out = 0, 0
    for piece in model.stream(Watched(text)):
        out += len(piece)
        ahead = max(ahead, read - out)
    assert ahead <= 3 * sp.LOOK


def test_documents(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in sp.digests(docs, PATH).collect():
        want = np.array(library.encode(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_crc32) == (len(want) // 4, zlib.crc32(want))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_rows_of_any_kind(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (2, "", 0), (None, "x" * 30_000, 0)], "doc_id bigint, text string, ids int")
    rows = sp.digests(docs, PATH).collect()
    assert sorted((r.doc_id or 0, r.decoded_chars) for r in rows) == [(0, 30_000), (1, 0), (2, 0), (2, 0)]
    back = {(r.doc_id or 0, r.text) for r in sp.decoded(sp.encoded(docs, PATH), PATH).collect()}
    assert back == {(0, "x" * 30_000), (1, ""), (2, "")}
    assert sp.digests(docs.where("false"), PATH).count() == 0
