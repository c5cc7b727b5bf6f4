from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarmac.llm import encoding, token_files
from tarmac.llm.encoding import RARE, Encoder, encoder

FILES = [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)]
BYTES = public_tokenizers.path(FILES[0][0])
ODD = st.text(alphabet=" \n\t\r\x0b\x0c\x1c\x85" + "".join(map(chr, (0xA0, 0x2003, 0x200B, 0x3000, 0x301, 0x3A3))) + "aBcé's1Σ!<|endoftext|>😀", max_size=40)


@pytest.fixture(scope="module", params=FILES, ids=lambda f: f[0])
def both(request):
    name, drops_space = request.param
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = True
    return whole, Encoder(public_tokenizers.path(name), drops_space)


def test_equals_library(both):
    whole, pieces = both

    @settings(max_examples=1500, deadline=None)
    @given(ODD)
    def run(text):
        assert np.frombuffer(pieces.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    run()


def test_common_space_is_not_rare():
    assert not RARE.search("a b\tc\nd\x0be\x0cf\rgé")


def test_documents(both, spark, small):
    whole, pieces = both
    for row in spark.read.parquet(f"{small}/documents.parquet").select("text").collect():
        assert np.frombuffer(pieces.ids(row.text), "<u4").tolist() == whole.encode(row.text, add_special_tokens=False).ids


def test_every_latin_character(both):
    whole, pieces = both
    for c in map(chr, range(0x21, 0x300)):
        for text in (c, f"a{c}b", f" {c}x,", f"\n{c}.", f"A{c}"):
            assert np.frombuffer(pieces.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


@cache
def whole_tokenizer():
    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    return whole


def library(texts):
    return [e.ids for e in whole_tokenizer().encode_batch(texts, add_special_tokens=False)]


def by_column(pieces, texts):
    return [np.frombuffer(i, "<u4").tolist() for i in pieces.column(texts)]


def test_columns_equal_library(monkeypatch):
    pieces = Encoder(BYTES, False)
    marks = st.text(alphabet=" \n\ta'é" + "Zst2_-.!?*\u0301\u2019\u200b\xa0", max_size=25)

    @settings(max_examples=600, deadline=None)
    @given(st.lists(ODD | marks, max_size=6), st.sampled_from([1, 9, 1 << 20]), st.sampled_from([1, 3, 1 << 20]), st.integers(0, 3))
    def run(texts, cut, window, skipped):
        monkeypatch.setattr(encoding, "CUT_BYTES", cut)
        monkeypatch.setattr(encoding, "WINDOW", window)
        for kind in (pa.string(), pa.large_string()):
            assert by_column(pieces, pa.array(texts, kind)[skipped:]) == library(texts[skipped:])

    run()


def test_marks_after_every_character():
    """Words are cut off the marks behind them only where tokens end."""
    odd = [*map(chr, range(0x21, 0x500)), "Ω", "中", "한", "\u0301", "\u200d", "😀", "٣", "Ⅷ"]
    marks = [chr(m) for m in range(0x21, 0x7F) if not chr(m).isalnum()]
    texts = [f"{c}{m} a{c}{m}b {c}{m}{c}\n{c}{m}" for c in odd for m in ".'_"] + [f"{c}{m}{n}s 1{m} {m}{c}" for c in "aZé5" for m in marks for n in "'.-"]
    texts += [f"it{m}{s} IT{m}{s}x" for m in marks for s in ("s", "t", "re", "ve", "m", "ll", "d", "S", "'s")]
    assert by_column(Encoder(BYTES, False), pa.array(texts)) == library(texts)


def test_column_of_documents(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    assert by_column(Encoder(BYTES, False), pa.array(texts)) == library(texts)
    with pytest.raises(ValueError):
        next(Encoder(public_tokenizers.path(FILES[1][0]), True).column(pa.array(texts)))


def test_token_files_look_up_a_word_once_per_batch(spark, monkeypatch):
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

    monkeypatch.setattr(encoder(BYTES, drops_space=False), "known", Counted())
    batch = pa.RecordBatch.from_pydict({"doc_id": [*range(500)], "text": ["the same ten words, in every text. no word more"] * 500})
    (out,) = token_files._compressed(Docs(), BYTES, 2, 2, b"")(iter([batch]))
    assert out.column("n_tokens").to_pylist() == [len(library([batch["text"][0].as_py()])[0]) + 1] * 500
    assert 0 < encoder(BYTES, drops_space=False).known.asked < 100
