import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarmac.llm import packing, token_files

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(3, None, 1), (1, "", 1), (7, "the " * 9_000, 1), (5, "x" * 60_000, 1), (-4, "a b <|endoftext|>", 1), (9, "same", 1), (8, "same", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, offset int").repartition(3)


def ids(path, text, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def check_files(docs, files, folder, dictionary):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read(files, folder, dictionary).collect()}
    start, want = 0, {}
    for i in sorted(texts):
        found = ids(BYTES, texts[i], 2)
        want[i] = (start, len(found), crc(found))
        start += len(found)
    assert got == want


def test_files_round_trip(spark, odd, small, monkeypatch):
    check_files(odd, *token_files.write(odd, BYTES, 2))
    monkeypatch.setattr(token_files, "FILE_BYTES", 20_000)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    files, folder, dictionary = token_files.write(docs, BYTES, 2)
    assert dictionary and files.count() > 3
    check_files(docs, files, folder, dictionary)
    one = files.orderBy("file").collect()[1]
    file = token_files.IdFile(folder, one.path, dictionary)
    wanted = int(file.doc_ids[2])
    text = docs.where(f"doc_id = {wanted}").first().text
    assert file.find(wanted).tolist() == ids(BYTES, text, 2) and file.find(-77) is None
    with pytest.raises(ValueError):
        token_files.IdFile(folder, one.path, b"another")
    plain = sum(len(ids(BYTES, r.text, 2)) for r in docs.collect()) * 2
    packed = sum(token_files.IdFile(folder, r.path, dictionary).ends[-1] for r in files.collect())
    assert packed < plain


def test_documents_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b"), (4, "a"), (4, "a"), (None, None)], "doc_id bigint, text string")
    rows = token_files.read(*token_files.write(docs, BYTES, 2)).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == [(-1, 1), (-1, 3), (4, 2), (4, 2)]
    assert max(r.start for r in rows if r.doc_id is None) < min(r.start for r in rows if r.doc_id == 4)
    packed = packing.packed(packing.pieces(docs, WORDS, 1)).collect()
    assert sorted((r.doc_id or -1, r.length) for r in packed) == [(-1, 1), (-1, 3), (4, 2), (4, 2)]


def test_one_id_on_a_third_of_the_rows(spark, monkeypatch):
    """Rows without an id, or with the same one, go over as many files as others, and every file is read in its own task."""
    monkeypatch.setattr(token_files, "FILE_BYTES", 2_000)
    rng = np.random.default_rng(4)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, " ".join(map(str, rng.integers(0, 10**6, 12)))) for i in range(900)]
    files, folder, dictionary = token_files.write(spark.createDataFrame(rows, "doc_id bigint, text string"), BYTES, 2)
    sizes = [r.docs for r in files.collect()]
    assert len(sizes) > 8 and max(sizes) <= 3 * sum(sizes) / len(sizes)
    back = token_files.read(files, folder, dictionary)
    assert back.rdd.getNumPartitions() == len(sizes)
    found = sorted(back.collect(), key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found[:-1]]]).tolist()
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))


def test_width_follows_the_vocabulary(spark, odd, monkeypatch):
    assert token_files.id_width(BYTES, 2) == 2 and token_files.id_width(BYTES, 70_000) == 4
    with pytest.raises(ValueError, match="4 bytes"):
        token_files.write(odd, BYTES, 70_000, width=2)
    rows = token_files.read(*token_files.write(odd, BYTES, 70_000)).collect()
    assert all(zlib.crc32(np.array(ids(BYTES, r.text, 70_000), "<u4").tobytes()) in {f.ids_crc32 for f in rows if f.doc_id == r.doc_id} for r in odd.collect())


def test_no_files(spark, odd):
    files, folder, dictionary = token_files.write(odd.where("false"), BYTES, 2)
    assert files.count() == 0 == token_files.read(files, folder, dictionary).count()


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_sequences(odd):
    found = packing.packed(packing.pieces(odd, WORDS, 1, with_ids=True)).collect()
    check_packing(found, 4096)
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    for r in odd.collect():
        pieces = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        want = ids(WORDS, r.text, 1)
        assert [i for p in pieces for i in np.frombuffer(p.ids, "<u4").tolist()] == want
        assert [p.start for p in pieces] == list(range(0, len(want), 4096)) and all(p.length == 4096 for p in pieces[:-1])
        assert all(p.ids_crc32 == zlib.crc32(p.ids) for p in pieces)


def test_exchange_closes_gaps(spark):
    rng = np.random.default_rng(5)
    lengths = np.concatenate([rng.integers(1, 4097, 6_000), rng.integers(1, 300, 6_000)]).tolist()
    df = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id bigint, piece int, length bigint")
    placed = packing.packed(df, per_partition=500)
    rows = placed.collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    used, bound = packing.certificate(placed)
    assert used == check_packing(rows, 4096)
    alone = packing.packed(df, per_partition=500, rounds=1).select("sequence_id").distinct().count()
    assert bound <= used <= alone and used - bound <= 0.01 * bound


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    """Null and repeated ids go to tasks of about the size asked for."""
    packer = packing._packer

    def watched(capacity, last):
        run = packer(capacity, last)

        def checked(table):
            assert len(table) < 400, len(table)
            return run(table)

        return checked

    monkeypatch.setattr(packing, "_packer", watched)
    df = spark.range(4_000).selectExpr("if(id % 2 = 0, null, 7L) AS doc_id", "0 AS piece", "id % 4000 + 1 AS length")
    rows = packing.packed(df, per_partition=200).collect()
    assert sorted(r.length for r in rows) == list(range(1, 4_001))
    check_packing(rows, 4096)


def test_packing_carries_columns_of_any_name(spark):
    names = ["group", "part", "number", "sequence", "place", "given", "__row", "odd name"]
    df = spark.range(50).selectExpr("id AS doc_id", "0 AS piece", "id * 37 % 900 + 1 AS length", *[f"concat('{n}', id) AS `{n}`" for n in names])
    rows = packing.packed(df, capacity=1000, per_partition=10).collect()
    assert len(rows) == 50 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    check_packing(rows, 1000)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_bound_is_never_above_the_optimum(lengths):
    def fits(rest, rooms):
        if not rest:
            return True
        return any(fits(rest[1:], rooms[:i] + [r - rest[0]] + rooms[i + 1 :]) for i, r in enumerate(rooms) if r >= rest[0] and r not in rooms[:i])

    ordered = sorted(lengths, reverse=True)
    best = next(n for n in range(len(lengths) + 1) if fits(ordered, [12] * n))
    assert packing.lower_bound(np.bincount(lengths, minlength=13), 12) <= best
    _, _, room = packing.best_fit_decreasing(np.array(ordered, np.int64), 12)
    assert best <= len(room) <= best * 11 / 9 + 1


def test_no_rows(odd):
    assert packing.packed(packing.pieces(odd.where("false"), WORDS, 1)).count() == 0
