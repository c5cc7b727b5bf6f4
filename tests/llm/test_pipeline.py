"""The pipeline, stage by stage, against plain Python over the same rows."""

import re
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_pii import base
from tests.oracle import sql_rows

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints):
    """doc_id by doc_id, linking fingerprints at three or fewer differing bits."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{DATA}/documents.parquet")
    long = docs.where("n_chars > 6000")  # near copies: two words more
    near = long.withColumns({"doc_id": F.col("doc_id") + 1_000_000, "text": F.concat("text", F.lit(" edh\tthea"))})
    docs.union(near).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    found = [spark.read.parquet(f"{folder}/documents.parquet")]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], str(folder)).write.parquet(f"{folder}/{number}")
        found.append(spark.read.parquet(f"{folder}/{number}"))
    found.append(str(folder))
    return found


def documents(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(s.schema.names == stages[0].schema.names for s in stages[:-2])
    assert [s.dtypes for s in stages[1:-2]] == [stages[0].dtypes] * 4


def test_quality_stage(stages):
    from tarmac.llm import quality

    names, found = sql_rows(documents(stages[-1]), quality.SQL)
    kept = {r[names.index("doc_id")] for r in found if r[names.index("kept")]}
    assert rows(stages[1]) == {i: r for i, r in rows(stages[0]).items() if i in kept}
    assert 0 < len(kept) < stages[0].count()


def test_exact_stage(stages):
    first = {}
    for i, r in sorted(rows(stages[1]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), i)
    assert rows(stages[2]) == {i: r for i, r in rows(stages[1]).items() if i in set(first.values())}


def test_near_stage(stages):
    before = rows(stages[2])
    component = smallest_reachable({i: fingerprint(r.text) for i, r in before.items()})
    assert rows(stages[3]) == {i: r for i, r in before.items() if component[i] == i}
    assert stages[3].count() < stages[2].count()


def test_personal_data_stage(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert before.keys() == after.keys()
    changed = 0
    for i, r in after.items():
        assert r.n_chars == len(r.text) and base(r.text) == []
        if before[i].text == r.text:
            assert not base(before[i].text)
        changed += before[i].text != r.text
    assert 0 < changed < len(after) / 2


def test_packing_stage(stages):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole.encode_special_tokens = True
    texts, pieces, sequences = rows(stages[4]), defaultdict(list), defaultdict(list)
    for r in stages[5].collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == texts.keys()
    total = 0
    for i, r in texts.items():
        n = len(whole.encode(r.text, add_special_tokens=False).ids) + 1
        cut = sorted((p.piece, p.start, p.length) for p in pieces[i])
        assert cut == [(k, 4096 * k, min(4096, n - 4096 * k)) for k in range(-(-n // 4096))]
        total += n
    for placed in sequences.values():
        at = 0
        for p in sorted(placed, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    assert len(sequences) <= -(-total // 4096) + 1


def test_run_is_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, stages[-1]).collect())) == sorted(map(key, stages[-2].collect()))


CLASHES = ["row", "number", "document", "piece", "part", "__row", "__id", "__body", "__hash", "group", "sequence", "named", "text_sha256"]


@pytest.fixture(scope="module")
def odd(spark):
    prose = " ".join(f"word{i % 61} of the {i * i % 97}" for i in range(80))
    texts = [(1, prose), (1, prose), (2, prose + "  x"), (3, None), (3, None), (4, ""), (5, " \t"), (None, prose), (None, "other " + prose * 3), (6, prose * 400)]
    texts += [(7, prose.replace("word1 ", "a@b.cd ") + " token: hunter2!secret99")]
    rows = [(i, t, "en", "s", None if t is None else len(t), *[f"c{n}" for n in range(len(CLASHES))]) for i, t in texts]
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}").repartition(3)


@pytest.mark.parametrize("number", range(4))
def test_stages_take_rows_of_any_kind(spark, odd, number):
    """Null and empty texts, repeated and missing ids, columns of any name: rows come through whole or not at all."""
    out = corpus_pipeline.STAGES[number][1](spark, odd, "")
    assert out.dtypes == odd.dtypes
    assert all(r[c] == f"c{n}" for r in out.collect() for n, c in enumerate(CLASHES))
    ids = sorted(((r.doc_id or -1), len(r.text or "")) for r in out.collect())
    whole = sorted(((r.doc_id or -1), len(r.text or "")) for r in odd.collect())
    prose = len(odd.where("doc_id = 1").first().text)
    if number == 0:  # few words go
        assert [i for i, n in ids if n < 300] == [] and all(pair in whole for pair in ids)
    elif number == 1:  # copies go, rows of the staying id stay together
        assert ids == sorted([p for p in whole if p not in {(-1, prose), (3, 0)} and p[0] not in (4, 5)] + [(3, 0), (3, 0), (5, 2)])
    elif number == 2:
        assert len(ids) < len(whole) and all(pair in whole for pair in ids)
    else:
        assert len(ids) == len(whole)
        text = odd.where("doc_id = 7").first().text
        cleaned = out.where("doc_id = 7").first()
        assert "hunter2" in text and "hunter2" not in cleaned.text and "a@b.cd" not in cleaned.text and cleaned.n_chars == len(cleaned.text)
        assert {r.text for r in out.where("doc_id = 3").collect()} == {None}
    assert corpus_pipeline.STAGES[number][1](spark, odd.where("false"), "").count() == 0


def test_packing_takes_rows_of_any_kind(spark, odd):
    rows_ = corpus_pipeline.best_fit_packing(spark, odd, "").collect()
    assert sorted({(r.doc_id or -1) for r in rows_}) == [-1, 1, 2, 3, 4, 5, 6, 7] and len(rows_) >= odd.count()
    assert corpus_pipeline.best_fit_packing(spark, odd.where("false"), "").count() == 0


def test_no_secret_is_left(stages):
    """What the search for personal data calls a secret or identifier is nowhere in the texts that go on."""
    from tarmac.llm import pii

    before, after = rows(stages[3]), rows(stages[4])
    held = [before[i].text[a:b] for i in before for kind, a, b in pii.spans(before[i].text) if kind in ("account", "url")]
    assert len(held) > 3
    for i, r in after.items():
        for kind, a, b in pii.spans(before[i].text):
            if kind == "account":
                assert before[i].text[a:b] not in r.text
