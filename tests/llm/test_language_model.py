import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyarrow import fs

from tarmac.llm import language_model as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lowered), None]


@pytest.fixture(scope="module")
def docs(spark, small):
    odd = spark.createDataFrame(
        [(10_000, None), (10_001, ""), (10_001, ""), (10_002, "ÀÉ THE\x0bthe\x1cthe the"), (None, "of the")], "doc_id bigint, text string"
    )
    return spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").union(odd)


@pytest.fixture(scope="module")
def corpus(docs):
    return lm.learned(lm.training(docs))


@pytest.fixture(scope="module")
def scores(docs, corpus):
    return lm.scored(docs, corpus).collect()


def test_base_against_brute_force(docs, scores):
    rows = docs.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(t for r in rows if not held(r.doc_id) for t in plain_tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = []
    for r in rows:
        found = plain_tokens(r.text)
        base = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in found)
        want.append((r.doc_id or -1, held(r.doc_id), len(found), sum(c[t] > 0 for t in found), n, round(base, 6)))
    got = [(r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scores]
    assert sorted(got) == sorted(want)


def test_held_out_text_is_likelier_than_by_the_base(scores):
    held = [r for r in scores if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in scores)


def test_segments_do_not_change_what_is_known(docs, scores):
    """More segments hold the same counts; scores differ by the filter's errors alone."""
    finer = lm.learned(lm.training(docs), segment_pairs=8_000)
    assert finer.cut_bits >= 2
    key = lambda r: (r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6))
    found = lm.scored(docs, finer).collect()
    assert sorted(map(key, found)) == sorted(map(key, scores))
    assert abs(sum(r.score for r in found) / sum(r.score for r in scores) - 1) < 0.02


def plain_scores(rows, training):
    """Log10 probabilities from exact counts of words and pairs, quantised as the filter does."""
    words, pairs = Counter(), Counter()
    for text in training:
        found = [None, *plain_tokens(text)]
        words.update(found[1:])
        pairs.update(zip(found, found[1:]))
    n, v = sum(words.values()), len(words)

    def taken(count):
        return (2 ** (count.bit_length() - 1) + 2 ** count.bit_length() - 1) / 2 if count else 0.0

    def probability(a, b):
        context, alone = taken(words[a]), (taken(words[b]) + 1) / (n + v + 1)
        return (min(taken(pairs[a, b]), context) + lm.WEIGHT * alone) / (context + lm.WEIGHT)

    out = []
    for r in rows:
        found = [None, *plain_tokens(r.text)]
        out.append((r.doc_id or -1, sum(math.log10(probability(a, b)) for a, b in zip(found, found[1:]))))
    return out


def test_score_against_brute_force(docs, scores):
    """With bits to spare the filter hardly errs and scores are those of the exact model; else they are close."""
    rows = docs.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    want = plain_scores(rows, [r.text for r in rows if not held(r.doc_id)])
    wide = lm.scored(docs, lm.learned(lm.training(docs), bits=400)).collect()
    got = sorted((r.doc_id or -1, r.score) for r in wide)
    off = [abs(a[1] - b[1]) for a, b in zip(got, sorted(want))]
    assert [a[0] for a in got] == [b[0] for b in sorted(want)] and sum(o > 1e-6 for o in off) <= 0.1 * len(off)
    assert all(o <= 0.01 * abs(b[1]) for o, b in zip(off, sorted(want)))
    close = sorted((r.doc_id or -1, r.score) for r in scores)
    assert all(abs(a[1] - b[1]) <= 0.12 * abs(b[1]) + 1 for a, b in zip(close, sorted(want)))


def test_filter_of_any_budget(docs, scores):
    """A file that is far too small is as large as allowed, still known to every word, and only less exact."""
    small = lm.learned(lm.training(docs), segment_pairs=20_000, filter_bytes=12_000)
    size = fs_size(small.folder)
    assert size <= 12_000 + 8 * (1 + 8 * 2**small.cut_bits) + 16 * 2**small.cut_bits
    found = lm.scored(docs, small).collect()
    key = lambda r: (r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6))
    assert sorted(map(key, found)) == sorted(map(key, scores)) and all(r.score < 0 for r in found)


def fs_size(folder):
    system, place = fs.FileSystem.from_uri(folder)
    return system.get_file_info(f"{place}/filter").size


@pytest.mark.parametrize("bits,wrong", [(7, 1 / 16), (5, 1 / 8), (3, 1 / 3), (2, 1 / 2)])
def test_stated_errors(bits, wrong):
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 2**63, 50_000, dtype=np.uint64))
    counts = rng.zipf(2.2, len(hashes)).clip(1, 10**9)
    part = lm.filter_part(hashes, counts, bits * int(lm.level(counts, 1).sum()))
    found = lm.LogFilter([part], 0)
    assert (found.levels(hashes) >= lm.level(counts, part.step)).all()
    strangers = rng.integers(2**63, 2**64, 50_000, dtype=np.uint64)
    assert (found.levels(strangers) > 0).mean() < wrong
    assert (found.counts(hashes) >= counts / 2**part.step).all()


def test_filter_never_forgets():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**63, 5_000, dtype=np.uint64))
    counts = rng.zipf(1.5, len(hashes)).clip(1, 10**9)
    found = lm.LogFilter([lm.filter_part(hashes, counts)], 0)
    assert (found.levels(hashes) >= lm.level(counts)).all()
    assert (found.levels(hashes) == lm.level(counts)).mean() > 0.85
    strangers = rng.integers(2**63, 2**64, 5_000, dtype=np.uint64)
    assert (found.levels(strangers) > 0).mean() < 0.1
    assert lm.level(np.array([1, 2, 3, 4, 1 << 40])).tolist() == [1, 2, 2, 3, 41]


def test_empty_tables(spark, docs, corpus):
    none = docs.where("false")
    assert lm.scored(none, corpus).count() == 0
    rows = lm.scored(docs, lm.learned(none)).collect()
    assert len(rows) == docs.count() and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)
