import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import hard_negatives, neighbours, queries, vectors

SCHEMA = "vec_id bigint, label int, embedding array<float>, score double, vector string, row int, block int"


def usable(rows, labelled=False):
    found = []
    for i, label, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v) or (labelled and label is None):
            continue
        found.append((i, label, [float(np.float32(x)) for x in v]))
    return found


def last(i):
    return (i is None, i or 0)


def cosine(a, b):
    dot = math.fsum(x * y for x, y in zip(a, b))
    return dot / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(x * x for x in b))


def plain_nearest(rows, asks, k=5):
    """Per asking row: (id, scores of the k nearest)."""
    rows = [r for r in usable(rows) if any(r[2])]
    out = []
    for n, (i, _, v) in enumerate(rows):
        if i is not None and asks(i):
            near = sorted(((-cosine(v, w), last(j)) for m, (j, _, w) in enumerate(rows) if m != n), key=lambda x: (round(x[0], 12), x[1]))
            out.append((i, [(None if j[0] else j[1], -s) for s, j in near[:k]]))
    return out


def plain_mined(rows, asks):
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in usable(rows, labelled=True)]
    out = []
    for n, (i, label, v) in enumerate(rows):
        if i is None or not asks(i):
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(v, w)), last(j), other == label) for m, (j, other, w) in enumerate(rows) if m != n), key=lambda x: x[:2]
        )
        for p, pid, _ in [s for s in scored if s[2]][:5]:
            window = [(q, qid) for q, qid, same in scored if not same and 80 * -p <= 100 * -q <= 100 * -p]
            for rank, (q, qid) in enumerate(window[:5], 1):
                out.append((i, None if pid[0] else pid[1], rank, None if qid[0] else qid[1], -p, -q))
    return out


def table(spark, rows):
    floats = [(i, label, v and [None if x is None else float(x) for x in v]) for i, label, v in rows]
    return spark.createDataFrame([(*r, 0.5, "x", 1, 2) for r in floats], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def odd():
    draw = np.random.default_rng(3)
    rows = [(i, int(draw.integers(0, 3)), draw.standard_normal(6).round(1).tolist()) for i in range(120)]
    rows += [(i, 1, [1.0, 2.0, 0.0, -1.0, 0.5, 0.25]) for i in range(200, 260)]  # a large group of copies
    rows += [(210, 1, [1.0, 2.0, 0.0, -1.0, 0.5, 0.25])] * 3 + [(50, 2, [0.5, 0.5, 0, 0, 0, 1.0])] * 2
    rows += [(300, 0, None), (310, 0, []), (320, 0, [0.0] * 6), (330, 1, [1.0, None]), (340, 1, [math.nan] * 6), (350, 1, [math.inf, 1.0])]
    rows += [(None, 1, [1.0, 1.0, 1.0]), (None, None, [1.0, 1.0, 1.0]), (360, None, [3.0, 1.0, 2.0]), (370, 2, [2.0, 1.0]), (380, 2, [1e-30] * 6)]
    return rows


@pytest.mark.parametrize("values", [64, vectors.BLOCK_VALUES])
def test_nearest_of_odd_rows(spark, odd, values, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VALUES", values)
    rows = table(spark, odd)
    found = neighbours.nearest(rows, rows.where("vec_id % 10 = 0")).collect()
    by = defaultdict(list)
    for r in found:
        by[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = defaultdict(list)
    for i, near in plain_nearest(odd, lambda i: i % 10 == 0):
        want[i] += [(rank, j, s) for rank, (j, s) in enumerate(near, 1)]
    assert by.keys() == want.keys()
    hits = total = 0
    for i in want:
        assert len(by[i]) == len(want[i])
        got, true = sorted(by[i], key=lambda x: (x[0], -x[2])), sorted(want[i], key=lambda x: (x[0], -x[2]))
        total += len(true)
        hits += sum(abs(a[2] - b[2]) < 1e-9 and a[1] == b[1] for a, b in zip(got, true))
    assert hits >= 0.9 * total


def test_queries_of_copies_find_the_smallest_ids(spark, odd):
    rows = table(spark, odd)
    found = neighbours.nearest(rows, rows.where("vec_id = 250")).orderBy("rank").collect()
    assert [(r.vec_id, round(r.score, 12)) for r in found] == [(i, 1.0) for i in range(200, 205)]


@pytest.mark.parametrize("values", [64 * 100, vectors.BLOCK_VALUES])
def test_recall(spark, values, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VALUES", values)
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, units = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    hits = total = 0
    found = defaultdict(list)
    for r in queries.op12_neighbours(spark, sf).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    for query, near in found.items():
        scores = units @ units[ids == query][0]
        scores[ids == query] = -2
        true = set(ids[np.lexsort((ids, -scores))[:5]].tolist())
        assert [n[0] for n in sorted(near)] == [1, 2, 3, 4, 5]
        assert all(abs(scores[ids == i][0] - s) < 1e-12 for _, i, s in near)
        hits, total = hits + len(true & {i for _, i, _ in near}), total + 5
    assert hits / total >= 0.95


def test_less_than_all_rows_are_scored():
    """On clustered rows a query leaves most of a block unread, and misses no more than it may."""
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((40, 32))
    rows = np.repeat(centres, 50, axis=0) + 0.1 * draw.standard_normal((2000, 32))
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    forest, strings = neighbours.Forest(units), neighbours.hashes(units[:100])
    scores = units[:100] @ units.T
    fifth = -np.sort(-scores, axis=1)[:, 5]
    low, high = forest.spans(strings, neighbours.levels(fifth))
    read = [forest.candidates(low[:, i], high[:, i]) for i in range(100)]
    hits = sum(len(set(read[i]) & set(np.argsort(-scores[i])[:6])) for i in range(100))
    assert hits >= 0.97 * 600 and np.mean([len(r) for r in read]) < 0.1 * len(units)


def test_levels_keep_the_promised_probability():
    scores = np.array([-1.0, -0.2, 0.0, 0.3, 0.45, 0.9, 0.999999, 1.0])
    agree = 1 - np.arccos(scores) / np.pi
    with np.errstate(divide="ignore"):
        missed = np.exp(np.log1p(-(agree ** neighbours.levels(scores))).sum(axis=0))
    assert (missed <= neighbours.MISS + 1e-12).all() and missed[3] > neighbours.MISS / 3


@pytest.mark.parametrize("values", [64, vectors.BLOCK_VALUES])
def test_mined_from_odd_rows(spark, odd, values, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VALUES", values)
    rows = table(spark, odd)
    found = hard_negatives.mined(rows, rows.where("vec_id % 10 = 0")).collect()
    got = sorted((tuple(r) for r in found), key=repr)
    assert got == sorted(plain_mined(odd, lambda i: i % 10 == 0), key=repr) and got


def test_large_components(spark):
    rows = [(i, i % 2, [float(2 ** (20 + i % 3)), float(i)]) for i in range(0, 40)]
    data = table(spark, rows)
    found = sorted(map(tuple, hard_negatives.mined(data, data.where("vec_id % 10 = 0")).collect()))
    assert found == sorted(plain_mined(rows, lambda i: i % 10 == 0)) and found
    whole = hard_negatives._whole(np.array([[2.0**60, 3.0]]))
    alive, scores = hard_negatives.scan(hard_negatives.Columns(whole.T, np.array([1])), whole[0], np.arange(1), hard_negatives.largest(1))
    assert scores.tolist() == [2**120 + 9]


def test_no_rows(spark, odd):
    rows = table(spark, odd)
    none = rows.where("false")
    for run in (neighbours.nearest, hard_negatives.mined):
        assert run(none, none).count() == run(rows, none).count() == run(none, rows.where("vec_id < 3")).count() == 0
    assert neighbours.nearest(rows.where("vec_id in (1, 2)"), rows.where("vec_id = 1")).count() == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-9, 9), min_size=4, max_size=4), min_size=2, max_size=30), st.integers(1, 3), st.booleans())
def test_scan_keeps_what_windows_need(rows, many, wide):
    values = np.array(rows, float).T
    anchor = values[:, 0].copy()
    if wide:
        values, anchor = hard_negatives._whole(values), hard_negatives._whole(anchor)
    columns = hard_negatives.Columns(values, np.arange(len(rows)))
    scores = [sum(int(a) * int(b) for a, b in zip(rows[0], r)) for r in rows]
    left, found = hard_negatives.scan(columns, anchor, np.arange(len(rows)), hard_negatives.largest(many))
    assert sorted(found.tolist(), reverse=True)[:many] == sorted(scores, reverse=True)[:many]
    tops = sorted({s for s in scores if s >= 0})[-3:]
    left, found = hard_negatives.scan(columns, anchor, np.arange(len(rows)), hard_negatives.first_below(tops, many))
    for top in tops:
        inside = [s for s in scores if 80 * top <= 100 * s <= 100 * top]
        assert sorted((s for s in found.tolist() if 80 * top <= 100 * s <= 100 * top), reverse=True)[:many] == sorted(inside, reverse=True)[:many]
