import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import conversations, queries

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def fixed(rows):
    """Cheapest edits of (role, text, fault) rows by a search over places and states: cost, audit, repaired rows."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, shape, out = heapq.heappop(queue)
        end = shape[-1:] if shape else ""
        if (i, end) in seen:
            continue
        seen.add((i, end))
        if i == len(rows) and end in ("", "a"):
            return cost, audit, out
        then = {"": "su", "s": "u", "u": "a", "a": "u"}[end]
        ways = []
        for role in ("user", "assistant"):
            if role[0] in then:
                ways.append((5, "I", i, role[0], (role, "")))
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append((2, "D", i + 1, end, None))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] and role[0] in then:
                    ways.append((more, "K", i + 1, role[0], (role, text)))
                for new in ("user", "assistant"):
                    if new[0] in then:
                        ways.append((1 + more, "R", i + 1, new[0], (new, text)))
        for extra, letter, j, reached, row in ways:
            heapq.heappush(queue, (cost + extra, audit + letter, j, reached, out + ((row,) if row else ())))
    raise AssertionError


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def plain(rows, asked):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        said = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        by[conv].append(((turn is not None, turn or 0), role, said, text, turn))
    found = {}
    for conv in asked:
        told, judged, seen = sorted(by[conv]), [], set()
        for _, role, _, text, _ in told:
            left = text.rstrip(SPACE)
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "" if left[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, out = fixed(judged)
        turns = [t for *_, t in told if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in out)
        found[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def as_found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_found(queries.op11_conversations(spark, small)) == plain(hurt(rows), {r[0] for r in rows})


@pytest.fixture(scope="module")
def odd():
    draw = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "s", "assistant"]
    texts = ["Hi.", "So", "", None, " \t\n", "Well?", "No! ", "x" * 40_000, "é…", "Ok.\x0b"]
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(draw.randint(1, 14)):
            rows.append((conv, draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts)))
    rows += rows[::7]
    rows += [(77, t, ("user", "assistant")[t % 2], f"Turn {t % 400}.") for t in range(3000)]
    rows += [(78, 1, "user", "Yes.")] * 500 + [(79, None, None, None)] * 20 + [(80, -5, "user", "a."), (80, 2**40, "assistant", "b.")]
    return rows


def table(spark, rows):
    wide = [(*r, "x", 1, None) for r in rows]
    return spark.createDataFrame(wide, "conv_id bigint, turn bigint, role string, text string, place string, at int, said string").repartition(5)


@pytest.mark.parametrize("bits", [1, 3, conversations.CHUNK_BITS])
def test_odd_rows_in_chunks_of_any_size(spark, odd, bits, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_BITS", bits)
    given = odd if bits > 1 else [r for r in odd if r[0] != 77 or r[1] < 300]
    tidy = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in given]
    rows = table(spark, given)
    assert as_found(conversations.audited(rows, rows)) == plain(tidy, {r[0] for r in given})


def test_damage(spark, odd):
    got = [tuple(r) for r in conversations.damaged(table(spark, odd)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, hurt(odd)))


def test_nothing(spark, odd):
    rows = table(spark, odd)
    none = rows.where("false")
    assert conversations.audited(none, none).count() == 0
    bare = conversations.audited(none, rows)
    assert {tuple(r)[1:] for r in bare.collect()} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert bare.count() == 65


def test_repaired_rows_read_as_the_pattern(spark, odd):
    rows = conversations.prepared(table(spark, odd))
    places = conversations.cut(conversations.placed(rows))
    found = conversations.repaired(rows, places, conversations.solved(places)).orderBy("place", "part").collect()
    shapes = defaultdict(str)
    for r in found:
        shapes[r.conv_id] += r.role[0]
    assert shapes and all(re.fullmatch("(s?(ua)+)?", s) for s in shapes.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 15), max_size=23))
def test_blocks_against_a_search(codes):
    words = {0: "Fine.", 1: "cut", 2: "Fine.", 3: ""}
    faults = {0: "", 1: "truncated", 2: "duplicate", 3: "blank"}
    roles = ["system", "user", "assistant", "tool"]
    cost, audit, out = fixed([(roles[c >> 2], words[c % 4], faults[c % 4]) for c in codes])
    tables, codes = conversations.tables(), np.array(codes, np.int8)
    letters, state = tables.trace(conversations._symbols(codes), 0, conversations.EMPTY)
    found, price, edits = conversations._edits(codes.tolist(), [1] * len(codes), letters, 0, conversations.EMPTY)
    while state in (conversations.SYSTEM, conversations.USER):
        found, price, state = found + "I", price + 5, conversations.NEXT[state]
    assert (price, found) == (cost, audit)
    assert len(tables.vectors) < 64 and tables.many.shape == (len(tables.vectors), 8**conversations.BLOCK)
