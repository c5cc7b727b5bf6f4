import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import exact_dedup, quality, queries, simhash
from tarmac.llm.components import components
from tarmac.llm.text import words
from tests.llm.test_pipeline import fingerprint, smallest_reachable
from tests.oracle import compare, connect

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a  b"), (5, "a\nb"), (5, "a\nb"), (6, "a\xa0b"), (7, "a b"), (8, "a b\n\na b\nc d\n\na b"),
    (9, "x " * 70_000), (10, "w" * 300_000), (None, "a b"), (11, "the the the the the"), (12, "A\x0bB\x0cC\rD\x1cE"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, hash string, group_size int").repartition(3)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, small, name):
    assert compare(queries.QUERIES[name](spark, small), connect(small), queries.ORACLES[name]) is None


def body(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[body(t)].append(i)
    return groups


@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda t: F.length(t) % 3, lambda t: F.lit(b"x")], ids=["md5", "clashing", "one"])
def test_exact_groups_whatever_the_hash(odd, digest):
    groups = plain_groups(ODD)
    want = []
    for i, t in ODD:
        ids = [j for j in groups[body(t)] if j is not None]
        want.append((i or -1, min(ids), len(groups[body(t)]), i == min(ids), hashlib.sha256(body(t).encode()).hexdigest()))
    got = [(r.doc_id or -1, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.decisions(odd, digest).collect()]
    assert sorted(got) == sorted(want)


def test_exact_rows_that_stay(odd):
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 8, 9, 10, 11, 12]
    assert exact_dedup.deduplicated(odd.where("false")).count() == exact_dedup.decisions(odd.where("false")).count() == 0


def plain_repeats(found):
    places = defaultdict(list)
    for i in range(len(found) - 2):
        places[tuple(found[i : i + 3])].append(i)
    return len({i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)})


def test_measures_of_odd_rows(odd):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.kept) for r in quality.measures(odd).collect()}
    want = set()
    for i, t in ODD:
        found = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [line for line in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        want.add((i, len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), plain_repeats(found), False))
    assert got == want
    assert quality.measures(odd.where("false")).count() == quality.kept(odd.where("false")).count() == 0


@pytest.mark.parametrize("bits", [24, 56, 3], ids=["usual", "clashing hashes", "by text"])
def test_repeated_words_always_exact(spark, bits):
    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=40, max_size=40))
    def run(texts):
        df = spark.createDataFrame([(" ".join(t),) for t in texts], "text string").select("text", words(F.col("text")).alias("w"))
        for r in df.select("w", quality.repeated_words(F.col("w"), bits).alias("n")).collect():
            assert r.n == plain_repeats(r.w)

    run()


def test_order_never_changes_the_verdict(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    of = quality.features(F.col("text"), words(F.col("text")))
    verdicts = [
        {r.doc_id for r in docs.where(quality.first_rejection(order, of).isNull()).collect()} for order in (quality.RULES, quality.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1] == {r.doc_id for r in quality.kept(docs).collect()}
    assert len(verdicts[0]) > 100


def test_simhash_against_brute_force(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = docs.where("length(text) % 7 = 0").select((F.col("doc_id") + 5_000).alias("doc_id"), F.concat("text", F.lit(" or")).alias("text"))
    rows = docs.union(more).union(odd.where("doc_id IS NOT NULL").select(F.col("doc_id") + 20_000, "text"))
    texts = {r.doc_id: r.text for r in rows.collect()}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    component = smallest_reachable(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.decisions(rows).collect()}
    assert got == {i: (f"{p:016x}", component[i]) for i, p in prints.items()}
    assert len(set(component.values())) < len(component)


def test_links_at_every_distance(spark):
    """All ways to differ in up to three bits are found, none in four; across the ends of the ring too."""
    import random

    random.seed(3)
    base = random.getrandbits(64)
    values = {base}
    for n in (1, 2, 3, 4):
        for _ in range(150):
            values.add(base ^ sum(1 << b for b in random.sample(range(64), n)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    got = {(r.fingerprint, r.other) for r in simhash.links(df).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (203, 201), (201, 202), (201, 203)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, **{i: 201 for i in (201, 202, 203)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_of_odd_rows(odd):
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.decisions(odd).collect())
    by_id = dict(got)
    assert by_id[2] == by_id[3] == 1 and by_id[5] == by_id[7] == by_id[-1] == 4
    assert simhash.decisions(odd.where("false")).count() == 0
    assert simhash.representatives(odd).columns == odd.columns


def test_simhash_components_are_of_texts_not_ids(spark):
    """One id on different texts, and null ids: one row of each component stays and no text is lost."""
    a, b = (" ".join(f"{w}{i}" for i in range(400)) for w in "ab")
    near = lambda text: text.replace("7 ", "7  ", 1)  # noqa: E731  same words, so the same fingerprint
    rows = [(3, a), (5, near(a)), (5, b), (9, near(b)), (None, "q r s t"), (None, "q  r s t"), (None, "q r  s t"), (2, "u v w"), (2, "u v w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted((r.doc_id or 0, r.text.split()[0]) for r in simhash.representatives(docs).collect())
    assert kept == [(0, "q"), (2, "u"), (3, "a0"), (5, "b0")]
    assert sorted((r.doc_id, r.component_id) for r in simhash.labelled(docs).where("doc_id > 2").collect()) == [(3, 3), (5, 3), (5, 5), (9, 5)]
    chain = [[0b0, None], [0b11, None], [0b1111, 4], [0b111111, 8]]  # a link through classes without ids
    prints = spark.createDataFrame([(doc, i, print_) for i, (print_, doc) in enumerate(chain)], "doc_id bigint, row bigint, fingerprint bigint")
    assert {r.named.doc_id for r in simhash._named(prints).collect()} == {4} and simhash._named(prints).count() == 4
