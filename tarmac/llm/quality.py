"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a boolean expression over the whole text that says "reject". On a sample the share of rows each rule rejects
and the time it takes are measured, and the rules are then tried in the order of rejections per second: a CASE expression
stops at the first that holds, so costly rules see only what the cheap ones let through. The order changes the cost and
never the verdict: a document is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import SPACES, cut, let, whole, words

#: Bits of a packed window that hold its place in the text; the rest hold its hash.
PLACE_BITS = 24


class Rule(NamedTuple):
    name: str
    #: "Reject", from the measures by name.
    rejects: Callable[[dict[str, Column]], Column]


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))


def _repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def _covered(places: Column) -> Column:
    """Words covered by three-word windows at these ascending places."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    step = lambda at, p: F.struct(p.alias("last"), (at["n"] + F.least(F.lit(3), p - at["last"])).alias("n"))
    return F.aggregate(places, start, step, lambda at: at["n"].cast("bigint"))


def _repeated_by_text(found: Column) -> Column:
    """Repeated windows by sorting the windows themselves: always exact, and slower."""
    window = lambda i: F.struct(F.get(found, i).alias("a"), F.get(found, i + 1).alias("b"), F.get(found, i + 2).alias("c"), i.alias("i"))
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    sorted_ = F.array_sort(F.transform(F.sequence(F.lit(0), F.size(found) - 3), window))
    return let(
        sorted_,
        lambda s: _covered(
            F.array_sort(
                F.transform(
                    F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1))),
                    lambda x: x["i"],
                )
            )
        ),
    )


def _repeated_by_hash(found: Column, place_bits: int) -> Column:
    """Repeated windows by sorting packed (hash, place) integers; where two different windows share a hash, by text."""
    mask = F.lit((1 << place_bits) - 1).cast("bigint")
    hashed = lambda w, i: F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2))
    packed = F.slice(
        F.transform(found, lambda w, i: F.shiftleft(hashed(w, i), place_bits).bitwiseOR(i.cast("bigint"))), F.lit(1), F.size(found) - 2
    )
    key = lambda x: F.shiftright(x, place_bits)
    place = lambda x: x.bitwiseAND(mask).cast("int")
    differ = lambda p, q: (
        (F.get(found, p) != F.get(found, q)) | (F.get(found, p + 1) != F.get(found, q + 1)) | (F.get(found, p + 2) != F.get(found, q + 2))
    )

    def counted(twice: Column) -> Column:
        clash = F.exists(
            F.sequence(F.lit(1), F.size(twice) - 1),
            lambda j: (key(F.get(twice, j)) == key(F.get(twice, j - 1))) & differ(place(F.get(twice, j)), place(F.get(twice, j - 1))),
        )
        return F.when(clash, _repeated_by_text(found)).otherwise(_covered(F.sort_array(F.transform(twice, place))))

    def of_sorted(s: Column) -> Column:
        again = F.filter(s, lambda x, j: key(x) == key(F.get(s, j - 1)))
        twice = F.filter(s, lambda x, j: (key(x) == key(F.get(s, j - 1))) | (key(x) == key(F.get(s, j + 1))))
        return F.when(F.size(again) == 0, F.lit(0).cast("bigint")).otherwise(let(twice, counted))

    return let(F.sort_array(packed), of_sorted)


def repeated_words(found: Column, place_bits: int = PLACE_BITS) -> Column:
    """Words inside three-word windows found twice or more among these words, the first one included."""
    return (
        F.when(F.size(found) < 3, F.lit(0).cast("bigint"))
        .when(F.size(found) >= 1 << place_bits, _repeated_by_text(found))
        .otherwise(_repeated_by_hash(found, place_bits))
    )


def features(text: Column, found: Column) -> dict[str, Column]:
    """Every measure of a text with these words, as unevaluated expressions."""
    counts = {
        "n_words": F.size(found),
        "word_chars": F.length(F.array_join(found, "")),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")),
        "n_capitals": F.length(F.regexp_replace(text, "[^A-Z]+", "")),
        "n_lines": F.size(_lines(text)),
        "n_dup_lines": _repeated_lines(text),
        "n_repeat_words": repeated_words(found),
    }
    return {name: value.cast("bigint") for name, value in counts.items()}


#: The two rules of the base, then symbols, capitals and repeated lines.
RULES = [
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("capitals", lambda m: 10 * m["n_capitals"] > 4 * m["word_chars"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
]
BASE, BEYOND = RULES[:2], RULES[2:]


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = 1_000) -> list[Rule]:
    """Rules by rejections per second, most first, measured on about ``sample_rows`` rows spread by a hash of their number.

    The sample decides the order alone, so any sample, even an empty one, gives the same verdicts.
    """
    every = max(1, docs.count() // sample_rows)
    chosen = docs.select("text").where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0)
    sample = cut(chosen.select(whole("text").alias("text")).select("text", words(F.col("text")).alias("words")))
    of = features(F.col("text"), F.col("words"))
    measured = []
    for rule in rules:
        start = time.perf_counter()
        rejected = sample.agg(F.avg(rule.rejects(of).cast("double"))).first()[0] or 0.0
        measured.append((rejected / (time.perf_counter() - start), rule))
    return [rule for _, rule in sorted(measured, key=lambda m: -m[0])]


def first_rejection(rules: list[Rule], of: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, null when none does; the rules after it are not computed."""
    verdict = F
    for rule in rules:
        verdict = verdict.when(rule.rejects(of), F.lit(rule.name))
    return verdict.otherwise(F.lit(None).cast("string"))


def kept(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = 1_000) -> DataFrame:
    """The rows, all columns, that no rule rejects. Null and empty texts go: they have too few words.

    Rows that repeat an id or a text are judged one by one, texts of any length whole; other columns are carried along,
    whatever their names; an empty table gives no rows.
    """
    order, text = ordered(docs, rules, sample_rows), whole("text")
    return docs.where(let(words(text), lambda found: first_rejection(order, features(text, found))).isNull())


def measures(docs: DataFrame, sample_rows: int = 1_000) -> DataFrame:
    """One row per document: doc_id, its counts, base_failed and kept.

    Null text counts as empty and has zero counts. Repeated rows are measured one by one; other columns are ignored,
    whatever their names; an empty table gives no rows. The base counts are wanted for every row, so only the rules
    beyond the base are left to the cascade.
    """
    split = docs.select("doc_id", whole("text").alias("text")).withColumn("words", words(F.col("text")))
    inline = features(F.col("text"), F.col("words"))
    asked = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counts = split.withColumns({name: inline[name] for name in asked})
    known = inline | {name: F.col(name) for name in asked}
    failed = BASE[0].rejects(known) | BASE[1].rejects(known)
    verdict = first_rejection([Rule("base", lambda m: failed), *ordered(docs, BEYOND, sample_rows)], known)
    return counts.select("doc_id", *asked, failed.alias("base_failed"), verdict.isNull().alias("kept"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^ \t\n\x0b\x0c\r]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS ls FROM d),
m AS (SELECT doc_id, len(ws) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
             length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals FROM w),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS times FROM g),
p AS (SELECT DISTINCT doc_id, i + k AS place FROM t, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1),
r AS (SELECT doc_id, count(*) AS n_repeat_words FROM p GROUP BY doc_id),
f AS (SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words,
             n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed FROM m LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_capitals > 4 * word_chars OR 2 * n_dup_lines > n_lines) AS kept
FROM f
"""
