"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in a single pass: at-signs, plus signs before a digit, digits,
web schemes and the words that announce an identifier or a secret, in any case. From each anchor a small parser with no state but the end of its
last match expands to both sides and validates what it found. The base kinds come out as the leftmost non-overlapping
matches of their patterns; urls, announced identifiers and secrets are added to them. Texts are handled one at a time, in time
linear in their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarmac.llm.text import whole

#: Kinds in the order in which their spans are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"(?:[A-Za-z]+://|[wW]{3}\.)(?:[A-Za-z0-9-]++\.)+[A-Za-z0-9-]++(?::[0-9]++)?(?:[/?#][^\s<>\"']*+)?")
#: What stands between a cue and its value; and a group of an identifier.
HEAD = re.compile(r"[\x20\t]*(?:(?:number|no\.?|id)(?![a-z]))?[\x20\t]*([:=#]?)[\x20\t]*([\"']?)", re.IGNORECASE)
GROUP = re.compile(r"[A-Za-z0-9_](?:-?[A-Za-z0-9_])*+")
#: A secret goes on to white space, a bracket or a quote; marks at its end belong to the sentence.
SECRET = re.compile(r"[^\s\"'<>\[\](){}]++")
TRAILING = ".,;:!?"
#: Characters of a value at least, and digits of one that no sign introduces.
LEAST, LEAST_DIGITS = 8, 3

SCHEMES = ("http://", "https://", "ftp://", "www.")
IDENTIFIERS = ("account", "iban", "passport", "ssn")
SECRETS = ("token", "secret", "password", "api_key", "apikey", "api key")


@cache
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    automaton.add_word("@", ("@", 1))
    for digit in DIGITS:
        automaton.add_word(digit, ("digit", 1))
        automaton.add_word("+" + digit, ("phone", 2))
    for scheme in SCHEMES:
        automaton.add_word(scheme, ("url", len(scheme)))
    for kind, cues in (("identifier", IDENTIFIERS), ("secret", SECRETS)):
        for cue in cues:
            automaton.add_word(cue, (kind, len(cue)))
    automaton.make_automaton()
    return automaton


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _email(text: str, at: int, free: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, beginning at ``free`` at the earliest."""
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _ip_valid(match: re.Match) -> bool:
    return all(len(part) <= 3 and int(part) <= 255 for part in (g.lstrip("0") or "0" for g in match.groups()))


def _card_valid(match: re.Match) -> bool:
    digits = match.group().replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _phone_valid(match: re.Match) -> bool:
    return 9 <= sum(c in DIGITS for c in match.group()) <= 15


def _announced(text: str, kind: str, cue_start: int, cue_end: int, dead: int) -> tuple[tuple[int, int] | None, int]:
    """The value that a cue announces, of any length, and the new ``dead``.

    Values that begin before ``dead`` are tails of one that failed, and fail as well, so no run of characters is read more
    than a few times.
    """
    if cue_start and (text[cue_start - 1].isalnum() or text[cue_start - 1] == "_"):
        return None, dead
    head = HEAD.match(text, cue_end)
    if head.end() == cue_end or head.end() < dead:
        return None, dead
    return (_secret if kind == "secret" else _identifier)(text, head, dead)


def _secret(text: str, head: re.Match, dead: int) -> tuple[tuple[int, int] | None, int]:
    """Everything up to white space, a bracket or a quote, and further groups, each after one space, while they hold a digit.

    After a sign or in quotes a digit is enough, or capitals and small letters around a mark; otherwise it takes three digits.
    """
    found = SECRET.match(text, head.end())
    if not found:
        return None, dead
    start, end = found.start(), found.start() + len(found.group().rstrip(TRAILING))
    digits = _digits(text[start:end])
    while end >= found.end() and (group := GROUP.match(text, end + 1) if text.startswith(" ", end) else None):
        held = _digits(group.group())
        if not held:
            break
        digits, end = digits + held, group.end()
    value = text[start:end]
    mixed = any(c in value for c in "._-+/=!$%&@*~^|") and value != value.lower() and value != value.upper()
    if len(value) >= LEAST and (digits >= LEAST_DIGITS or (head[1] or head[2]) and (digits or mixed)):
        return (start, end), dead
    return None, max(dead, found.end(), end)


def _digits(value: str) -> int:
    return sum(map(value.count, DIGITS))


def _identifier(text: str, head: re.Match, dead: int) -> tuple[tuple[int, int] | None, int]:
    """Eight characters or more with at least three digits. The first group is taken whole, and further ones, each after one
    space, while they hold a digit."""
    start = end = head.end()
    digits, group = 0, GROUP.match(text, start)
    while group:
        held = _digits(group.group())
        if not held:  # words after the identifier are not part of it
            break
        digits, end = digits + held, group.end()
        group = GROUP.match(text, end + 1) if text.startswith(" ", end) else None
    if end - start >= LEAST and digits >= LEAST_DIGITS:
        return (start, end), dead
    return None, max(dead, end, group.end() if group and end == start else 0)


def _lowered(text: str) -> str:
    """The text in small letters with every place kept, in which anchors are found. Only one letter becomes two."""
    low = text.lower()
    return low if len(low) == len(text) else text.replace(chr(0x130), "i").lower()


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and then start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    free, dead = dict.fromkeys(KINDS, 0), 0

    def take(kind: str, span: tuple[int, int] | None, valid: bool = True) -> None:
        if span:
            free[kind] = span[1]
            if valid:
                found[kind].append(span)

    for last, (anchor, length) in _anchors().iter(_lowered(text)):
        start = last - length + 1
        if anchor == "digit":
            first = start == 0 or text[start - 1] not in DIGITS
            for kind, pattern, valid in (("ip", IP, _ip_valid), ("card", CARD, _card_valid)):
                if (start > free[kind] and first or start == free[kind]) and (match := pattern.match(text, start)):
                    take(kind, match.span(), valid(match))
        elif anchor == "@":
            take("email", _email(text, start, free["email"]))
        elif anchor == "phone":
            if start >= free["phone"] and (match := PHONE.match(text, start)):
                take("phone", match.span(), _phone_valid(match))
        elif anchor == "url":
            if start >= free["url"] and (match := URL.match(text, start)):
                take("url", (start, start + len(match.group().rstrip(".,;:!?)"))))
        elif start >= free["account"]:
            span, dead = _announced(text, anchor, start, last + 1, dead)
            take("account", span)
    return [(kind, start, end) for kind in KINDS for start, end in found[kind]]


def _written(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first, then the longest, names the place."""
    out, at = [], 0
    for kind, start, end in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


RESULT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, "
    "n_url bigint, n_account bigint"
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: dict[str, list] = {name.split()[0]: [] for name in RESULT.split(", ")[1:]}
        for value in batch.column(1):
            found = spans(value.as_py())
            kinds = [kind for kind, _, _ in found]
            for kind in KINDS:
                columns[f"n_{kind}"].append(kinds.count(kind))
            columns["base_sha256"].append(hashlib.sha256(_written([s for s in found if s[0] in BASE]).encode()).hexdigest())
            columns["spans"].append(_written(found))
        arrays = [pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in columns.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *columns])


def located(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans, and all spans as ``kind:start:end``.

    Null text counts as empty: no spans, and the digest of the empty string. Repeated rows are searched one by one; other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text")).mapInArrow(_rows, RESULT)


@F.pandas_udf(StringType())
def _redact(texts: pd.Series) -> pd.Series:
    return texts.map(redacted, na_action="ignore")


def without(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with personal data replaced in ``text`` and ``n_chars`` kept in step.

    Null texts stay null; a text without personal data, an empty one among them, is unchanged. Rows that repeat an id or a
    text are treated one by one, texts of any length whole; ``n_chars`` stays where the text is null; an empty table gives
    no rows.
    """
    out = docs.withColumn("text", _redact(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])
