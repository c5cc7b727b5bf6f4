import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    """Leftmost non-overlapping matches of the four patterns, then the checks."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def found(text):
    return [s for s in pii.spans(text) if s[0] in pii.BASE]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="019 +-().@a_Zé😀\n", max_size=60))
def test_base_equals_patterns(text):
    assert found(text) == base(text)


def test_base_on_planted_text():
    text = "é😀 a.b+c@x-y.co.uk, a@b@c.de 1.2.3.4.5.6.7.8 999.1.1.1, 4111 1111-1111 1111 +1 (202) 555-0143 or +44.20.79460958"
    assert found(text) == base(text) and len(found(text)) == 6 + 1


def test_added_kinds():
    text = 'see https://a.example.com/x?y=1, token = "9fd0c9a9" TOKEN 12 tokens are fine'
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)] == [("url", "https://a.example.com/x?y=1"), ("account", "9fd0c9a9")]
    assert pii.redacted(text) == 'see [URL], token = "[ACCOUNT]" TOKEN 12 tokens are fine'


def test_identifiers_of_any_length():
    key = "aZ9_" * 50
    for value in (key, f"{key}-{key}", f"{key} {key} 12", "7" * 65):
        text = f"secret: {value} and more words follow here"
        assert [(k, text[a:b]) for k, a, b in pii.spans(text) if k == "account"] == [("account", value)]
        assert pii.redacted(text) == "secret: [ACCOUNT] and more words follow here"
    text = "token secret: 12345678, password api_key abcdefgh12"
    assert [text[a:b] for k, a, b in pii.spans(text) if k == "account"] == ["12345678"]
    for unit in ("-tokenab", " tokenab1", "token=a-", "token 1 "):
        pii.spans(unit * (400_000 // len(unit)))


SECRETS = {
    "token: eyJhbGciOi.eyJzdWIiOi.abc_DEF-gh": "eyJhbGciOi.eyJzdWIiOi.abc_DEF-gh",
    "secret=abcd/efgh+12345678==": "abcd/efgh+12345678==",
    "password: hunter2!secret99": "hunter2!secret99",
    "PassWord = 'p4ss wd9'": "p4ss wd9",
    "API_KEY=\"sk-live_4f9A\"": "sk-live_4f9A",
    "api key: (ab12cd34ef).": None,
    "passport No. X1234567": "X1234567",
    "PASSPORT NUMBER: X1234567": "X1234567",
    "Iban DE89 3704 0044 0532 0130 00": "DE89 3704 0044 0532 0130 00",
    "Token abc12345, then": "abc12345",
    "the password required for access": None,
    "password: required": None,
    "secretary: 12345678 files": None,
    "token of appreciation 2024": None,
    "no.password.here": None,
    chr(0x130) * 3 + " TOKEN: ab12cd34": "ab12cd34",
}


def test_announced_values_by_cue():
    for text, value in SECRETS.items():
        assert [text[a:b] for k, a, b in pii.spans(f"{text} ") if k == "account"] == ([value] if value else []), text
        around = f"Words before {text}. Words after"
        assert value is None or value not in pii.redacted(around)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*SECRETS, " ", "\n", "token", "secret=", "passport ", "é", "x9", "www.a.b", "12345678", "a@b.cd"]), max_size=8))
def test_added_spans_are_plain_and_apart(parts):
    """Added spans hold no white space at their ends, do not overlap within a kind, and no secret is found in what is left."""
    text = "".join(parts)
    by = {}
    for kind, start, end in pii.spans(text):
        assert text[start:end].strip() == text[start:end] != "" and start >= by.get(kind, 0)
        by[kind] = end
    assert [s for s in pii.spans(text) if s[0] in pii.BASE] == base(text)


def test_long_texts_take_linear_time():
    for unit in ("1", "a@", "+1", "1.", "1 ", "+(", "@a.", "token ", "token=", "secret:token", "passport no. "):
        text = unit * (400_000 // len(unit))
        pii.spans(text)


def test_rows_of_any_kind(spark, small):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "a@b.cd", "x"), (None, "+1 202 555 0143", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = {(r.doc_id, r.spans, r.base_sha256) for r in pii.located(docs).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {(1, "", sha("")), (2, "", sha("")), (3, "email:0:6", sha("email:0:6")), (None, "phone:0:15", sha("phone:0:15"))}
    assert pii.located(docs.where("false")).count() == 0
    clean = pii.without(docs)
    assert clean.columns == docs.columns
    assert sorted("-" if r.text is None else r.text for r in clean.collect()) == ["", "", "-", "[EMAIL]", "[PHONE]"]


def test_whole_table_against_patterns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: base(r.text) for r in docs.collect()}
    for r in pii.located(docs).collect():
        listed = [s for s in (r.spans.split(",") if r.spans else []) if s.split(":")[0] in pii.BASE]
        assert listed == [f"{k}:{a}:{b}" for k, a, b in want[r.doc_id]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want[r.doc_id]) for kind in pii.BASE]
