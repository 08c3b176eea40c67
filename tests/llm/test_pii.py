"""Personal data: base spans against plain patterns, the method's own kinds, awkward texts."""

from __future__ import annotations

import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from orderscope.llm import pii
from orderscope.llm.pii import BASE_KINDS, KINDS, automaton, iban_valid, luhn, masked, scan, spans, summary

from .conftest import AWKWARD, DOCS, REPEATED

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def passes(kind, value):
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and plain_luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(BASE_KINDS)
                  for m in re.finditer(PATTERNS[kind], text or "") if passes(kind, m.group()))


FINDER = automaton()


def base_of(text):
    return [s for s in scan(text, FINDER) if s[1] < len(BASE_KINDS)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="01257.@+- ()aZ_%é", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert base_of(text) == plain_spans(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1112", "192.168.000.1", "1.2.3.4.5.6.7.8", "300.1.1.1", "a.b@c.de",
                                 "x@y", "@", "+1 (132) 555-1352", "+12", "79927398713", " ", ".", "-", "é", "😀", "http://a.b", "token = "]), max_size=12))
def test_base_spans_equal_plain_patterns_on_joined_values(parts):
    text = "".join(parts)
    assert base_of(text) == plain_spans(text)


def found(text):
    return [(KINDS[k], text[a:b]) for a, k, b in scan(text, FINDER) if k >= len(BASE_KINDS)]


def test_the_methods_own_kinds():
    assert found("see https://a.example.com/x?y=1. ok") == [("url", "https://a.example.com/x?y=1")]
    assert found("xhttp://a.example.com http://nohost/ HTTP://B.example:80") == [("url", "HTTP://B.example:80")]
    assert found("write jo.do [at] mail (dot) example.com!") == [("hidden_email", "jo.do [at] mail (dot) example.com")]
    assert found("IBAN: DE89 3704 0044 0532 0130 00, iban DE88 3704 0044 0532 0130 00") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert found("SSN: 219-09-9999 ssn 000-12-3456 lessn 219-09-9998") == [("ssn", "219-09-9999")]
    assert found("Account number: 12-3456-789. on account of some reasons") == [("account", "12-3456-789")]
    assert found('token = "269b1cea0846955d0a"') == [("secret", "269b1cea0846955d0a")]
    assert iban_valid("GB82 WEST 1234 5698 7654 32") and not iban_valid("GB83WEST12345698765432")
    assert luhn("79927398713") and not luhn("79927398710")


def test_long_texts_take_linear_time():
    """The plain patterns are quadratic on these, so they are held on a short form of each."""
    began = time.time()
    for part in ("a", "a@", "1 ", "1.2", "+1", "a@b.", "(at)", "1-", "a.", "+1 ", "token:", "http://a"):
        assert base_of(part * 50) == plain_spans(part * 50)
        base_of(part * 100_000 + "@")
    assert time.time() - began < 30


def test_summary_of_the_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = summary(docs).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        plain = plain_spans(texts[r.doc_id])
        some += len(plain)
        counts = [sum(k == kind for _, k, _ in plain) for kind in range(4)]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        listed = ",".join(f"{BASE_KINDS[k]}:{a}:{b}" for a, k, b in plain)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    assert some > 50


def test_defined_cases(spark, empty, awkward):
    assert summary(empty).collect() == [] and spans(empty).collect() == []
    rows = summary(spark.createDataFrame(AWKWARD + REPEATED, DOCS)).collect()
    assert len(rows) == len(AWKWARD) + 3
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if r.doc_id in (2, 3, 4, 11))
    assert pii.find(awkward).select("doc.*").columns == awkward.columns
    clash = spark.createDataFrame([(1, "me@a.example.com", "no@b.example.com", 5)], "doc_id long, text string, TEXT string, spans int")
    assert [r.spans for r in summary(clash).collect()] == ["email:0:16"]
    assert [tuple(r) for r in spans(clash).collect()] == [(1, "email", 0, 16, True, "me@a.example.com")]


def test_offsets_are_code_points_and_masking_covers_every_span(spark):
    text = "😀 é me@a.example.com, +1 (132) 555-1352 und 10.0.0.1"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], DOCS)
    got = spans(docs).collect()
    assert [(r.kind, text[r.start:r.end]) for r in got] == [(r.kind, r.value) for r in got]
    assert [r.text for r in masked(docs).orderBy("doc_id").collect()] == ["😀 é <email>, <phone> und <ip>", None, ""]
