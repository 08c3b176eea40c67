"""Personal data: Aho-Corasick anchors, expanded and validated by local parsers.

One automaton passes once over each whole text and finds anchors: at-signs,
schemes, plus signs before a digit, digits beside a dot, a blank, a hyphen or
another digit, and identifier cues ("iban", "account", "api_key" …). At each
anchor a small deterministic parser walks left and right to the boundary of
the value and validates it. Parsers of one kind never look at the same
character more than a bounded number of times: an anchor inside a stretch
that its kind has already read is skipped, so the work is linear in the text.

Base kinds are the leftmost non-overlapping matches of fixed patterns:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``     four digit groups with dots between them, each at most 255
* ``card``   12 to 19 digits, single blanks or hyphens between them, passing Luhn
* ``phone``  plus sign and 9 to 15 digits with blanks, brackets, dots, hyphens

A match that fails its check is dropped and not tried again at a later start.
The other kinds are the method's own (``base`` is false): ``url`` behind a
scheme, ``hidden_email`` around a bracketed "at", and ``iban`` (mod 97),
``ssn``, ``account`` and ``secret`` behind their cues.

The job is one pass over the documents, without a shuffle; a task holds one
Arrow batch and the automaton (about 500 short patterns, a constant).

Defined cases: null and empty texts have no spans; offsets are code points,
the end exclusive; spans of different kinds may overlap; every row gives one
row, repeated rows and null ids included; an empty table gives no rows; other
columns are passed through by :func:`find` whatever their names, and ignored
by :func:`spans`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderscope.llm.frames import picked

# Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "hidden_email", "iban", "ssn", "account", "secret")

# Anchors beside the digit ones; a cue also counts Capitalised and in UPPER case.
SCHEMES = ("http://", "https://", "ftp://")
BRACKETED_AT = ("[at]", "(at)", "{at}")
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "customer id", "user id", "passport", "tax id", "member id"),
    "secret": ("api_key", "api key", "apikey", "token", "secret", "password"),
}

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("base", T.BooleanType()), T.StructField("value", T.StringType())])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")
_DIGIT = frozenset("0123456789")

# What may stand right of an anchor, read greedily from a given place.
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ADDRESS = re.compile(r"[^\x00-\x20\x7F<>\"'`{}|\\^]+")
_ADDRESS_HOST = re.compile(r"(?:[^/?#@]*@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|localhost)(?::[0-9]+)?(?=[/?#]|$)")
_HIDDEN_HOST = re.compile(r"\x20{0,2}([A-Za-z0-9-]++(?:(?:\.|\x20{0,2}[\[({](?:dot|DOT|Dot)[\])}]\x20{0,2})[A-Za-z0-9-]++)+)")
_AFTER_CUE = re.compile(r"(?:\x20?(?:number|num|no|nr|id|key|code))?\.?[\"']?\x20{0,2}[:=#]?\x20{0,2}(?:is\x20)?[\"']?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"[A-Za-z0-9](?:-?[A-Za-z0-9]){5,33}+(?![A-Za-z0-9])")
_SECRET = re.compile(r"[A-Za-z0-9_+/=.-]{16,}+")

Span = tuple[str, int, int]


def _octet(label: str) -> bool:
    significant = label.lstrip("0")
    return len(significant) <= 3 and int(significant or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    packed = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1


# A parser takes (text, first and last place of the anchor, end of the last
# stretch its kind has read) and returns that stretch's new end and its spans.
Parser = Callable[[str, int, int, int], tuple[int, list[Span]]]


def _email(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    host = _HOST.match(text, at + 1) if start < at else None
    # a failed at-sign may lie inside the local part's neighbour: nothing before it is read again
    return (host.end(), [("email", start, host.end())]) if host else (at + 1, [])


def _ip(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
    start = at
    while start > done and text[start - 1] in _DIGIT:
        start -= 1
    chain = _DOTTED.match(text, start)
    labels, found, place = chain.group().split("."), [], start
    for i in range(0, len(labels) - 3, 4):
        four = labels[i:i + 4]
        end = place + sum(map(len, four)) + 3
        if all(map(_octet, four)):
            found.append(("ip", place, end))
        place = end + 1
    return chain.end(), found


def _card(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
    chain = _GROUPED.match(text, at)
    digits = chain.group().replace(" ", "").replace("-", "")
    good = 12 <= len(digits) <= 19 and luhn(digits)
    return chain.end(), [("card", at, chain.end())] if good else []


def _phone(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
    found = _PHONE.match(text, at)
    if not found:
        return last + 1, []
    good = 9 <= sum(c in _DIGIT for c in found.group()) <= 15
    return found.end(), [("phone", at, found.end())] if good else []


def _url(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
    body = _ADDRESS.match(text, last + 1)
    if not body or (at and text[at - 1] in _WORD):
        return last + 1, []
    address = body.group().rstrip(".,;:!?)]*'")
    good = _ADDRESS_HOST.match(address)
    return body.end(), [("url", at, last + 1 + len(address))] if good else []


def _hidden(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
    end = at
    while end > done and at - end < 2 and text[end - 1] == " ":
        end -= 1
    start = end
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    host = _HIDDEN_HOST.match(text, last + 1) if start < end else None
    return (host.end(), [("hidden_email", start, host.end())]) if host else (last + 1, [])


def _cued(kind: str, value: re.Pattern, valid: Callable[[str], bool]) -> Parser:
    def parse(text: str, at: int, last: int, done: int) -> tuple[int, list[Span]]:
        if at and text[at - 1] in _WORD:
            return last + 1, []
        found = value.match(text, _AFTER_CUE.match(text, last + 1).end())
        if not found:
            return last + 1, []
        return found.end(), [(kind, found.start(), found.end())] if valid(found.group()) else []
    return parse


def _digits(least: int) -> Callable[[str], bool]:
    return lambda value: sum(c in _DIGIT for c in value) >= least


PARSERS: dict[str, Parser] = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "hidden_email": _hidden,
    "iban": _cued("iban", _IBAN, iban_valid), "ssn": _cued("ssn", _SSN, lambda value: True),
    "account": _cued("account", _ACCOUNT, _digits(4)), "secret": _cued("secret", _SECRET, _digits(2)),
}


def anchors() -> Iterator[tuple[str, str]]:
    """Every anchor with the kind whose parser it starts."""
    yield "@", "email"
    digits = "0123456789"
    for a in digits:
        yield f"+{a}", "phone"
        for b in digits:
            yield f"{a}.{b}", "ip"
            for between in ("", " ", "-"):
                yield f"{a}{between}{b}", "card"
    for scheme in SCHEMES:
        yield from ((form, "url") for form in (scheme, scheme.upper()))
    for sign in BRACKETED_AT:
        yield from ((form, "hidden_email") for form in (sign, sign.upper()))
    for kind, cues in CUES.items():
        for cue in cues:
            yield from ((form, kind) for form in {cue, cue.capitalize(), cue.upper()})


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for anchor, kind in anchors():
        made.add_word(anchor, (len(anchor), KINDS.index(kind)))
    made.make_automaton()
    return made


def scan(text: str, finder: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """All spans of one text as ``(start, kind number, end)``, sorted."""
    done, out = [0] * len(KINDS), []
    for last, (length, kind) in finder.iter(text):
        at = last - length + 1
        if at < done[kind]:
            continue
        done[kind], found = PARSERS[KINDS[kind]](text, at, last, done[kind])
        out.extend((start, kind, end) for _, start, end in found)
    out.sort()
    return out


def _scan_batches(text_col: str) -> Callable:
    n_base = len(BASE_KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch in batches:
            rows = batch.column(0)
            texts = rows.field(rows.type.get_field_index(text_col))
            offsets, kinds, starts, ends, values = [0], [], [], [], []
            for cell in texts:
                text = cell.as_py() or ""
                for start, kind, end in scan(text, finder):
                    kinds.append(kind)
                    starts.append(start)
                    ends.append(end)
                    values.append(text[start:end])
                offsets.append(len(kinds))
            names = pa.array(KINDS).take(pa.array(kinds, pa.int32()))
            spans_ = pa.StructArray.from_arrays(
                [names, pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array([k < n_base for k in kinds], pa.bool_()),
                 pa.array(values, pa.string())], ["kind", "start", "end", "base", "value"])
            yield pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans_)], ["doc", "spans"])
    return run


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows ``doc`` (all columns of ``docs``, as a struct) and ``spans``, an array of kind, start, end, base, value."""
    schema = T.StructType([T.StructField("doc", docs.schema), T.StructField("spans", T.ArrayType(SPAN))])
    placed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    whole = placed.select(F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]).alias("doc"))
    return whole.mapInArrow(_scan_batches(text_col), schema)


def listed(spans_: Column) -> Column:
    """``kind:start:end``, comma-joined in the order of the spans."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans_: Column) -> Column:
    return F.filter(spans_, lambda s: s["base"])


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, the base spans' digest, and all spans as text."""
    slim = picked(docs, doc_id=id_col, text=text_col)
    spans_ = F.col("spans")
    of_kind = lambda kind: F.filter(spans_, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS]
    return find(slim).select("doc.doc_id", *counts, F.sha2(listed(base_spans(spans_)), 256).alias("base_sha256"), listed(spans_).alias("spans"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each span: ``doc_id, kind, start, end, base, value``."""
    slim = picked(docs, doc_id=id_col, text=text_col)
    return find(slim).select("doc.doc_id", F.inline("spans"))


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; of overlapping spans the first one's."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch in batches:
            out = []
            for cell in batch.column(place):
                text = cell.as_py()
                parts, at = [], 0
                for start, kind, end in scan(text or "", finder):
                    if start >= at:
                        parts += [text[at:start], f"<{KINDS[kind]}>"]
                    at = max(at, end)
                out.append(None if text is None else "".join(parts) + text[at:])
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))
    return docs.mapInArrow(run, docs.schema)
