"""Token counts of sections by offset-mapped attribution.

Whole documents are encoded once with a byte-level BPE vocabulary. Token ids
give byte spans (a token's length is its entry's length), byte spans give
character spans, and these are interval-joined to the document's sections.
Encoding sections apart would give other tokens at their edges; here the
counts of a document's sections always sum to its own token count.

Sections are given as character ranges in an array column, or are the text's
lines, each with its line break. A token that crosses a boundary goes, by
``rule``, to the section with its ``first`` byte, its ``last`` byte or
``most`` of its bytes (ties: the earlier), or is split by ``share`` of bytes.

Scale. One pass without a shuffle; a document's tokens live in one task. The
vocabulary file (under 1 MB) is read once by each worker from ``vocabulary``,
or its bytes may be handed over for clusters without the file.

Defined cases: null and empty texts have one empty section without tokens;
text outside all given sections is in section -1 (there is one only if it has
tokens); given sections that overlap or run out of the text are cut to what
is left after the earlier ones; a null id is returned as null; repeated rows are
counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderscope.llm.words import FOLLOW

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "most", "share")
OUT = "doc_id bigint, section int, start bigint, end bigint, n_tokens double, n_crossing bigint"


class Encoder:
    """A vocabulary and the byte length of each of its entries."""

    def __init__(self, lines: bytes) -> None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for entry, rank in ranks.items():
            self.length[rank] = len(entry)

    def ends(self, text: str) -> np.ndarray:
        """Byte end of every token."""
        return np.cumsum(self.length[np.array(self.encoding.encode_ordinary(text), dtype=np.int64)])


def line_sections(data: np.ndarray) -> np.ndarray:
    """Byte bounds of a text's lines, each with its break."""
    ends = np.flatnonzero(data == 10) + 1
    return np.concatenate([[0], ends, [len(data)]] if not len(ends) or ends[-1] < len(data) or not len(data) else [[0], ends])


def given_sections(ranges: np.ndarray, char_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint byte bounds from character ranges, and each stretch's section (-1 between them)."""
    n, at = len(char_at) - 1, 0
    byte_of = lambda c: int(np.searchsorted(char_at[:-1], c, "left")) if c < char_at[-1] else n
    bounds, names = [0], []
    for i in np.argsort(ranges[:, 0], kind="stable") if len(ranges) else ():
        low, high = max(byte_of(ranges[i, 0]), at), max(byte_of(ranges[i, 1]), at)
        if low > at:
            bounds.append(low)
            names.append(-1)
        bounds.append(high)
        names.append(int(i))
        at = high
    if at < n:
        bounds.append(n)
        names.append(-1)
    return np.array(bounds), np.array(names, dtype=np.int64)


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each stretch between bounds by the rule, and tokens that cross out of or into it."""
    n = len(bounds) - 1
    tokens, crossing = np.zeros(n), np.zeros(n, dtype=np.int64)
    if not len(ends):
        return tokens, crossing
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crosses = np.flatnonzero(last > first)
    np.add.at(crossing, first[crosses], 1)
    np.add.at(crossing, last[crosses], 1)
    if rule == "first":
        np.add.at(tokens, first, 1)
    elif rule == "last":
        np.add.at(tokens, last, 1)
    else:
        np.add.at(tokens, first[last == first], 1)
        for t in crosses:
            own = np.arange(first[t], last[t] + 1)
            overlap = np.minimum(bounds[own + 1], ends[t]) - np.maximum(bounds[own], starts[t])
            if rule == "most":
                tokens[own[overlap.argmax()]] += 1
            else:
                tokens[own] += overlap / (ends[t] - starts[t])
    return tokens, crossing


def section_rows(text: str, ranges: np.ndarray | None, encoder: Encoder, rule: str) -> np.ndarray:
    """Rows (section, start, end, tokens, crossing) of one text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    char_at = np.concatenate([[0], np.cumsum(~FOLLOW[data])])
    if ranges is None:
        bounds = line_sections(data)
        names = np.arange(len(bounds) - 1)
    else:
        # char_at[b]: characters that begin before byte b; a byte's character is that of its lead byte
        lead = np.append(np.cumsum(~FOLLOW[data]) - 1, char_at[-1])
        bounds, names = given_sections(ranges, lead)
    tokens, crossing = attribute(encoder.ends(text), bounds, rule)
    rows = np.column_stack([names, char_at[bounds[:-1]], char_at[bounds[1:]], tokens, crossing])
    return rows[(names >= 0) | (tokens > 0)]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: str, lines: bytes | None) -> Encoder:
    """The worker's encoder for a vocabulary, made once."""
    if vocabulary not in _ENCODERS:
        if lines is None:
            with open(vocabulary, "rb") as file:
                lines = file.read()
        _ENCODERS[vocabulary] = Encoder(lines)
    return _ENCODERS[vocabulary]


def _lengths(vocabulary: str, lines: bytes | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary, lines).encoding.encode_ordinary
        for batch in batches:
            counts = pa.array([len(encode(cell.as_py() or "")) for cell in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["doc_id", "n_tokens"])
    return run


def token_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                  lines: bytes | None = None) -> DataFrame:
    """Rows ``doc_id, n_tokens``, one for each row of ``docs``; null and empty texts have none."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_lengths(vocabulary, lines), "doc_id bigint, n_tokens bigint")


def _count(vocabulary: str, lines: bytes | None, rule: str, with_ranges: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, lines)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                ranges = part.column(2).to_pylist() if with_ranges else None
                found = [section_rows(t or "", np.array([(r["start"], r["end"]) for r in ranges[i] or []], np.int64).reshape(-1, 2)
                                      if with_ranges else None, encoder, rule) for i, t in enumerate(texts)]
                owner = np.repeat(np.arange(len(found)), [len(r) for r in found])
                rows = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(owner)), pa.array(rows[:, 0].astype(np.int32)),
                    pa.array(rows[:, 1].astype(np.int64)), pa.array(rows[:, 2].astype(np.int64)),
                    pa.array(rows[:, 3]), pa.array(rows[:, 4].astype(np.int64))],
                    ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])
    return run


def section_tokens(docs: DataFrame, rule: str = "first", id_col: str = "doc_id", text_col: str = "text",
                   sections_col: str | None = None, vocabulary: str = VOCABULARY, lines: bytes | None = None) -> DataFrame:
    """Rows ``doc_id, section, start, end, n_tokens, n_crossing``, one per section.

    ``start`` and ``end`` are characters. ``sections_col``: an array of
    structs ``(start, end)``; by default sections are lines.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if sections_col:
        columns.append(F.col(sections_col).cast("array<struct<start:bigint,end:bigint>>").alias("sections"))
    return docs.select(*columns).mapInArrow(_count(vocabulary, lines, rule, sections_col is not None), OUT)
