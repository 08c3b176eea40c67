"""Exact substring deduplication by recompression.

A window is ``window`` consecutive words of one document. Every word covered
by a window whose word sequence also starts earlier (smaller id, or the same
document at an earlier word) is removed; windows are judged on the input.

Recompression replaces words by names and then, round after round, pairs and
runs of names by new names. In a round every name is left or right by a bit
of its hash, and a left name followed by a right one becomes one symbol, so
whether two neighbours merge depends on those two alone: equal word sequences
get equal interior symbols wherever they stand. A new name is a 64-bit mix of
the pair (or of the name and its run length) and the round, so names agree
over the whole table without a dictionary that would have to be joined to
every position once a round. Runs are named from round ``ANCHOR_ROUNDS`` on:
below that, to know that a run has ended takes one word more on either side.

1. *Reveal.* For each symbol we keep its context, the words that decide it. A
   window that holds a symbol's context holds the symbol wherever its words
   stand. A window's anchor is the longest symbol (ties: largest name) whose
   context lies in it, of the highest of the first ``ANCHOR_ROUNDS`` rounds
   that has one (at round 0 its words); its words alone decide it. Spark
   groups the anchors of all documents by name. A window whose anchor occurs
   once occurs once itself. From the higher rounds, symbols of at
   least ``window`` words go the same way with a second 64-bit hash of their
   words: all windows inside any but the first of equal ones are repeats.
2. *Verify.* The windows not decided so far are grouped by a 96-bit hash of
   their words; all but the first of a group are repeats.

Scale. Texts are shuffled once (one exchange, used three times). Anchors,
about a sixth as many as words, are one shuffle; windows follow only for
shared anchors. Before each shuffle a task sends one row per name and batch,
so a passage in a third of all documents is a few rows a task. Groups are
streams of sorted rows and are never gathered.

Defined cases: null text has no words (0, 0, ""); fewer words than a window:
nothing is removed; every row is a document of its own; rows that share an id
come in the order of their texts' hashes (null first), a null id is smaller
than all others and is returned as null; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderscope.llm.frames import one_text_per_id, own_keys
from orderscope.llm.words import WHITE, Piece, hash_pair, mix, pieces

WINDOW_WORDS = 20
ANCHOR_ROUNDS = 4
HIGH_ROUNDS = (11, 14, 17, 20)      # rounds whose long symbols are compared whole
FAR = 1 << 40                       # beyond any word: context that leaves the document
TEXT_PIECE = 1 << 21
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)   # odd


class Symbols:
    """The symbols of one round over the documents of a piece."""

    def __init__(self, name: np.ndarray, at: np.ndarray, last: np.ndarray,
                 low: np.ndarray | None, high: np.ndarray | None) -> None:
        self.name, self.at, self.last, self.low, self.high = name, at, last, low, high

    @classmethod
    def words(cls, piece: Piece) -> Symbols:
        n = len(piece.start)
        last = np.zeros(n, dtype=bool)
        ends = piece.first[1:] - 1
        last[ends[piece.counts() > 0]] = True
        at = np.arange(n)
        return cls(piece.hashes(0), at, last, at, at + 1)

    def pairs(self, round_: int) -> Symbols:
        """Merge each left name with a right one after it."""
        left = (mix(self.name ^ np.uint64(round_ * 0x5851F42D4C957F2D & (1 << 64) - 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(left), dtype=bool)
        joins[:-1] = left[:-1] & ~left[1:] & ~self.last[:-1]
        joined = np.zeros(len(left), dtype=bool)
        joined[1:] = joins[:-1]
        low = high = None
        if self.low is not None:
            before = np.empty_like(self.low)
            before[1:] = self.low[:-1]
            starts = np.empty_like(self.last)
            starts[1:] = self.last[:-1]
            if len(starts):
                starts[0] = True
            before[starts] = -FAR
            after = np.empty_like(self.high)
            after[:-1] = self.high[1:]
            after[self.last] = FAR
            low = np.where(~left & ~joined, np.minimum(self.low, before), self.low)
            high = np.where(left & ~joins, np.maximum(self.high, after), self.high)
        return self._merge(joins, joined, round_, low, high)

    def _merge(self, joins: np.ndarray, joined: np.ndarray, round_: int,
               low: np.ndarray | None, high: np.ndarray | None) -> Symbols:
        first = np.flatnonzero(joins)
        name, last = self.name.copy(), self.last.copy()
        name[first] = hash_pair(self.name[first], self.name[first + 1], 2 * round_)
        last[first] = self.last[first + 1]
        if low is not None:
            low[first] = np.minimum(low[first], low[first + 1])
            high[first] = np.maximum(high[first], high[first + 1])
        keep = ~joined
        return Symbols(name[keep], self.at[keep], last[keep],
                       None if low is None else low[keep], None if high is None else high[keep])

    def runs(self, round_: int) -> Symbols:
        """Merge each run of one name (contexts are not kept here)."""
        n = len(self.name)
        goes_on = np.zeros(n, dtype=bool)
        goes_on[1:] = (self.name[1:] == self.name[:-1]) & ~self.last[:-1]
        head = np.flatnonzero(~goes_on)
        length = np.diff(np.append(head, n))
        name = self.name[head].copy()
        many = length > 1
        name[many] = hash_pair(name[many], length[many].astype(np.uint64), 2 * round_ + 1)
        return Symbols(name, self.at[head], self.last[head + length - 1], None, None)


class Anchors:
    """The anchor of every window of a piece.

    ``levels``: (level, names, words) of the chosen symbols; ``level_of`` and
    ``word_of``: each window's choice; ``valid``: the windows there are.
    """

    def __init__(self, piece: Piece, window: int) -> None:
        n = len(piece.start)
        start, end = piece.first[:-1], piece.first[1:]
        counts = piece.counts()
        wide = counts >= window
        edge = np.bincount(start[wide], minlength=n + 1) - np.bincount(end[wide] - window + 1, minlength=n + 1)
        self.valid = np.cumsum(edge)[:n + 1] > 0
        first_of, last_of = np.repeat(start, counts), np.repeat(end - window, counts)
        rounds = [Symbols.words(piece)]
        for round_ in range(1, ANCHOR_ROUNDS + 1):
            rounds.append(rounds[-1].pairs(round_))
        self.top = rounds[-1]
        self.level_of = np.zeros(n + 1, dtype=np.int8)
        self.word_of = np.zeros(n + 1, dtype=np.int64)
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left = np.flatnonzero(self.valid)
        for level in range(ANCHOR_ROUNDS, -1, -1):
            x = rounds[level]
            fits = np.flatnonzero(x.high - x.low <= window)
            low = np.maximum(x.high[fits] - window, first_of[x.at[fits]])
            high = np.minimum(x.low[fits], last_of[x.at[fits]])
            some = low <= high
            fits, low, high = fits[some], low[some], high[some]
            # contexts move to the right with their symbols, so a window's symbols are consecutive
            begin, stop = np.searchsorted(high, left, "left"), np.searchsorted(low, left, "right")
            at = x.at[fits]
            span = np.append(x.at, n)[fits + 1] - at
            weight = (np.minimum(span, 255).astype(np.uint64) << np.uint64(56)) | (x.name[fits] >> np.uint64(8))
            best = begin.copy()
            todo, step = np.flatnonzero(stop - begin > 1), 1
            while len(todo):
                other = begin[todo] + step
                better = weight[other] > weight[best[todo]]
                best[todo[better]] = other[better]
                step += 1
                todo = todo[stop[todo] - begin[todo] > step]
            has = stop > begin
            chosen = np.unique(best[has])
            self.level_of[left[has]] = level
            self.word_of[left[has]] = at[best[has]]
            name = x.name[fits[chosen]]
            self.levels.append((level, hash_pair(name, np.full(len(name), level, np.uint64), 999), at[chosen]))
            left = left[~has]

    def candidates(self, shared: dict[int, np.ndarray]) -> np.ndarray:
        """Windows whose anchor is shared; ``shared``: level → word mask."""
        out = np.zeros(len(self.valid), dtype=bool)
        for level, marks in shared.items():
            out |= (self.level_of == level) & marks[self.word_of]
        return out & self.valid


def _marked(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Which of 0..n lie in any of the closed intervals."""
    return np.cumsum(np.bincount(low, minlength=n + 2) - np.bincount(high + 1, minlength=n + 2))[:n + 1] > 0


def sequence_hash(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``length`` consecutive words, by doubling."""
    have, out, power, acc_len = 1, words, np.uint64(base), 0
    acc: np.ndarray | None = None
    while True:
        if length & have:
            if acc is None:
                acc = out
            else:
                m = len(words) - acc_len - have + 1
                acc = acc[:m] * power + out[acc_len:acc_len + m]
            acc_len += have
        if acc_len == length:
            return acc
        m = len(out) - have
        out = out[:m] * power + out[have:]
        power, have = np.uint64(int(power) ** 2 & (1 << 64) - 1), 2 * have


def _long_symbols(piece: Piece, symbols: Symbols, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(name, check, word, words) of long symbols, each symbol once."""
    n = len(piece.start)
    power = np.cumprod(np.full(n + 1, _BASE[1], np.uint64))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece.hashes(1) * power[:n])])
    undo = np.cumprod(np.full(n + 1, pow(_BASE[1], -1, 1 << 64), np.uint64))
    seen = np.zeros(n + 1, dtype=np.int64)
    doc_end = np.repeat(piece.first[1:], piece.counts())
    for round_ in range(ANCHOR_ROUNDS + 1, max(HIGH_ROUNDS) + 1):
        symbols = symbols.runs(round_).pairs(round_)
        if round_ in HIGH_ROUNDS:
            at = symbols.at
            to = np.append(at[1:], n)
            if n:
                to = np.minimum(to, doc_end[at])
            new = (to - at >= window + 4) & (seen[at] != to)
            at, to, name = at[new], to[new], symbols.name[new]
            seen[at] = to
            yield name, (prefix[to] - prefix[at]) * undo[at], at, to - at


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def _firsts(order_keys: tuple[np.ndarray, ...], same: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order, group number of each sorted row, and which sorted rows are first."""
    order = np.lexsort(order_keys[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in same], axis=0)
    return order, np.cumsum(new) - 1, new


def _name_rows(window: int) -> Callable:
    """Anchors and long symbols of each batch: one row for each name, and rows for what is already decided."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            found: list[tuple[np.ndarray, ...]] = []
            for piece in pieces(batch.column(1), WHITE, limit=TEXT_PIECE):
                if not len(piece.start):
                    continue
                doc = piece.doc_of_word()
                anchors = Anchors(piece, window)
                for level, name, at in anchors.levels:
                    found.append((name.view(np.int64), np.zeros(len(at), np.int64), keys[piece.row + doc[at]],
                                  at - piece.first[doc[at]], np.full(len(at), -1 - level)))
                for name, check, at, length in _long_symbols(piece, anchors.top, window):
                    found.append((name.view(np.int64), check.view(np.int64), keys[piece.row + doc[at]],
                                  at - piece.first[doc[at]], length))
            if not found:
                continue
            name, check, key, at, length = (np.concatenate(x) for x in zip(*found, strict=True))
            order, group, first = _firsts((name, check, key, at), (name, check))
            name, check, key, at, length = (x[order] for x in (name, check, key, at, length))
            many = np.bincount(group)[group] > 1
            # rows past the first of a name are decided here; they only pass through, dealt out by place
            name = np.where(first, name, hash_pair(key.view(np.uint64), at.astype(np.uint64), 7).view(np.int64))
            yield _batch({"name": name, "key": key, "place": (length << 32) | at, "check": np.where(first, check, 0),
                          "many": np.where(first, many, 2).astype(np.int8)})
    return run


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that rows equal in the first column stay together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        n = len(held[0])
        if n:
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield [x[:cut] for x in held]
                held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield held


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (name, check, key, at): shared anchors and long repeats."""
    for name, key, place, check, many in _whole_groups(batches):
        at, length = place & 0xFFFFFFFF, place >> 32
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
        group = np.cumsum(new) - 1
        anchor = length < 0
        is_shared = (np.bincount(group)[group] > 1) | (many > 0)
        keep = np.where(anchor, is_shared, ~new | (many == 2))
        yield _batch({"key": key[keep], "at": at[keep].astype(np.int32), "len": length[keep].astype(np.int32)})


def _window_rows(window: int) -> Callable:
    """Hash rows of undecided windows, and ranges of windows known to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            found: list[tuple[np.ndarray, ...]] = []
            known: list[tuple[np.ndarray, ...]] = []
            for piece in pieces(batch.column(1), WHITE, limit=TEXT_PIECE):
                if len(piece.start) < window:
                    continue
                rows = slice(piece.row, piece.row + piece.n_docs + 1)
                mine = flat[offsets[rows][0]:offsets[rows][-1]]
                at = (mine >> 32) + np.repeat(piece.first[:-1], np.diff(offsets[rows]))
                length = (mine & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
                n = len(piece.start)
                shared = {}
                for level in range(ANCHOR_ROUNDS + 1):
                    shared[level] = np.zeros(n + 1, dtype=bool)
                    shared[level][at[length == -1 - level]] = True
                anchors = Anchors(piece, window)
                long_at, long_to = at[length > 0], (at + length)[length > 0] - window
                repeats = _marked(long_at, long_to, n)
                undecided = np.flatnonzero(anchors.candidates(shared) & ~repeats)
                doc = piece.doc_of_word()
                if len(undecided):
                    h = [sequence_hash(piece.hashes(2 + i), window, _BASE[i])[undecided] for i in range(2)]
                    found.append((h[0].view(np.int64), h[1].view(np.int64) >> 32, keys[piece.row + doc[undecided]],
                                  undecided - piece.first[doc[undecided]]))
                known.append((keys[piece.row + doc[long_at]], long_at - piece.first[doc[long_at]], long_to - long_at + 1))
            if found:
                h1, h2, key, at = (np.concatenate(x) for x in zip(*found, strict=True))
                order, _, first = _firsts((h1, h2, key, at), (h1, h2))
                h1, h2, key, at = (x[order] for x in (h1, h2, key, at))
                known.append((key[~first], at[~first], np.ones(int((~first).sum()), np.int64)))
                yield _batch({"h1": h1[first], "h2_at": (h2[first] << 32) | at[first], "key": key[first],
                              "len": np.zeros(int(first.sum()), np.int32)})
            if known:
                key, at, length = (np.concatenate(x) for x in zip(*known, strict=True))
                key, at, length = merged(key, at, length)
                yield _batch({"h1": hash_pair(key.view(np.uint64), at.astype(np.uint64), 8).view(np.int64),
                              "h2_at": at, "key": key, "len": length.astype(np.int32)})
    return run


def merged(key: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join ranges of one key that overlap or touch."""
    if not len(key):
        return key, at, length
    order = np.lexsort((at, key))
    key, at, to = key[order], at[order], (at + length)[order]
    doc = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    step = int(to.max()) + 2
    reach = np.maximum.accumulate(to + doc * step)
    new = np.ones(len(key), dtype=bool)
    new[1:] = at[1:] + doc[1:] * step > reach[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(key)) - 1
    return key[head], at[head], reach[tail] - doc[tail] * step - at[head]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (h1, h2, key, at), the last three as kept in ``h2_at`` and ``key``: all but the first window of each group, and known ranges."""
    for h1, h2_at, key, length in _whole_groups(batches):
        h2, at = h2_at >> 32, h2_at & 0xFFFFFFFF
        new = np.ones(len(h1), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        keep = ~new | (length > 0)
        yield _batch({"key": key[keep], "at": at[keep].astype(np.int32), "len": np.maximum(length[keep], 1)})


def _kept(window: int, untouched_as_is: bool) -> Callable:
    """Drop the words under repeated windows; the words left have a space after each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            keys = batch.column(0)
            for piece in pieces(batch.column(1), WHITE, limit=TEXT_PIECE):
                rows = slice(piece.row, piece.row + piece.n_docs + 1)
                mine = flat[offsets[rows][0]:offsets[rows][-1]]
                at = (mine >> 32) + np.repeat(piece.first[:-1], np.diff(offsets[rows]))
                n = len(piece.start)
                gone = _marked(at, at + (mine & 0xFFFFFFFF) + window - 2, n)[:n]
                doc = piece.doc_of_word()
                counts = piece.counts()
                removed = np.bincount(doc[gone], minlength=piece.n_docs)
                data, _, end = piece.joined(~gone)
                ends = np.concatenate([[0], end + 1])[np.concatenate([[0], np.cumsum(counts - removed)])]
                texts = pa.LargeStringArray.from_buffers(
                    piece.n_docs, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
                if untouched_as_is:
                    whole = batch.column(1).slice(piece.row, piece.n_docs)
                    spaced = pc.binary_join_element_wise(whole, " ", "")
                    texts = pc.if_else(pa.array(removed == 0), spaced, texts)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(piece.row, piece.n_docs), pa.array(counts.astype(np.int64)),
                     pa.array(removed.astype(np.int64)), texts], ["key", "n_words", "n_removed", "spaced"])
    return run


def _lists(rows: DataFrame) -> DataFrame:
    """All (at, len) of a key packed into one list; a list is no longer than its document."""
    packed = F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("len").cast("bigint").bitwiseAND(0xFFFFFFFF)
    return rows.groupBy("key").agg(F.collect_list(packed).alias("places"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW_WORDS, untouched_as_is: bool = False) -> DataFrame:
    """Rows ``doc_id, n_words, n_removed, kept_text``; kept words are joined by one space.

    With ``untouched_as_is`` a document that loses no word keeps its text (null included).
    """
    rows, restored = own_keys(docs, id_col, text_col)
    texts = one_text_per_id(rows, "key", "text")

    def with_places(rows: DataFrame) -> DataFrame:
        return texts.join(_lists(rows).hint("merge"), "key", "left") \
            .select("key", "text", F.coalesce("places", F.array().cast("array<bigint>")).alias("places"))

    # what differs from row to row stands side by side, which the shuffle's compression rewards
    names = texts.mapInArrow(_name_rows(window), "name bigint, key bigint, place bigint, check bigint, many tinyint")
    shared = names.repartition("name").sortWithinPartitions("name", "check", "key", "place") \
        .mapInArrow(_shared, "key bigint, at int, len int")
    windows = with_places(shared).mapInArrow(_window_rows(window), "h1 bigint, h2_at bigint, key bigint, len int")
    repeats = windows.repartition("h1").sortWithinPartitions("h1", F.shiftright("h2_at", 32), "key", "h2_at") \
        .mapInArrow(_repeated, "key bigint, at int, len int")
    kept = with_places(repeats).mapInArrow(_kept(window, untouched_as_is), "key bigint, n_words bigint, n_removed bigint, spaced string")
    return restored(kept.select("key", "n_words", "n_removed", F.expr("substring(spaced, 1, length(spaced) - 1)").alias("kept_text")))
