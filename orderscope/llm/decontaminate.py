"""Benchmark decontamination with a distributed positional inverted index.

*Index.* Each task turns its documents into shards of a few megabytes of
text. A shard is one row: the documents' word counts and, for every test
term (a word of the benchmark), its posting list of word positions. The index
is saved in the shared folder and read twice, so texts are tokenised once
for each block of the test set.
It is split by documents: a posting list never leaves its shard.

*Search.* Term frequencies are summed over the whole index. A window (ten
consecutive item words, or all words of a shorter item) starts from the
posting list of its rarest term, moved back by the term's offset, and is
intersected with the moved lists of the next rarer terms until all words
agree: an exact phrase match. A proximity match has the other two of a window's
three rarest different terms within ``slop`` words of the rarest (one other
where a window has two different terms; a window of one has no proximity match).

Scale. No text is shuffled; a document sends one row with merged hit ranges
and item ids. The test set is sent to tasks in blocks of ``BLOCK_WORDS``
words (a documented bound on what a task holds; a longer item is a block of
its own); a test set of any size is searched block by block and the hits are
merged. Candidates are checked a bounded number at a time.

Defined cases: null or empty text has no words and is not contaminated; null
or wordless items never occur; a null item id is the item ``""``; items that
share an id count once; a null document id is returned as null; repeated rows
are returned as often as they come; empty tables give no rows, or rows
without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderscope.llm.frames import id_key, key_id, saved
from orderscope.llm.words import NOT_ALNUM, Piece, pieces

WINDOW_WORDS = 10
SLOP_WORDS = 20
NEAR_TERMS = 3
BLOCK_WORDS = 1 << 20
CANDIDATES_AT_ONCE = 1 << 20


@dataclass
class Tests:
    """One block of the test set: terms (sorted hashes), windows of term numbers, and their items."""

    terms: np.ndarray
    windows: np.ndarray         # (windows, window words), -1 after the end of a short one
    item_first: np.ndarray      # items of window w: items[item_first[w]:item_first[w + 1]]
    items: np.ndarray
    names: list[str]


def read_tests(names: list[str | None], texts: list[str | None], window: int) -> Tests:
    """Tokenise a block of items and number its terms and different windows."""
    ids = sorted({n or "" for n in names})
    number = {name: i for i, name in enumerate(ids)}
    rows: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    for piece in pieces(pa.array(texts, pa.string()), NOT_ALNUM, lower=True):
        words = piece.hashes()
        for d in range(piece.n_docs):
            own = words[piece.first[d]:piece.first[d + 1]]
            if len(own):
                hashes.append(own)
                cut = np.lib.stride_tricks.sliding_window_view(own, min(window, len(own)))
                grid = np.zeros((len(cut), window + 1), np.uint64)
                grid[:, :cut.shape[1]] = cut
                grid[:, window] = cut.shape[1]
                rows.append(grid)
                owner.append(np.full(len(cut), number[names[piece.row + d] or ""]))
    if not rows:
        return Tests(np.zeros(0, np.uint64), np.zeros((0, window), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), ids)
    terms = np.unique(np.concatenate(hashes))
    grid, items = np.concatenate(rows), np.concatenate(owner)
    length = grid[:, window].astype(np.int64)
    inside = np.arange(window) < length[:, None]
    windows = np.where(inside, np.searchsorted(terms, grid[:, :window]), -1)
    windows, which = np.unique(windows, axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack([which.ravel(), items]), axis=0)
    return Tests(terms, windows, np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1)), pairs[:, 1], ids)


def _index(terms: np.ndarray) -> Callable:
    """Shard rows: documents, word counts, and the postings of the test terms."""
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[(terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(2), NOT_ALNUM, lower=True):
                words = piece.hashes()
                at = np.flatnonzero(maybe[(words & np.uint64((1 << 20) - 1)).astype(np.int64)])
                term = np.minimum(np.searchsorted(terms, words[at]), max(len(terms) - 1, 0))
                known = terms[term] == words[at] if len(terms) else np.zeros(len(at), bool)
                at, term = at[known].astype(np.int32), term[known].astype(np.int32)
                order = np.argsort(term, kind="stable")
                used, first = np.unique(term[order], return_index=True)
                rows = slice(piece.row, piece.row + piece.n_docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column(0).to_numpy()[rows].tobytes()], pa.binary()),
                    pa.array([batch.column(1).to_numpy()[rows].tobytes()], pa.binary()),
                    pa.array([piece.counts().astype(np.int64).tobytes()], pa.binary()),
                    pa.array([used.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([np.append(first, len(order)).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([at[order].tobytes()], pa.binary())], ["keys", "texts", "counts", "terms", "starts", "postings"])
    return run


def _array(batch: pa.RecordBatch, column: str, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), dtype=kind)


def _frequencies(n_terms: int) -> Callable:
    """Posting counts of every term over the shards of a task: one row per term met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                total[_array(batch, "terms", row, np.int32)] += np.diff(_array(batch, "starts", row, np.int64))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["term", "n"])
    return run


@dataclass
class Shard:
    """One index row, with the term at each word position scattered from the postings."""

    counts: np.ndarray
    first: np.ndarray
    place: np.ndarray           # term → its place in ``starts``, -1 if absent
    starts: np.ndarray
    postings: np.ndarray
    term_at: np.ndarray
    sorted_: np.ndarray         # (term, position) as one number, ascending

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int, n_terms: int) -> Shard:
        counts, used = _array(batch, "counts", row, np.int64), _array(batch, "terms", row, np.int32)
        starts, postings = _array(batch, "starts", row, np.int64), _array(batch, "postings", row, np.int32)
        first = np.concatenate([[0], np.cumsum(counts)])
        place = np.full(n_terms, -1)
        place[used] = np.arange(len(used))
        by_posting = np.repeat(used, np.diff(starts))
        term_at = np.full(first[-1], -1, np.int32)
        term_at[postings] = by_posting
        return cls(counts, first, place, starts, postings, term_at, (by_posting.astype(np.int64) << 32) | postings)


def near_terms(windows: np.ndarray, by_rarity: np.ndarray) -> np.ndarray:
    """Each window's rarest different terms, ``NEAR_TERMS`` or as many as there are (then -1)."""
    ordered = np.take_along_axis(windows, by_rarity, axis=1)
    again = np.zeros(ordered.shape, bool)
    for j in range(1, ordered.shape[1]):
        again[:, j] = (ordered[:, :j] == ordered[:, j:j + 1]).any(axis=1)
    fresh = (ordered >= 0) & ~again
    front = np.argsort(~fresh, axis=1, kind="stable")[:, :NEAR_TERMS]
    return np.where(np.take_along_axis(fresh, front, axis=1), np.take_along_axis(ordered, front, axis=1), -1)


def search(shard: Shard, tests: Tests, by_rarity: np.ndarray, rarest: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, word of the match, is_exact) of exact and proximity matches.

    ``by_rarity``: each window's word offsets, rarest term first; ``rarest``:
    its rarest different terms.
    """
    pivot = tests.windows[np.arange(len(by_rarity)), by_rarity[:, 0]]
    at = shard.place[pivot]
    rows = np.flatnonzero(at >= 0)
    if not len(rows):
        return
    size = shard.starts[at[rows] + 1] - shard.starts[at[rows]]
    block = np.concatenate([[0], np.cumsum(size)]) // CANDIDATES_AT_ONCE
    cuts = np.flatnonzero(np.append(True, block[1:-1] != block[:-2]))
    for low, high in zip(cuts, np.append(cuts[1:], len(rows)), strict=True):
        w = np.repeat(rows[low:high], size[low:high])
        step = np.arange(len(w)) - np.repeat(np.cumsum(size[low:high]) - size[low:high], size[low:high])
        pos = shard.postings[shard.starts[at[w]] + step].astype(np.int64)
        doc = np.searchsorted(shard.first, pos, "right") - 1
        length = (tests.windows[w] >= 0).sum(axis=1)
        start = pos - by_rarity[w, 0]
        alive = (start >= shard.first[doc]) & (start + length <= shard.first[doc + 1])
        for j in range(1, tests.windows.shape[1]):
            go = np.flatnonzero(alive)
            offset = by_rarity[w[go], j]
            term = tests.windows[w[go], offset]
            more = term >= 0
            alive[go[more]] = shard.term_at[start[go[more]] + offset[more]] == term[more]
        yield w[alive], start[alive], np.ones(int(alive.sum()), bool)
        near = ~alive & (rarest[w, 1] >= 0 if rarest.shape[1] > 1 else False)
        for j in range(1, rarest.shape[1]):
            go = np.flatnonzero(near & (rarest[w, j] >= 0))
            term = rarest[w[go], j].astype(np.int64) << 32
            low_word = np.maximum(pos[go] - slop, shard.first[doc[go]])
            high_word = np.minimum(pos[go] + slop, shard.first[doc[go] + 1] - 1)
            found = np.minimum(np.searchsorted(shard.sorted_, term | low_word), len(shard.sorted_) - 1)
            hit = shard.sorted_[found]
            near[go] = (hit >= (term | low_word)) & (hit <= (term | high_word))
        yield w[near], pos[near], np.zeros(int(near.sum()), bool)


def _search(tests: Tests, frequency: np.ndarray, slop: int) -> Callable:
    weight = np.where(tests.windows >= 0, frequency[tests.windows], np.iinfo(np.int64).max) if len(tests.terms) else tests.windows
    by_rarity = np.argsort(weight, axis=1, kind="stable")
    rarest = near_terms(tests.windows, by_rarity)
    lengths = (tests.windows >= 0).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(tests.names, dtype=object)
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard.read(batch, row, len(tests.terms))
                n_docs, n_words = len(shard.counts), int(shard.first[-1])
                edge = np.zeros(n_words + 1, np.int64)
                pairs: list[list[np.ndarray]] = [[np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]]
                for w, at, exact in search(shard, tests, by_rarity, rarest, slop) if len(tests.terms) else ():
                    doc = np.searchsorted(shard.first, at, "right") - 1
                    if len(w) and exact[0]:
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + lengths[w], -1)
                    n_items = np.diff(tests.item_first)[w]
                    step = np.arange(int(n_items.sum())) - np.repeat(np.cumsum(n_items) - n_items, n_items)
                    item = tests.items[np.repeat(tests.item_first[w], n_items) + step]
                    found = np.column_stack([np.repeat(doc, n_items), item])
                    pairs[0 if len(exact) and exact[0] else 1].append(np.unique(found, axis=0))
                hit = np.cumsum(edge)[:n_words] > 0
                doc_of = np.repeat(np.arange(n_docs), shard.counts)
                begins = hit.copy()
                begins[1:] &= ~hit[:-1] | (doc_of[1:] != doc_of[:-1])
                ends = hit.copy()
                ends[:-1] &= ~hit[1:] | (doc_of[1:] != doc_of[:-1])
                b, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
                spans = (((b - shard.first[doc_of[b]]) << 32) | (e - shard.first[doc_of[b]])) if len(b) else np.zeros(0, np.int64)
                lists = [np.unique(np.concatenate(p), axis=0) for p in pairs]
                split = lambda docs: pa.array(np.searchsorted(docs, np.arange(n_docs + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(_array(batch, "keys", row, np.int64)), pa.array(_array(batch, "texts", row, np.int64)),
                    pa.array(shard.counts), pa.ListArray.from_arrays(split(doc_of[b] if len(b) else b), pa.array(spans)),
                    *[pa.ListArray.from_arrays(split(x[:, 0]), pa.array(names[x[:, 1]], pa.string())) for x in lists]],
                    ["key", "text_hash", "n_words", "spans", "items", "near"])
    return run


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """The test set in blocks of about ``BLOCK_WORDS`` words, whole items each."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # a word and the space after it take two bytes at least
    n_blocks = max(1, -(-total // (2 * BLOCK_WORDS)))
    for block in range(n_blocks):
        part = rows if n_blocks == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        held = part.select("item", "text").toArrow()
        yield held.column("item").to_pylist(), held.column("text").to_pylist()


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", window: int = WINDOW_WORDS, slop: int = SLOP_WORDS) -> DataFrame:
    """Rows ``doc_id, n_words, n_hit, hits, items, near_items, contaminated``, one for each row of ``docs``.

    ``hits``: merged word ranges (start, end) inside exact matches; ``items``:
    ids with exact matches; ``near_items``: ids with proximity matches only.
    """
    texts = docs.select(id_key(id_col).alias("key"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                        F.col(text_col).cast("string").alias("text"))
    found: DataFrame | None = None
    n_blocks = 0
    for names, bodies in _blocks(items, item_col, item_text_col):
        tests = read_tests(names, bodies, window)
        index = saved(texts.mapInArrow(_index(tests.terms), "keys binary, texts binary, counts binary, terms binary, "
                                                            "starts binary, postings binary"))
        counted = index.select("terms", "starts").mapInArrow(_frequencies(len(tests.terms)), "term bigint, n bigint") \
            .groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        frequency = np.zeros(len(tests.terms), np.int64)
        frequency[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
        rows = index.mapInArrow(_search(tests, frequency, slop), "key bigint, text_hash bigint, n_words bigint, "
                                                                 "spans array<bigint>, items array<string>, near array<string>")
        found = rows if found is None else found.unionByName(rows)
        n_blocks += 1
    merged = found.groupBy("key", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_distinct(F.flatten(F.collect_set("near"))).alias("near"),
        (F.count(F.lit(1)) / n_blocks).cast("int").alias("copies"))
    ranges = F.expr("transform(spans, x -> struct(shiftright(x, 32) AS start, x & 4294967295 AS end))")
    n_hit = F.expr("aggregate(hits, struct(0L AS n, 0L AS reach), (a, x) -> struct("
                   "a.n + greatest(0L, x.end - greatest(x.start, a.reach)) AS n, greatest(a.reach, x.end) AS reach), a -> a.n)")
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).withColumn("hits", ranges).select(
        key_id("key").alias("doc_id"), "n_words", n_hit.alias("n_hit"), "hits", "items",
        F.array_sort(F.array_except("near", "items")).alias("near_items"), (F.size("hits") > 0).alias("contaminated"))
