"""Periodic runs of words: recursive frequency splitting, then a lag scan.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) that is at least ``max(least, 2 q)`` words long. Every word of a run
occurs at least twice in it, so a word that occurs once in its segment of the
text lies in no run and splits the segment. The parts are counted anew, which
makes further words single; this goes on until nothing changes. Only words of
shorter parts are counted again (the longest part of a split keeps its
segment's counts less theirs), so the recursion costs n log n words whatever
the text. Parts shorter than ``least`` are dropped. Prose falls apart
entirely; what survives repeats within itself.

The lag scan of the surviving segments compares words q apart. Lags below 8
are scanned whole. Beyond, lags are taken in octaves [k, 2k), with names for
all stretches of k words (by doubling: pairs of names of k/2 words). A run of
such a lag either begins with a period that holds k words without a period of
k/2 or less, and then those k words stand again q words later, and at most
two more times in between; or it begins inside a run of a period of k/2 or
less and goes on in the next run of that period, which touches it. Both give
few pairs of places, and each pair is extended to both sides by the names of
all lengths, which gives the whole stretch of its lag. All steps are numpy
over many documents at once; work grows with n log n, never with the square
of a segment.

The job is one pass over the documents, without a shuffle. A task holds the
words of about ``PIECE_BYTES`` of text, or of one document.

Defined cases: null and empty texts have no words, no runs and null run
columns; runs may overlap, and a word is dropped if any run repeats it; equal
lengths are decided by the smallest start, then period; every row gives one
row, repeated rows and null ids included (``edit`` sees a null id as None); an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderscope.llm.frames import picked

LEAST = 12
SCANNED_LAGS = 8
PIECE_BYTES = 4 << 20

RESULT = ("doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, "
          "runs array<struct<start:bigint, length:bigint, period:bigint>>, kept_text string")

Edit = Callable[[int | None, list[bytes]], list[bytes]]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The places of several half-open ranges, one after the other."""
    size = high - low
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(low - (ends - size), size)


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The array, or a longer one that starts with it."""
    return values if len(values) >= size else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


def surviving_segments(names: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split documents at single words until every word repeats within its segment.

    ``names``: word numbers; document d is ``names[first[d]:first[d + 1]]``.
    Returns the segments' first and last places (exclusive), and for each word
    the number of its (segment, word) pair.
    """
    n = len(names)
    long = np.diff(first) >= least
    low, high = first[:-1][long], first[1:][long]
    segment, pair = np.full(n, -1), np.full(n, -1)
    places = _ranges(low, high)
    segment[places] = np.repeat(np.arange(len(low)), high - low)
    width = int(names.max()) + 1 if n else 1
    _, pair[places] = np.unique(segment[places] * width + names[places], return_inverse=True)
    n_pairs = int(pair.max()) + 1 if len(places) else 0
    count = np.bincount(pair[places], minlength=n_pairs)
    where = np.zeros(n_pairs, np.int64)               # sums of places: of a single word, its place
    np.add.at(where, pair[places], places)
    single = np.sort(where[count == 1])
    while len(single):
        split, n_cuts = np.unique(segment[single], return_counts=True)
        # segments do not overlap, so sorted starts and ends of the parts belong together
        start = np.sort(np.concatenate([low[split], single + 1]))
        end = np.sort(np.concatenate([single, high[split]]))
        by_place = split[np.argsort(low[split])]
        owner = np.repeat(by_place, n_cuts[np.searchsorted(split, by_place)] + 1)
        size = end - start
        order = np.lexsort((start, -size, owner))
        longest = order[np.append(True, owner[order][1:] != owner[order][:-1])]
        low[owner[longest]], high[owner[longest]] = start[longest], end[longest]
        stays = np.zeros(len(start), bool)
        stays[longest[size[longest] >= least]] = True
        gone = longest[size[longest] < least]
        high[owner[gone]] = low[owner[gone]]
        moved = np.concatenate([_ranges(start[~stays], end[~stays]), single])
        old = pair[moved]
        np.subtract.at(count, old, 1)
        np.subtract.at(where, old, moved)
        segment[moved] = -1
        fresh = ~stays & (size >= least)
        fresh[longest] = False
        places = _ranges(start[fresh], end[fresh])
        number = np.repeat(np.arange(int(fresh.sum())), size[fresh])
        segment[places] = len(low) + number
        low, high = np.append(low, start[fresh]), np.append(high, end[fresh])
        _, inverse = np.unique(number * n_pairs + pair[places], return_inverse=True)
        pair[moved] = -1
        pair[places] = n_pairs + inverse
        new = int(inverse.max()) + 1 if len(inverse) else 0
        count, where = _room(count, n_pairs + new), _room(where, n_pairs + new)
        np.add.at(count, pair[places], 1)
        np.add.at(where, pair[places], places)
        touched = np.concatenate([np.unique(old), np.arange(n_pairs, n_pairs + new)])
        n_pairs += new
        single = np.sort(where[touched[count[touched] == 1]])
    alive = high > low
    order = np.argsort(low[alive])
    return low[alive][order], high[alive][order], pair


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true cells."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


class Names:
    """Names of all stretches of 1, 2, 4 … words of the segments; -1 where a stretch stands alone or leaves its segment."""

    def __init__(self, words: np.ndarray, end: np.ndarray):
        self.n, self.levels = len(words), []
        names = words.astype(np.int64)
        while len(names) and names.max() >= 0:
            self.levels.append(names)
            k = 1 << (len(self.levels) - 1)
            both = np.full(self.n, -1, dtype=np.int64)
            here = np.flatnonzero((names >= 0) & (np.arange(self.n) + 2 * k <= end))
            here = here[names[here + k] >= 0]
            key, inverse, count = np.unique(names[here] * (int(names.max()) + 1) + names[here + k], return_inverse=True, return_counts=True)
            repeats = count[inverse] > 1
            both[here[repeats]] = inverse[repeats]
            names = both

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words at ``a`` equal those at ``b`` (stretches that repeat somewhere)."""
        out = np.zeros(len(a), bool)
        level_of = np.frexp(length.astype(np.float64))[1] - 1
        for level in np.unique(level_of).tolist():
            here, names = np.flatnonzero(level_of == level), self.levels[level]
            rest = length[here] - (1 << level)
            out[here] = (names[a[here]] == names[b[here]]) & (names[a[here] + rest] == names[b[here] + rest])
        return out

    def extend(self, left: np.ndarray, right: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Widen ``[left, right)`` while each word equals the one ``lag`` words on."""
        left, right = left.copy(), right.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            names, k = self.levels[level], 1 << level
            at = np.minimum(right, self.n - 1)
            ahead = np.minimum(right + lag, self.n - 1)
            same = (right + lag < self.n) & (names[at] >= 0) & (names[at] == names[ahead])
            right += k * same
            at = np.maximum(left - k, 0)
            same = (left >= k) & (names[at] >= 0) & (names[at] == names[np.minimum(at + lag, self.n - 1)])
            left -= k * same
        return left, right


def _by_names(names: Names, level: int, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal stretches of k words that start k to 2k - 1 words apart: their first starts and distances.

    Stretches with a period of k/2 or less are left out (``inside``), so equal
    ones start more than k/2 apart and only the next three can be near enough.
    """
    k, own = 1 << level, names.levels[level]
    place = np.flatnonzero((own >= 0) & ~inside)
    place = place[np.argsort(own[place], kind="stable")]
    starts, lags = [], []
    for step in (1, 2, 3):
        apart = place[step:] - place[:-step]
        near = (own[place[step:]] == own[place[:-step]]) & (apart >= k) & (apart < 2 * k)
        starts.append(place[:-step][near])
        lags.append(apart[near])
    return np.concatenate(starts), np.concatenate(lags)


def _by_neighbours(names: Names, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches ``start, end`` of lags from k to 2k - 1 between two runs of one shorter period that touch or overlap.

    They are the runs whose first period lies inside a run of period k/2 or
    less, and its repetition inside the next one of that period. Lags whose
    phases agree are a fixed distance plus multiples of that period.
    """
    rows = known[np.lexsort((known[:, 0], known[:, 2]))]
    first, second = rows[:-1], rows[1:]
    touch = (first[:, 2] == second[:, 2]) & (second[:, 0] <= first[:, 0] + first[:, 1])
    first, second = first[touch], second[touch]
    d, end = first[:, 2], first[:, 0] + first[:, 1]
    probe = _ranges(end - 2 * d, end - d)
    which = np.repeat(np.arange(len(d)), d)
    in_phase = names.equal(probe, second[which, 0], d[which])
    which, nearest = which[in_phase], (second[which, 0] - probe)[in_phase]
    step = d[which]
    lowest = nearest + np.maximum(-((nearest - k) // step), 0) * step
    highest = np.minimum(2 * k - 1, np.minimum(first[which, 1], second[which, 1]))
    many = np.maximum((highest - lowest) // step + 1, 0)
    lag = np.repeat(lowest, many) + _ranges(np.zeros(len(many), np.int64), many) * np.repeat(step, many)
    which = np.repeat(which, many)
    left = np.maximum(first[which, 0], second[which, 0] - lag)
    right = np.minimum(end[which], second[which, 0] + second[which, 1] - lag)
    some = right > left
    return left[some], right[some], lag[some]


def runs_of_segments(words: np.ndarray, end: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows ``start, length, period`` of all runs; ``end[i]``: the end of the segment of place i.

    Words of different segments must have different numbers.
    """
    n = len(words)
    if not n:
        return np.zeros((0, 3), np.int64)
    names = Names(words, end)
    found = [np.zeros((0, 3), np.int64)]

    def add(start: np.ndarray, stop: np.ndarray, lag: np.ndarray) -> None:
        rows = np.column_stack([start, stop - start + lag, lag])
        found.append(rows[rows[:, 1] >= 2 * lag])

    for lag in range(1, min(SCANNED_LAGS, n)):
        start, stop = _stretches(words[:-lag] == words[lag:])
        wide = stop - start + lag >= min(least, SCANNED_LAGS)
        add(start[wide], stop[wide], np.full(int(wide.sum()), lag))
    for level in range(3, len(names.levels)):
        k = 1 << level
        found = [_smallest(np.concatenate(found))]
        known = found[0][(found[0][:, 2] <= k // 2) & (found[0][:, 1] >= k)]
        edge = np.bincount(known[:, 0], minlength=n + 1) - np.bincount(known[:, 0] + known[:, 1] - k + 1, minlength=n + 1)
        start, lag = _by_names(names, level, np.cumsum(edge)[:n] > 0)
        order = np.lexsort((start, lag))
        start, lag = start[order], lag[order]
        fresh = np.append(True, (lag[1:] != lag[:-1]) | (start[1:] > start[:-1] + k))[:len(start)]
        start, lag = start[fresh], lag[fresh]
        left, right, between = _by_neighbours(names, k, known)
        lag = np.concatenate([lag, between])
        left, right = names.extend(np.concatenate([start, left]), np.concatenate([start + k, right]), lag)
        add(left, right, lag)
    rows = _smallest(np.concatenate(found))
    return rows[rows[:, 1] >= least]


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of rows with one extent, the one with the smallest period; sorted by start, then period."""
    order = np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))
    rows = rows[order]
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[:len(rows)]
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of_documents(words: list[list[bytes]], least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several documents: their rows (start within the document) and the document of each."""
    sizes = np.array([len(w) for w in words], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    numbers: dict[bytes, int] = {}
    names = np.fromiter((numbers.setdefault(w, len(numbers)) for doc in words for w in doc), np.int64, int(first[-1]))
    low, high, pair = surviving_segments(names, first, least)
    places = _ranges(low, high)
    size = high - low
    end = np.repeat(np.cumsum(size), size)
    rows = runs_of_segments(np.unique(pair[places], return_inverse=True)[1] if len(places) else places, end, least)
    at = places[rows[:, 0]] if len(rows) else np.zeros(0, np.int64)
    doc = np.searchsorted(first, at, "right") - 1
    rows = np.column_stack([at - first[doc], rows[:, 1], rows[:, 2]])
    return rows, doc


def collapsed(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    """The words that no run repeats: each run keeps its first period."""
    if not len(rows):
        return words
    edge = np.bincount(rows[:, 0] + rows[:, 2], minlength=len(words) + 1) - np.bincount(rows[:, 0] + rows[:, 1], minlength=len(words) + 1)
    return [w for w, inside in zip(words, np.cumsum(edge)[:-1].tolist(), strict=True) if not inside]


def _run(least: int, edit: Edit | None) -> Callable:
    def piece(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
        rows, doc = runs_of_documents(texts, least)
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        longest = [None] * len(texts)
        kept = []
        for d, words in enumerate(texts):
            own = rows[bounds[d]:bounds[d + 1]]
            if len(own):
                longest[d] = own[np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]].tolist()
            kept.append(b" ".join(collapsed(words, own)))
        column = lambda values: pa.array(values, pa.int64())
        runs = pa.StructArray.from_arrays([column(rows[:, i]) for i in range(3)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [column(ids), column([len(w) for w in texts]), column(np.diff(bounds)),
             *[column([x and x[i] for x in longest]) for i in range(3)],
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_runs", "start", "length", "period", "runs", "kept_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for key, cell in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                words = (cell.as_py() or b"").split()            # ASCII white space, as bytes.split() has it
                ids.append(key)
                texts.append(edit(key, words) if edit else words)
                held += len(cell.as_py() or b"")
                if held >= PIECE_BYTES:
                    yield piece(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield piece(ids, texts)
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  edit: Edit | None = None) -> DataFrame:
    """Per document: counts, the longest run, all runs and the text without repeated periods.

    ``edit(id, words)`` may replace a document's words before they are searched.
    """
    slim = picked(docs, doc_id=id_col, text=text_col)
    return slim.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(_run(least, edit), RESULT)


def looped(key: int | None, words: list[bytes]) -> list[bytes]:
    """A document's words with a periodic end, in the one of ten documents whose id's crc32 ends in 0.

    From word ``g % n`` on, words repeat with a period that leaves three to
    ten rounds; a null id leaves the words as they are.
    """
    n = len(words)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    round_ = words[a:a + p]
    return words[:a] + (round_ * ((n - a) // p + 1))[:n - a]


def runs_digest(rows: list) -> str:
    """SHA-256 of ``start,length,period`` lines, as the query gives it (for checks outside Spark)."""
    return hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()).hexdigest()
