"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Every word is predicted from the ``SIDE`` words on either side of it: their
vectors, one tanh layer, and a two-step softmax over 32 classes and the 32
entries of a class. A document's score is the sum over all its words of the
log-probability given both sides.

*Vocabulary.* Words are counted over the whole corpus; the ``FREQUENT``
commonest have entries of their own (ordered by count, so a class holds words
of like frequency), every other word shares one of the other entries by hash.
The probability of such a word is its entry's times the word's share of the
entry's count, so every word of the corpus has a probability of its own. On
either side of a predicted word, words count by their entries.

*Training* is data-parallel, on every word of every document, once, whatever
the size of the corpus. A hash of its place deals each word to one of ``ROUNDS``
rounds. In a round every partition trains a copy of the network on its words in
numpy (in steps that grow as a partition's round goes on: the first small, for
what is far off, later ones cheap), and Spark averages the copies by number of rows. Weights are summed as
whole multiples of 2^-24, so the average does not depend on the order of tasks.
It does depend on how the table is dealt to partitions (another deal trains
other copies). The driver holds one network.

*Scoring* adds up what the entries on either side bring to the hidden layer
from tables that are worked out once (``Network.scorer``).

Scale. Texts are read once and kept as chunks of a few megabytes: the
chunk's different words and, for each word of the text, its number among them.
Counts are summed in each chunk before they are shuffled, and each chunk's
shared words are joined with the counts, once per chunk. A partition sends one
network a round, whatever its size.

Defined cases: null and empty texts have no words, sum 0 and a null mean;
places outside a document are a word of their own; a null id is returned as
null; repeated rows are scored (and counted) each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderscope.llm.frames import id_key, key_id, saved
from orderscope.llm.words import NOT_ALNUM, hash_pair, pieces

CLASSES, ENTRIES = 32, 32
VOCABULARY = CLASSES * ENTRIES
FREQUENT = 768
SIDE, VECTOR, HIDDEN = 2, 16, 48
ROUNDS, RATE = 4, 0.05
BATCH, LARGE_BATCH, GROWTH = 512, 2048, 32      # rows of a step: the first, the most, and rows trained for each one more
SCORED_AT_ONCE = 2048               # words; their rows stay in a core's cache
UNIT = 1 << 24
CHUNK = ["chunk", "keys", "counts", "words", "times", "at"]
SHAPES = {
    "vector": (VOCABULARY + 1, VECTOR),
    "into": (2 * SIDE * VECTOR, HIDDEN), "into_bias": (HIDDEN,),
    "class_": (HIDDEN, CLASSES), "class_bias": (CLASSES,),
    "entry": (CLASSES, HIDDEN, ENTRIES), "entry_bias": (CLASSES, ENTRIES),
}


@dataclass
class Network:
    """The weights, by name as in ``SHAPES``."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, entries: np.ndarray) -> Network:
        """Random weights; the biases start at the entries' own frequencies."""
        rng = np.random.default_rng(7)
        weights = {k: (np.zeros(s) if k.endswith("bias") else rng.normal(0, 0.3 / np.sqrt(s[-2]) if k != "vector" else 0.3, s))
                   .astype(np.float32) for k, s in SHAPES.items()}
        grid = (entries + 1).reshape(CLASSES, ENTRIES)
        weights["class_bias"] = np.log(grid.sum(axis=1) / grid.sum()).astype(np.float32)
        weights["entry_bias"] = np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32)
        return cls(weights)

    @classmethod
    def unpacked(cls, flat: np.ndarray) -> Network:
        at, out = 0, {}
        for k, s in SHAPES.items():
            n = int(np.prod(s))
            out[k] = flat[at:at + n].reshape(s).astype(np.float32)
            at += n
        return cls(out)

    def packed(self) -> np.ndarray:
        return np.concatenate([self.weights[k].ravel() for k in SHAPES])

    def hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.weights["vector"][context].reshape(len(context), -1)
        return x, np.tanh(x @ self.weights["into"] + self.weights["into_bias"])

    def scorer(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """log p(word | context) of each row; what an entry adds to the hidden layer from each side is worked out once."""
        w = self.weights
        sides = [w["vector"] @ part for part in np.split(w["into"], 2 * SIDE)]

        def log_probability(context: np.ndarray, word: np.ndarray) -> np.ndarray:
            h = sides[0].take(context[:, 0], axis=0)
            for side, table in enumerate(sides[1:], 1):
                h += table.take(context[:, side], axis=0)
            h += w["into_bias"]
            np.tanh(h, out=h)
            class_, entry = word // ENTRIES, word % ENTRIES
            order, cuts = _by_class(class_)
            z = h @ w["class_"]
            z += w["class_bias"]
            out = _log_softmax_at(z, class_)
            out[order] += _log_softmax_at(self._entries(h[order], cuts), entry[order])
            return out
        return log_probability

    def log_probability(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log p(word | context) of each row."""
        return self.scorer()(context, word)

    def _entries(self, h: np.ndarray, cuts: list[tuple[int, int, int]], out: np.ndarray | None = None) -> np.ndarray:
        """Inputs of the second softmax; rows lie in order of class."""
        out = np.empty((len(h), ENTRIES), np.float32) if out is None else out
        for c, a, b in cuts:
            np.matmul(h[a:b], self.weights["entry"][c], out=out[a:b])
            out[a:b] += self.weights["entry_bias"][c]
        return out

    def train(self, context: np.ndarray, word: np.ndarray, rate: float, done: int = 0) -> None:
        """One pass of mini-batch AdaGrad steps, which grow with the rows ``done`` before."""
        square = {k: np.full(s, 1e-6, np.float32) for k, s in SHAPES.items()}
        room = Room()
        at = 0
        while at < len(word):
            end = at + min(LARGE_BATCH, max(BATCH, (done + at) // GROWTH))
            self._step(context[at:end], word[at:end], rate, square, room)
            at = end

    def _step(self, context: np.ndarray, word: np.ndarray, rate: float, square: dict[str, np.ndarray], room: Room) -> None:
        w, n = self.weights, len(word)
        x = np.take(w["vector"], context.ravel(), axis=0, out=room("x", n * 2 * SIDE, VECTOR), mode="clip").reshape(n, -1)
        h = np.matmul(x, w["into"], out=room("h", n, HIDDEN))
        h += w["into_bias"]
        np.tanh(h, out=h)
        class_, entry = word // ENTRIES, word % ENTRIES
        d_class = np.matmul(h, w["class_"], out=room("class", n, CLASSES))
        d_class += w["class_bias"]
        _softmax_less(d_class, class_)
        d_h = np.matmul(d_class, w["class_"].T, out=room("d_h", n, HIDDEN))
        grad = {"class_": h.T @ d_class, "class_bias": d_class.sum(0),
                "entry": np.zeros(SHAPES["entry"], np.float32), "entry_bias": np.zeros(SHAPES["entry_bias"], np.float32)}
        order, cuts = _by_class(class_)
        sorted_ = np.take(h, order, axis=0, out=room("sorted", n, HIDDEN), mode="clip")
        d = self._entries(sorted_, cuts, room("entries", n, ENTRIES))
        _softmax_less(d, entry[order])
        back = room("back", n, HIDDEN)
        for c, a, b in cuts:
            np.matmul(d[a:b], w["entry"][c].T, out=back[a:b])
            np.matmul(sorted_[a:b].T, d[a:b], out=grad["entry"][c])
            grad["entry_bias"][c] = d[a:b].sum(0)
        d_h[order] += back
        np.multiply(h, h, out=back)
        np.subtract(1, back, out=back)
        d_h *= back
        grad["into"], grad["into_bias"] = x.T @ d_h, d_h.sum(0)
        d_x = np.matmul(d_h, w["into"].T, out=room("d_x", n, 2 * SIDE * VECTOR)).reshape(-1, VECTOR)
        met, grad["vector"] = _summed_rows(context.ravel(), d_x, room)
        for k, g in grad.items():
            if k == "vector":             # only the vectors met
                square[k][met] += g * g
                w[k][met] -= rate * g / np.sqrt(square[k][met])
            else:
                square[k] += g * g
                g *= rate
                g /= np.sqrt(square[k])
                w[k] -= g


class Room:
    """Arrays that steps use again, by name: fresh ones of this size would cost a page fault for each 4 KB."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, rows: int, columns: int) -> np.ndarray:
        if name not in self.held or len(self.held[name]) < rows:
            self.held[name] = np.empty((rows, columns), np.float32)
        return self.held[name][:rows]


def _summed_rows(index: np.ndarray, rows: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
    """Different indexes, and the sum of the rows of each."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    found = index[order]
    heads = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    return found[heads], np.add.reduceat(np.take(rows, order, axis=0, out=room("by_index", len(rows), VECTOR), mode="clip"), heads, axis=0)


def _odds(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """exp of each cell less the row's cell ``at``, in place, and the sums of the rows (1 or more).

    Odds beyond e^80 count as e^80: a probability under e^-80 is not told apart from that.
    """
    z -= z[np.arange(len(z)), at][:, None]
    np.minimum(z, 80, out=z)
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def _softmax_less(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of ``z`` as probabilities, less 1 at the row's cell ``at``, over the number of rows: the gradient, in place."""
    total = _odds(z, at)
    z *= (1 / (len(z) * total))[:, None]
    z[np.arange(len(z)), at] -= 1 / np.float32(len(z))
    return z


def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log-probability of one cell of each row; ``z`` is used up."""
    return -np.log(_odds(z, at))


def _by_class(class_: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows in order of class, and (class, from, to) of the classes that have rows."""
    order = np.argsort(class_.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(class_, minlength=CLASSES)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if b > a]


def _packed(values: np.ndarray) -> pa.Array:
    """One cell with compressed numbers; ``_unpacked`` reads it."""
    data = np.ascontiguousarray(values).tobytes()
    return pa.array([np.int64(len(data)).tobytes() + pa.compress(data, codec="zstd", asbytes=True)], pa.binary())


def _unpacked(cell: pa.Scalar, kind: type) -> np.ndarray:
    data = cell.as_py()
    size = int(np.frombuffer(data[:8], np.int64)[0])
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece as its different words, commonest first, and their numbers in order."""
    for batch in batches:
        keys = batch.column(1).to_numpy()
        for piece in pieces(batch.column(2), NOT_ALNUM, lower=True):
            word, at, n = np.unique(piece.hashes(), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(word), np.int32)
            place[order] = np.arange(len(word))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(piece.row, 1), _packed(keys[piece.row:piece.row + piece.n_docs]), _packed(piece.counts().astype(np.int64)),
                _packed(word[order]), _packed(n[order].astype(np.int32)), _packed(place[at])], CHUNK)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts in chunks of a few megabytes, each numbered after the row it begins with."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), id_key(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return saved(texts.mapInArrow(_encode, "chunk bigint, " + ", ".join(f"{c} binary" for c in CHUNK[1:])))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for word, n in zip(batch.column(0), batch.column(1), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(_unpacked(word, np.int64)), pa.array(_unpacked(n, np.int32).astype(np.int64))], ["word", "n"])


def word_counts(chunks: DataFrame) -> DataFrame:
    """Rows ``word, n``: every word of the corpus, as its hash, and how often it comes."""
    return saved(chunks.select("words", "times").mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    entries = np.zeros(VOCABULARY)
    shared = F.shiftrightunsigned("word", 20) % (VOCABULARY - FREQUENT)
    for row in counts.groupBy(shared.alias("entry")).agg(F.sum("n").alias("n")).collect():
        entries[FREQUENT + row["entry"]] = row["n"]
    for rank, row in enumerate(top):
        entries[rank] = row["n"]
        entries[FREQUENT + int(frequent[rank] >> np.uint64(20)) % (VOCABULARY - FREQUENT)] -= row["n"]
    return frequent, entries


def frequent_words(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the commonest words of all documents, by count, and the counts of all entries."""
    texts = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))
    return _frequent(word_counts(encoded(texts)))


class Numbering:
    """Entry numbers of words: rank for frequent ones, a hash for the others."""

    def __init__(self, frequent: np.ndarray) -> None:
        self.order = np.argsort(frequent)
        self.known = frequent[self.order]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        shared = FREQUENT + (hashes >> np.uint64(20)).astype(np.int64) % (VOCABULARY - FREQUENT)
        if not len(self.known):
            return shared
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.order[at], shared)


class Sequence:
    """Entry numbers of a chunk's documents, one after the other, with places outside between them."""

    def __init__(self, numbers: np.ndarray, counts: np.ndarray) -> None:
        self.numbers = numbers
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(numbers)) + SIDE * (self.doc + 1)
        self.padded = np.full(len(numbers) + SIDE * (len(counts) + 1), VOCABULARY, dtype=np.int64)
        self.padded[self.place] = numbers

    def contexts(self, rows: np.ndarray) -> np.ndarray:
        """Entry numbers on both sides of the given words; outside the document the extra one."""
        return self.padded[self.place[rows][:, None] + np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])]


def training_rows(keys: np.ndarray, counts: np.ndarray, turn: int) -> np.ndarray:
    """Word places of a chunk that train in a round; each place trains in one."""
    doc = np.repeat(np.arange(len(counts)), counts)
    within = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    draw = hash_pair(keys[doc], within, 31)
    return np.flatnonzero(draw % np.uint64(ROUNDS) == turn)


def _train(numbering: Numbering, flat: np.ndarray, turn: int) -> Callable:
    """Train a copy on a partition's rows; send each weight times the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, n = Network.unpacked(flat.copy()), 0
        for batch in batches:
            for cells in zip(*batch.columns, strict=True):
                keys, counts, words, at = (_unpacked(c, k) for c, k in zip(cells, (np.uint64, np.int64, np.uint64, np.int32), strict=True))
                text = Sequence(numbering(words)[at], counts)
                rows = training_rows(keys, counts, turn)
                network.train(text.contexts(rows), text.numbers[rows], RATE / (1 + turn), n)
                n += len(rows)
        if n:
            total = np.rint(network.packed().astype(np.float64) * UNIT).astype(np.int64) * n
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total),
                                              pa.array(np.full(len(total), n))], ["at", "total", "n"])
    return run


def _fit(chunks: DataFrame, frequent: np.ndarray, entries: np.ndarray) -> tuple[Numbering, Network]:
    numbering, network = Numbering(frequent), Network.fresh(entries)
    rows = chunks.select("keys", "counts", "words", "at")
    for turn in range(ROUNDS):
        trained = rows.mapInArrow(_train(numbering, network.packed(), turn), "at int, total bigint, n bigint")
        mean = trained.groupBy("at").agg((F.sum("total") / F.sum("n") / UNIT).alias("mean")).toArrow()
        if not mean.num_rows:
            break
        flat = np.zeros(len(network.packed()))
        flat[mean.column("at").to_numpy()] = mean.column("mean").to_numpy()
        network = Network.unpacked(flat)
    return numbering, network


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Numbering, Network]:
    """Count words and train, all on Spark."""
    chunks = encoded(docs, id_col, text_col)
    return _fit(chunks, *_frequent(word_counts(chunks)))


def _shared_words(numbering: Numbering) -> Callable:
    """(word, chunk, number in the chunk) of the words that share an entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, cell in zip(*batch.columns, strict=True):
                words = _unpacked(cell, np.uint64)
                shared = np.flatnonzero(numbering(words) >= FREQUENT)
                yield pa.RecordBatch.from_arrays([
                    pa.array(words[shared].view(np.int64)), pa.array(np.full(len(shared), chunk.as_py())), pa.array(shared.astype(np.int32))],
                    ["word", "chunk", "number"])
    return run


def _numbered(numbering: Numbering) -> Callable:
    """Chunks with the entries of their words in place of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                entry = numbering(_unpacked(batch.column(3)[i], np.uint64)).astype(np.int16)
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in range(3)], _packed(entry), batch.column(4).slice(i, 1)],
                                                 ["chunk", "keys", "counts", "entries", "at"])
    return run


def _scores(network: Network, entries: np.ndarray) -> Callable:
    """Scores of one chunk's documents; ``found`` has the corpus counts of its words that share an entry."""
    def run(chunk: pa.Table, found: pa.Table) -> pa.Table:
        keys, counts, entry, at = (_unpacked(chunk.column(c)[0], k) for c, k in (
            ("keys", np.int64), ("counts", np.int64), ("entries", np.int16), ("at", np.int32)))
        share = np.zeros(len(entry))
        number = found.column("number").to_numpy()
        share[number] = np.log(found.column("n").to_numpy() / entries[entry[number]])
        text = Sequence(entry.astype(np.int64)[at], counts)
        logs, score = share[at], network.scorer()
        for start in range(0, len(at), SCORED_AT_ONCE):
            rows = np.arange(start, min(start + SCORED_AT_ONCE, len(at)))
            logs[rows] += score(text.contexts(rows), text.numbers[rows])
        return pa.table({"key": keys, "n_words": counts, "log_likelihood": np.bincount(text.doc, logs, len(counts))})
    return run


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, n_words, log_likelihood, mean_log_likelihood``, one for each row of ``docs``."""
    chunks = encoded(docs, id_col, text_col)
    counts = word_counts(chunks)
    frequent, entries = _frequent(counts)
    numbering, network = _fit(chunks, frequent, entries)
    found = chunks.select("chunk", "words").mapInArrow(_shared_words(numbering), "word bigint, chunk bigint, number int") \
        .join(counts.hint("merge"), "word").select("chunk", "number", "n")
    texts = chunks.select("chunk", "keys", "counts", "words", "at") \
        .mapInArrow(_numbered(numbering), "chunk bigint, keys binary, counts binary, entries binary, at binary")
    scored = texts.groupBy("chunk").cogroup(found.groupBy("chunk")) \
        .applyInArrow(_scores(network, entries), "key bigint, n_words bigint, log_likelihood double")
    return scored.select(
        key_id("key").alias("doc_id"), "n_words", "log_likelihood",
        F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood"))
