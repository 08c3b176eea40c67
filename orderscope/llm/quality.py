"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each document becomes a row of statistics of its own text (lengths, letter
and sign shares, word repetition, line and sentence shape); id, language,
source and labels are never inputs. Trees grow level by level on binned
statistics with logistic loss, then are flattened into arrays; scoring walks
all trees of a batch at once in numpy.

Training reads at most ``SAMPLE_ROWS`` labelled documents (a documented
bound), those with the smallest hash of their id, so the sample is the same
in every run and its size does not grow with the table. Their statistics are
computed on Spark; the sample (a few MB) is fitted on the driver. Every
document is scored, in one pass without a shuffle.

Defined cases: null and empty texts have all-zero statistics and get a score
like any other; a null id is never used for training and is not held out;
labels that are null or whose id is null are ignored, of repeated labels the
smallest counts; without labels of both classes the score is the share of
label 1 (0.5 without labels); repeated rows are scored each; an empty table
gives no rows; other columns are passed through or ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderscope.llm.words import FOLLOW, WHITE, Piece, byte_table, pieces

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, MIN_ROWS, RIDGE = 0.15, 20, 1.0

UPPER = byte_table((0x41, 0x5A))
LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
DIGIT = byte_table((0x30, 0x39))
STOP = byte_table((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
COMMA = byte_table((0x2C, 0x2C), (0x3A, 0x3B))
SIGN = byte_table((0x23, 0x2B), (0x2F, 0x2F), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
NEWLINE = byte_table((0x0A, 0x0A))
HIGH = byte_table((0x80, 0xFF))

STATISTICS = (
    "log_chars", "log_words", "chars_per_word", "word_length_spread", "longest_word", "upper_share", "letter_share",
    "digit_share", "stop_share", "comma_share", "sign_share", "white_share", "high_share", "log_lines", "words_per_line",
    "words_per_stop", "distinct_words", "once_words", "top_word", "distinct_pairs", "top_pair", "same_as_before",
    "same_as_second_before", "signed_words", "words_ending_in_sign", "letterless_words", "capital_words", "stop_words_end",
    "distinct_lines", "longest_line",
)


def _per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, empty ones included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _repetition(doc: np.ndarray, names: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: different names, names seen once, and the count of the commonest."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (names >> np.uint64(24)))
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(key)))
    owner = (key[head] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n_docs)
    np.maximum.at(top, owner, count)
    return np.bincount(owner, minlength=n_docs), np.bincount(owner[count == 1], minlength=n_docs), top


def statistics(piece: Piece) -> np.ndarray:
    """One row of statistics for each document of a piece."""
    n, size = piece.n_docs, int(piece.bounds[-1])
    data = piece.data[:size]
    n_bytes, counts = np.diff(piece.bounds).astype(float), piece.counts().astype(float)
    share = lambda table: _per_doc(table[data], piece.bounds)
    chars = n_bytes - share(FOLLOW)
    length = (piece.end - piece.start).astype(float)
    doc = piece.doc_of_word()
    words, some = np.maximum(counts, 1), np.maximum(n_bytes, 1)
    of_words = lambda mask: _per_doc(mask, piece.first) / words
    mean = _per_doc(length, piece.first) / words
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    lines = share(NEWLINE) + 1
    names = piece.hashes(0)
    inner = doc[1:] == doc[:-1]
    pair = (names[:-1] * np.uint64(3) + names[1:] * np.uint64(0x9E3779B97F4A7C15))[inner]
    distinct, once, top = _repetition(doc, names, n)
    pairs, _, top_pair = _repetition(doc[1:][inner], pair, n)
    same, second = np.zeros(len(doc)), np.zeros(len(doc))
    same[1:] = inner & (names[1:] == names[:-1])
    second[2:] = (doc[2:] == doc[:-2]) & (names[2:] == names[:-2])
    first_byte, last_byte = data[piece.start], data[piece.end - 1]
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    signs = np.concatenate([[0], np.cumsum(SIGN[data])])
    n_letters = letters[piece.end] - letters[piece.start]
    n_signs = signs[piece.end] - signs[piece.start]
    # lines: their byte lengths, and a name from the words on them
    breaks = np.flatnonzero(NEWLINE[data])
    edges = np.unique(np.concatenate([piece.bounds[:-1], breaks + 1, [size]]))
    edges = edges[edges <= size]
    line_doc = np.searchsorted(piece.bounds, edges[:-1], "right") - 1
    in_line = np.searchsorted(piece.start, edges)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * (np.uint64(1) + (piece.end - piece.start).astype(np.uint64)))])
    full = np.diff(in_line) > 0
    n_lines, _, _ = _repetition(line_doc[full], (total[in_line[1:]] - total[in_line[:-1]])[full] * np.uint64(0x9E3779B97F4A7C15), n)
    full_lines = np.bincount(line_doc[full], minlength=n)
    longest_line = np.zeros(n)
    np.maximum.at(longest_line, line_doc, np.diff(edges))
    stops = share(STOP)
    out = np.column_stack([
        np.log1p(chars), np.log1p(counts), mean, np.sqrt(np.maximum(_per_doc(length ** 2, piece.first) / words - mean ** 2, 0)),
        longest, share(UPPER) / some, share(LETTER) / some, share(DIGIT) / some, stops / some, share(COMMA) / some,
        share(SIGN) / some, share(WHITE) / some, share(HIGH) / some, np.log1p(lines), counts / lines, counts / (stops + 1),
        distinct / words, once / words, top / words, pairs / words, top_pair / words, _per_doc(same, piece.first) / words,
        _per_doc(second, piece.first) / words, of_words(n_signs > 0), of_words(SIGN[last_byte]), of_words(n_letters == 0),
        of_words(UPPER[first_byte]), of_words(STOP[last_byte]), n_lines / np.maximum(full_lines, 1), longest_line / some,
    ]).astype(np.float32)
    out[n_bytes == 0] = 0
    return out


def batch_statistics(texts: pa.Array) -> np.ndarray:
    rows = [statistics(p) for p in pieces(texts, WHITE, limit=1 << 20)]
    return np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)), np.float32)


@dataclass
class Trees:
    """All trees in flat arrays, ``2**(depth+1) - 1`` nodes each; a leaf's children are itself."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                left = self.left[node]
                right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(left >= 0, left + right, node)
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost regression trees on binned columns; second-order leaf values."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, value, roots = [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
        columns = np.arange(x.shape[1]) * BINS
        total = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            grad, hess = y - p, p * (1 - p)
            root = len(feature)
            roots.append(root)
            _grow(binned, cuts, columns, grad, hess, depth, (feature, threshold, left, value))
            node = np.full(len(y), root)
            flat = np.array(feature), np.array(threshold), np.array(left)
            for _ in range(depth):
                child = flat[2][node]
                node = np.where(child >= 0, child + (x[np.arange(len(y)), flat[0][node]] > flat[1][node]), node)
            total += np.array(value)[node]
    return Trees(base, np.array(feature, np.int64), np.array(threshold, np.float32), np.array(left, np.int64),
                 np.array(value, np.float64), np.array(roots, np.int64), depth)


def _grow(binned: np.ndarray, cuts: list[np.ndarray], columns: np.ndarray, grad: np.ndarray, hess: np.ndarray,
          depth: int, out: tuple[list, list, list, list]) -> None:
    """Add one tree; nodes of a level are split from one histogram over (node, column, bin)."""
    feature, threshold, left, value = out
    n_columns = len(columns)
    open_nodes = [_new_node(out, grad.sum(), hess.sum())]
    place = np.zeros(len(grad), dtype=np.int64)          # row → index in open_nodes, -1 when in a leaf
    for _ in range(depth):
        rows = np.flatnonzero(place >= 0)
        if not len(rows):
            return
        width = n_columns * BINS
        cell = (place[rows, None] * width + columns + binned[rows]).ravel()
        hist = [np.bincount(cell, np.repeat(w, n_columns), len(open_nodes) * width).reshape(-1, n_columns, BINS).cumsum(axis=2)
                for w in (grad[rows], hess[rows], np.ones(len(rows)))]
        g, h, c = hist
        gain = (g ** 2 / (h + RIDGE) + (g[..., -1:] - g) ** 2 / (h[..., -1:] - h + RIDGE)
                - g[..., -1:] ** 2 / (h[..., -1:] + RIDGE))
        gain[(c < MIN_ROWS) | (c[..., -1:] - c < MIN_ROWS)] = 0
        new_nodes: list[int] = []
        to = np.full((len(open_nodes), 2), -1)
        split = np.zeros((len(open_nodes), 2), dtype=np.int64)
        for i, node in enumerate(open_nodes):
            j, b = np.unravel_index(int(gain[i].argmax()), gain[i].shape)
            if gain[i, j, b] <= 1e-6 or b >= len(cuts[j]):
                continue
            feature[node], threshold[node] = int(j), float(cuts[j][b])
            split[i], to[i] = (j, b), (len(new_nodes), len(new_nodes) + 1)
            left[node] = len(feature)
            new_nodes += [_new_node(out, g[i, j, b], h[i, j, b]),
                          _new_node(out, g[i, j, -1] - g[i, j, b], h[i, j, -1] - h[i, j, b])]
        at = place[rows]
        goes_right = binned[rows, split[at, 0]] > split[at, 1]
        place[rows] = to[at, goes_right.astype(np.int64)]
        open_nodes = new_nodes


def _new_node(out: tuple[list, list, list, list], grad: float, hess: float) -> int:
    feature, threshold, left, value = out
    feature.append(0)
    threshold.append(0.0)
    left.append(-1)
    value.append(RATE * grad / (hess + RIDGE))
    return len(feature) - 1


def held_out(id_col: str) -> Column:
    """Every third document by crc32 of its id as text: never trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents that are not held out."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch_statistics(batch.column(2))
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "label", "x"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("int").alias("label"))), "id") \
        .select("id", "label", "text").mapInArrow(run, "id bigint, label int, x array<float>").toArrow()
    ids, y = rows.column("id").to_numpy(), rows.column("label").to_numpy()
    order = np.argsort(ids, kind="stable")
    values = rows.column("x").combine_chunks()
    x = (values.flatten() if isinstance(values, pa.ListArray) else pa.array([], pa.float32())).to_numpy(zero_copy_only=False)
    x = x.reshape(len(ids), len(STATISTICS)) if len(ids) else np.zeros((0, len(STATISTICS)), np.float32)
    return fit_trees(x[order], (y[order] > 0).astype(np.float64))


def _score(model: Trees, text_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            scores = model.score(batch_statistics(rows.field(rows.type.get_field_index(text_col))))
            yield pa.RecordBatch.from_arrays([rows, pa.array(scores)], ["doc", "score"])
    return run


def score(docs: DataFrame, model: Trees, text_col: str = "text") -> DataFrame:
    """Rows ``doc`` (all columns of ``docs``, as a struct) and ``score`` (0 to 1)."""
    schema = T.StructType([T.StructField("doc", docs.schema), T.StructField("score", T.DoubleType())])
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).mapInArrow(_score(model, text_col), schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, held_out, score, predicted``, one for each row of ``docs``."""
    model = fit(docs, labels, id_col, text_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return score(slim, model).select(
        "doc.doc_id", held_out("doc.doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
