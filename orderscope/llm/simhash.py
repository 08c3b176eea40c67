"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has 64 bits; a bit is 1 where it is set in over
half of the XXH64 values of the document's word shingles. Two fingerprints
link at ``max_bits`` or fewer differing bits.

Search. The 64 bits are cut into three blocks (21, 21 and 22 bits). With at
most four differing bits, some block differs in at most one. In each block
the anchors are the words of a covering code: the perfect (15, 11) Hamming
code on the first 15 bits, every value on the rest. Its covering radius is 1,
so each fingerprint has a home anchor within 1 bit, and a fingerprint that
differs from it in at most one bit of the block lies within 1 + 1 = 2 bits
of that anchor. Each fingerprint is replicated to every anchor within 2 bits
(about 15 of them a block); at each anchor the homes are compared with the
replicas over all 64 bits. For other ``max_bits`` the block threshold is
``max_bits // 3`` and the replication radius grows with it, so no pair is lost.

Scale. Equal fingerprints are one node, so groups of exact copies never
meet. Anchor buckets grow with the number of different fingerprints
divided by 2^17 a block. A bucket sends out a spanning forest of its links,
not all pairs; components come from star rounds over those links. Nodes are
ordered by their smallest ids, so the rounds end at the component's id and no
component is gathered to find it.

Defined cases: null or empty text, or one without words, has fingerprint 0
and links like any other; fewer words than a shingle: the whole sequence is
the only shingle; a null id sorts before all others and is returned as null;
repeated rows are returned as often as they come; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderscope.llm.frames import components, id_key, key_id, saved
from orderscope.llm.words import WHITE, Piece, pieces

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCKS = ((0, 21), (21, 21), (42, 22))     # first bit, bits
CODE_BITS = 15                             # length of the Hamming code in each block
COVERING_RADIUS = 1
# Links kept in a task before they are thinned to a forest.
EDGE_BUFFER = 1 << 20


def piece_fingerprints(piece: Piece, shingle: int) -> np.ndarray:
    """Fingerprints of the documents of one piece."""
    data, start, end = piece.joined()
    text = data.tobytes()
    counts = piece.counts()
    n_shingles = np.where(counts >= shingle, counts - shingle + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(piece.n_docs), n_shingles)
    first = np.cumsum(n_shingles) - n_shingles
    word = piece.first[:-1][doc] + np.arange(len(doc)) - first[doc]
    last = word + np.minimum(counts[doc], shingle) - 1
    hashes = np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in
                          zip(start[word].tolist(), end[last].tolist(), strict=True)), dtype=np.uint64, count=len(doc))
    out = np.zeros(piece.n_docs, dtype=np.uint64)
    some = np.flatnonzero(n_shingles)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[some], axis=0, dtype=np.int64)
        packed = np.packbits(2 * ones > n_shingles[some, None], axis=1, bitorder="little")
        out[some] = np.ascontiguousarray(packed).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Rows ``key, fp`` (signed 64 bits), one for each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [piece_fingerprints(p, shingle) for p in pieces(batch.column(1), WHITE, lower=True, limit=1 << 20)]
            fp = np.concatenate(fps).view(np.int64) if fps else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["key", "fp"])

    source = docs.select(id_key(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "key bigint, fp bigint")


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Hamming syndromes: the xor of the places (from 1) of the set bits."""
    out = np.zeros(len(values), dtype=np.int64)
    for place in range(1, CODE_BITS + 1):
        out ^= np.where((values >> (place - 1)) & 1, place, 0)
    return out


def _flips(bits: int, most: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(bits), n)], dtype=np.int64)


def anchors(fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: (row, anchor, is_home) of every anchor within the radius."""
    for block, (low, bits) in enumerate(BLOCKS):
        value = ((fp.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        syndrome = _syndromes(value)
        home = np.where(syndrome > 0, value ^ (1 << np.maximum(syndrome - 1, 0)), value)
        flips = _flips(bits, radius)
        by_syndrome = _syndromes(flips & ((1 << CODE_BITS) - 1))
        for s in range(CODE_BITS + 1):
            rows, masks = np.flatnonzero(syndrome == s), flips[by_syndrome == s]
            if len(rows) and len(masks):
                row = np.repeat(rows, len(masks))
                anchor = (value[rows][:, None] ^ masks[None, :]).ravel()
                yield row, anchor | (block << 60), anchor == home[row]


def _replicate(radius: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for at in range(0, len(fps), 2000):
                fp, key = fps[at:at + 2000], keys[at:at + 2000]
                for row, anchor, home in anchors(fp, radius):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(fp[row]), pa.array(home), pa.array(key[row])], ["anchor", "fp", "home", "key"])
    return run


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest row of each row's component under the edges (a, b)."""
    label = np.arange(n) if label is None else label
    while True:
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        new = label.copy()
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def bucket_links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole buckets, as fingerprints (rows sorted by anchor, homes first)."""
    a, b = linked_rows(anchor, fp, home, max_bits)
    return fp[a], fp[b]


def linked_rows(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole buckets, as rows."""
    n = len(anchor)
    label, wide = np.arange(n), fp.view(np.uint64)
    edge_a: list[np.ndarray] = []
    edge_b: list[np.ndarray] = []
    held, shift = 0, 1
    rows = np.flatnonzero(home)
    while True:
        rows = rows[rows + shift < n]
        rows = rows[anchor[rows] == anchor[rows + shift]]
        if not len(rows):
            break
        near = np.bitwise_count(wide[rows] ^ wide[rows + shift]) <= max_bits
        a = rows[near]
        b = a + shift
        apart = label[a] != label[b]
        edge_a.append(a[apart])
        edge_b.append(b[apart])
        held += int(apart.sum())
        if held > EDGE_BUFFER:
            label = forest(n, np.concatenate(edge_a), np.concatenate(edge_b), label)
            edge_a, edge_b, held = [], [], 0
        shift += 1
    if held:
        label = forest(n, np.concatenate(edge_a), np.concatenate(edge_b), label)
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _nodes(key: np.ndarray, fp: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(key), pa.array(fp)], ["key", "fp"])


def _compare(max_bits: int) -> Callable:
    """Links of a partition sorted by anchor, whole anchors at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]

        def links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
            a, b = linked_rows(anchor, fp, home, max_bits)
            return pa.RecordBatch.from_arrays([_nodes(key[a], fp[a]), _nodes(key[b], fp[b])], ["a", "b"])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            if len(held[0]):
                cut = int(np.searchsorted(held[0], held[0][-1]))
                if cut:
                    yield links(*[x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if len(held[0]):
            yield links(*held)
    return run


NODE = "struct<key:bigint,fp:bigint>"


def fingerprint_links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links ``a, b`` between different fingerprints (``fp``, distinct, with ``class_key``), as nodes of both."""
    radius = COVERING_RADIUS + max_bits // len(BLOCKS)
    replicas = classes.select("fp", "class_key").mapInArrow(_replicate(radius), "anchor bigint, fp bigint, home boolean, key bigint")
    return replicas.repartition("anchor").sortWithinPartitions("anchor", F.desc("home"), "fp") \
        .mapInArrow(_compare(max_bits), f"a {NODE}, b {NODE}")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows ``doc_id, fingerprint, component_id, class_id``, one for each row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links, the
    row's own included; ``class_id`` is the smallest id with the same
    fingerprint.
    """
    rows = saved(fingerprints(docs, id_col, text_col, shingle))
    classes = rows.groupBy("fp").agg(F.min("key").alias("class_key"))
    # a node is its smallest id, then its fingerprint, so the smallest node of a component names it without another grouping
    roots = components(fingerprint_links(classes, max_bits))
    labels = classes.join(roots, classes.fp == roots.node.fp, "left") \
        .select("fp", "class_key", F.coalesce("root.key", "class_key").alias("component_key"))
    return rows.join(labels, "fp").select(
        key_id("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        key_id("component_key").alias("component_id"),
        key_id("class_key").alias("class_id"))
