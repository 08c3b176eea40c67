"""Variable-capacity best-fit packing of documents into training sequences.

Lengths are tokens of a vocabulary and one place for the end mark
(:func:`token_packed`), or any whole number per document (:func:`packed`).
A document longer than the largest permitted length is cut into pieces of
that length and a rest. Pieces are dealt into groups of about
``GROUP_PIECES`` rows by a hash; a group is packed on its own:

* pieces go longest first, each into the open bin with the least room that
  still holds it (best fit; ties: the oldest bin);
* where none holds it, a bin opens at the permitted length with the least
  cost per word that it can expect to hold: the piece and, up to its
  capacity, all later pieces that would fit beside it;
* the group is packed once for every upper limit on opened lengths, so the
  lengths are weighed jointly, and the cheapest packing is kept;
* at the end every bin shrinks to the smallest permitted length that holds
  its contents. Costs are compared after that step.

The cost of a sequence of length c is ``c + c * c / ATTENTION + FIXED``:
work in proportion, attention, and a fixed share per sequence.

Scale. Texts are encoded once, in place; their lengths are saved, as the number
of groups and the pieces both follow from them. Only ids and lengths are
shuffled, once. There are as many groups as
give each about ``GROUP_PIECES`` documents and no more than about twice as many
pieces, so groups are bounded at any table size and length of documents.

Defined cases: an empty or null text has one piece of length 0 that is in no
bin (null ``bin_id``); a null id is returned as null; repeated rows are
packed each; ties keep the order of id, row and piece; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderscope.llm.frames import id_key, key_id, saved
from orderscope.llm.token_counts import VOCABULARY, token_lengths

CAPACITIES = (512, 1024, 2048, 4096)
ATTENTION, FIXED = 16384, 32
GROUP_PIECES = 50_000
OUT = ("key bigint, row bigint, piece bigint, start bigint, length bigint, bin_id bigint, bin_capacity int, "
       "bin_used int, bin_offset int")


def cost(capacity: int) -> float:
    return capacity + capacity * capacity / ATTENTION + FIXED


def shrunk(used: int, capacities: tuple[int, ...]) -> int:
    """The smallest permitted length that holds the contents."""
    return next(c for c in capacities if c >= used)


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...], limit: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Pack lengths given in descending order; bins open at ``limit`` or less where the piece allows.

    Returns each piece's bin and offset, and the contents of each bin.
    """
    top = capacities[-1]
    below = np.cumsum(np.bincount(lengths, minlength=top + 1) * np.arange(top + 1))
    open_size = {}
    open_bins: list[deque[int]] = [deque() for _ in range(top + 1)]      # by room
    rooms = 0                                                            # bit r: some bin has room r
    room_of: list[int] = []
    used: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].popleft()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            if length not in open_size:
                choice = [c for c in capacities if c >= length and (c <= limit or c == shrunk(length, capacities))]
                open_size[length] = min(choice, key=lambda c: cost(c) / min(c, length + below[min(c - length, length)]))
            b, room = len(used), open_size[length]
            used.append(0)
            room_of.append(room)
        bins[i], offsets[i] = b, used[b]
        used[b] += length
        room -= length
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return bins, offsets, used


def pack(lengths: np.ndarray, capacities: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """The cheapest packing over all limits: bins, offsets, contents and final length of each bin."""
    best: tuple | None = None
    for limit in capacities:
        bins, offsets, used = best_fit(lengths, capacities, limit)
        final = [shrunk(u, capacities) for u in used]
        total = sum(map(cost, final))
        if best is None or total < best[0]:
            best = total, bins, offsets, used, final
    return best[1:]


def _pack_group(capacities: tuple[int, ...]):
    def run(group: pa.Table) -> pa.Table:
        key, row, piece, length = (group.column(c).to_numpy() for c in ("key", "row", "piece", "length"))
        number = int(group.column("group_")[0].as_py())
        order = np.lexsort((piece, row, key, -length))
        some = order[length[order] > 0]
        n = len(key)
        ids, capacity, contents, offset = (np.zeros(n, np.int64) for _ in range(4))
        if len(some):
            bins, at, used, final = pack(length[some], capacities)
            ids[some], offset[some] = (number << 32) | bins, at
            capacity[some], contents[some] = np.array(final)[bins], np.array(used)[bins]
        none = length == 0
        return pa.table({
            "key": key, "row": row, "piece": piece, "start": piece * capacities[-1], "length": length,
            "bin_id": pa.array(ids, mask=none), "bin_capacity": pa.array(capacity.astype(np.int32), mask=none),
            "bin_used": pa.array(contents.astype(np.int32), mask=none),
            "bin_offset": pa.array(offset.astype(np.int32), mask=none)})
    return run


def word_count(text: Column) -> Column:
    """Words between white space, and one place for the end mark; empty texts have none."""
    n = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    return F.when(n > 0, n + 1).otherwise(n)


def packed(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None,
           capacities: tuple[int, ...] = CAPACITIES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Rows ``doc_id, piece, start, length, bin_id, bin_capacity, bin_used, bin_offset``, one per piece.

    ``length``: any whole-number expression over ``docs``, e.g. a token
    count; by default :func:`word_count` of ``text``.
    """
    capacities = tuple(sorted(capacities))
    top = capacities[-1]
    measured = docs.select(id_key(id_col).alias("key"), F.monotonically_increasing_id().alias("row"),
                           (word_count(F.col("text").cast("string")) if length is None else length.cast("bigint")).alias("size"))
    pieces = measured.select("key", "row", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(
        F.expr(f"(size - 1) div {top}"), F.lit(0).cast("bigint")))).alias("piece")) \
        .select("key", "row", "piece", F.least(F.col("size") - F.col("piece") * top, F.lit(top)).alias("length"))
    total = measured.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.greatest(F.expr(f"(size - 1) div {top} + 1"), F.lit(1).cast("bigint"))).alias("pieces")).first()
    n_groups = max(1, -(-total["docs"] // group_pieces), -(-(total["pieces"] or 0) // (2 * group_pieces)))
    dealt = pieces.withColumn("group_", F.pmod(F.xxhash64("key", "row", "piece"), F.lit(n_groups)))
    return dealt.groupBy("group_").applyInArrow(_pack_group(capacities), OUT) \
        .select(key_id("key").alias("doc_id"), "piece", "start", "length", "bin_id", "bin_capacity", "bin_used", "bin_offset")


def token_packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 lines: bytes | None = None, capacities: tuple[int, ...] = CAPACITIES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """:func:`packed` by the texts' own tokens and an end mark; texts without tokens are in no sequence."""
    lengths = saved(token_lengths(docs, id_col, text_col, vocabulary, lines))
    n = F.col("n_tokens")
    return packed(lengths, "doc_id", F.when(n > 0, n + 1).otherwise(0), capacities, group_pieces)
