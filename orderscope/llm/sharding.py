"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a hash ring; a key's place is
a hash of its id, and it belongs to the next point clockwise. A shard that is
full passes its further keys on clockwise, to the next point of a shard that
still has room. Keys fill in the order of their places, so each arc between
two points keeps its first keys and hands on the rest.

What an arc does depends on counts alone: the ring has 2^16 cells, the driver
takes one count per cell (whatever the table size), passes overflow round the
ring and gets, for each cell, how many of its keys go to which shard. A key
then needs only its rank on the sorted ring, which a distributed sort gives.

``load`` is the capacity of a shard over the mean. At 1 the capacities are
the whole numbers that differ by one at most, and all are filled: the law
``rows``. With more, fewer keys move when a shard is added.

Scale. The sort moves ids and sizes, not texts. Arcs are ranges of a hash, so
no source or group of copies makes an arc hot; rows that share an id share a
place and are split by overflow like others.

Defined cases: null text has size 1 and checksum 0; a null id hashes like the
smallest number and is returned as null; repeated rows get a slot each; ties on
the ring are ordered by id, size and checksum; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderscope.llm.frames import id_key, key_id, numbered

SHARDS, VNODES = 16, 64
CELL_BITS = 16


def ring(shards: int, vnodes: int) -> list[int]:
    """For each cell of the ring, the shard of the virtual node at or after it clockwise.

    A virtual node stands at the end of its cell; of several in a cell the
    smallest hash counts.
    """
    nodes: dict[int, tuple[int, int]] = {}
    for shard in range(shards):
        for node in range(vnodes):
            h = xxhash.xxh64_intdigest(f"{shard}/{node}", 42)
            cell = h >> (64 - CELL_BITS)
            nodes[cell] = min(nodes.get(cell, (h, shard)), (h, shard))
    owners: list[int] = []
    owner = nodes[min(nodes)][1]                        # cells after the last node belong to the first
    for cell in reversed(range(1 << CELL_BITS)):
        owner = nodes.get(cell, (0, owner))[1]
        owners.append(owner)
    return owners[::-1]


def capacities(total: int, shards: int, load: float) -> list[int]:
    """Room of each shard: at load 1 whole numbers at most one apart that sum to ``total``."""
    if load <= 1:
        return [total // shards + (shard < total % shards) for shard in range(shards)]
    return [-int(-total * load // shards)] * shards


def clockwise(owners: list[int]) -> list[tuple[int, int, list[int]]]:
    """Arcs (first cell, end cell, different shards in clockwise order from it)."""
    cuts = [0, *[c for c in range(1, len(owners)) if owners[c] != owners[c - 1]]]
    arcs = list(zip(cuts, [*cuts[1:], len(owners)], strict=True))
    ways = []
    for i in range(len(arcs)):
        way = dict.fromkeys(owners[arcs[j % len(arcs)][0]] for j in range(i, i + len(arcs)))
        ways.append(list(way))
    return [(first, end, way) for (first, end), way in zip(arcs, ways, strict=True)]


def flows(counts: list[int], ways: list[list[int]], room: list[int]) -> list[list[tuple[int, int]]]:
    """For each arc, (shard, keys) in the order in which its keys are handed out.

    In round r every arc offers the keys it has left to the r-th shard on its
    way. A full shard stays full, so one round for each shard places all keys.
    """
    left, room = list(counts), list(room)
    taken: list[list[tuple[int, int]]] = [[] for _ in counts]
    for turn in range(len(room)):
        for arc, way in enumerate(ways):
            if left[arc] and turn < len(way) and (moved := min(left[arc], room[way[turn]])):
                taken[arc].append((way[turn], moved))
                left[arc] -= moved
                room[way[turn]] -= moved
    return taken


def allotment(cell_counts: list[int], shards: int, vnodes: int, load: float) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (cell, first rank, end rank, shard, slot of the first, home shard) that place every key."""
    owners = ring(shards, vnodes)
    arcs = clockwise(owners)
    starts = [0, *accumulate(cell_counts)]
    counts = [starts[end] - starts[first] for first, end, _ in arcs]
    taken = flows(counts, [way for _, _, way in arcs], capacities(starts[-1], shards, load))
    slots, rows = [0] * shards, []
    for (first, _, _), moves in zip(arcs, taken, strict=True):
        at, cell = starts[first], first
        for shard, n in moves:
            stop = at + n
            while at < stop:
                while starts[cell + 1] <= at:
                    cell += 1
                end = min(stop, starts[cell + 1])
                rows.append((cell, at, end, shard, slots[shard], owners[cell]))
                slots[shard] += end - at
                at = end
    return rows


def sharded(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, load: float = 1.0,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, size, text_crc32, shard, slot, home_shard``, one for each row of ``docs``.

    ``slot`` counts a shard's rows from 0 without gaps; ``home_shard`` is
    where the key would go without bounds.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(id_key(id_col).alias("key"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).alias("crc"))
    placed = numbered(rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("key"), 1)), "place", "key", "size", "crc") \
        .withColumn("cell", F.shiftright("place", 63 - CELL_BITS).cast("int"))
    counts = [0] * (1 << CELL_BITS)                      # one number for each cell, at any table size
    for cell, n in placed.groupBy("cell").count().collect():
        counts[cell] = n
    plan = docs.sparkSession.createDataFrame(
        allotment(counts, shards, vnodes, load) or [(-1, 0, 0, 0, 0, 0)],
        "cell int, low bigint, high bigint, shard int, base bigint, home_shard int")
    return placed.join(F.broadcast(plan), "cell").filter("rank >= low and rank < high").select(
        key_id("key").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("base") + F.col("rank") - F.col("low")).alias("slot"), "home_shard")
