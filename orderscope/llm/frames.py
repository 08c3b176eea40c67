"""Spark helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.operators.ranks import numbered
from orderscope.session import saved

__all__ = ["NULL_ID", "components", "id_key", "key_id", "numbered", "one_text_per_id", "own_keys", "picked", "read", "saved"]

# Stands for a null document id inside the operators: it sorts before all others.
NULL_ID = -(1 << 63)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names, found by exact name: others may differ from them in case only."""
    placed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return placed.select(*[F.col(f"c{docs.columns.index(old)}").alias(new) for new, old in columns.items()])


def id_key(column: str) -> Column:
    """The document id with null as the smallest value."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NULL_ID))


def key_id(column: str) -> Column:
    """Back from :func:`id_key`."""
    return F.when(F.col(column) != NULL_ID, F.col(column))


def one_text_per_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows ``key, text``, hash-partitioned by key.

    Rows that share an id count as one document; its text is the smallest of
    theirs (null only if all are). Later joins on the key reuse this
    exchange, so the texts are shuffled once.
    """
    return docs.groupBy(id_key(id_col).alias("key")).agg(F.min(F.col(text_col).cast("string")).alias("text"))


def own_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows ``key, text``, one for each row of ``docs``, and the way back from ``key`` to ``doc_id``.

    Where no two rows share an id (or have none), the key is the id. Else keys
    are places in the order of ids (null first), then texts (null first, then by
    their hashes), so every row is a document of its own and keys ascend with
    ids. Finding shared ids shuffles ids alone; numbering sorts ids and
    hashes, and a text that several rows hold travels once.
    """
    rows = picked(docs, id=id_col, text=text_col).select(id_key("id").alias("key"), F.col("text").cast("string").alias("text"))
    if rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return rows, lambda out: out.withColumn("key", key_id("key")).withColumnRenamed("key", "doc_id")
    by_text = [F.col("key").alias("id"), F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h1"),
               F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(17), "text")).alias("h2")]
    # the copy only tells equal rows apart, so that the sort can deal them to several tasks
    copies = rows.select(*by_text, F.monotonically_increasing_id().alias("copy"))
    places = saved(numbered(copies, "id", "h1", "h2", "copy", label="key").select("key", "id", "h1", "h2"))
    texts = rows.select(*by_text, "text").groupBy("id", "h1", "h2").agg(F.min("text").alias("text"))
    same = [places[c].eqNullSafe(texts[c]) for c in ("id", "h1", "h2")]
    keyed = saved(places.join(texts, same).select(places["key"], texts["text"]))
    ids = places.select("key", key_id("id").alias("doc_id"))
    return keyed, lambda out: ids.join(out, "key").drop("key")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: rows ``node, root``.

    ``root`` is the smallest node that can be reached. Alternating large-star
    and small-star rounds; each round's edges are checkpointed, and the loop
    ends when a round changes nothing. No group is gathered: a node's
    neighbours are reduced by min, and stars are joins on the node.
    """
    current = saved(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        changed = saved(_star(_star(current, large=True), large=False))
        same = _same(current, changed)
        current = changed
        if same:
            break
    members = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return members.unionByName(roots)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over edges with ``a > b``.

    Large star: every node's larger neighbours link to its smallest
    neighbour or itself. Small star: a node and its smaller neighbours link
    to the smallest of them.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    linked = both.join(lowest, "a")
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("x"), F.col("low").alias("y"))
    else:
        out = linked.select(F.col("b").alias("x"), F.col("low").alias("y")) \
            .unionByName(lowest.select(F.col("a").alias("x"), F.col("low").alias("y")))
    return out.filter("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two distinct edge sets are equal, by count and by two hash sums."""
    def sums(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                            F.bit_xor(F.xxhash64("b", "a"))).first())
    return sums(a) == sums(b)
