"""The training-text pipeline: five stages, each one operator of ``orderscope.llm``.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

1. ``quality``: documents with a score under 0.5 go.
2. ``near_duplicates``: of each SimHash component the row with the smallest id
   stays; rows that share an id, or have none, are documents of their own.
3. ``repeated_passages``: words under repeated 20-word windows go; a document
   that loses none keeps its text as it is.
4. ``benchmark``: documents that hold a benchmark window go.
5. ``packing``: the rest is packed into sequences by its tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.llm import decontaminate, packing, quality, simhash, substring
from orderscope.llm.frames import id_key, key_id, read
from orderscope.session import fresh_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter("score >= 0.5").select("doc.*")


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _row_hash() -> Column:
    return F.xxhash64(id_key("doc_id"), F.col("text").cast("string"))


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component: the smallest id, a text rather than none, the smallest hash of the text.

    Components are those of the texts, so rows that share an id, or have none, are apart where their texts are.
    Of rows equal in id and text the one whose columns, as JSON, come first stays.
    """
    texts = docs.select(_text_hash().alias("hash"), F.col("text"))
    labels = simhash.simhash_components(texts, "hash").select(F.col("doc_id").alias("hash"), F.col("component_id").alias("component")).distinct()
    rows = docs.select(id_key("doc_id").alias("key"), F.col("text").isNull().alias("missing"), _text_hash().alias("hash"))
    firsts = rows.groupBy("hash").agg(F.min(F.struct("key", "missing", "hash")).alias("first"))
    kept = firsts.join(labels, "hash").groupBy("component").agg(F.min("first").alias("first")).select("first.key", "first.hash")
    keyed = docs.select(id_key("doc_id").alias("key"), _text_hash().alias("hash"), _whole(docs))
    return keyed.join(kept, ["key", "hash"]).groupBy("key", "hash") \
        .agg(F.min_by("doc", F.struct(F.col("doc.text"), F.to_json("doc"))).alias("doc")).select("doc.*")


def _row_keyed(docs: DataFrame) -> DataFrame:
    """Rows ``key, doc``: the id where it is a row's own, else a negative number from id and text."""
    keyed = docs.select(id_key("doc_id").alias("key"), _row_hash().alias("hash"), _whole(docs))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", F.lit(True).alias("shared"))
    if shared.isEmpty():
        return keyed.select("key", "doc")
    other = -F.shiftrightunsigned("hash", 1) - 1
    return keyed.join(shared, "key", "left").select(F.when(F.col("shared"), other).otherwise(F.col("key")).alias("key"), "doc")


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _row_keyed(docs)
    texts = rows.select(key_id("key").alias("key"), F.col("doc.text").alias("text"))
    kept = substring.substring_dedup(texts, "key", untouched_as_is=True).select(id_key("doc_id").alias("key"), "kept_text")
    rest = [c for c in docs.columns if c != "text"]
    keyed = rows.select("key", F.struct(*[F.col(f"doc.`{c}`") for c in rest]).alias("doc"))
    out = keyed.join(kept, "key").select("doc.*", F.col("kept_text").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*[f"`{c}`" for c in docs.columns])


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(docs.select(_row_hash().alias("row"), "text"), read(spark, sf_dir, "benchmark"), "row")
    leaked = found.filter("contaminated").select(F.col("doc_id").alias("row")).distinct()
    return docs.select(_row_hash().alias("row"), _whole(docs)).join(leaked, "row", "left_anti").select("doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.token_packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

# Model scores, components and greedy packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
