"""Source divergence audit: how far each source's words are from its language's other sources.

Tokenizer: one ``bytes.translate`` lowers A-Z and blanks every other ASCII
byte, ``bytes.split`` cuts, and a ``Counter`` for each document gives its
counts; a document adds one to the document count of each of its terms. A
task sums them by (lang, source, term) and hands on sums whenever it holds
``HELD`` of them, so what is shuffled is vocabulary, not text, and a source
with a third of all rows arrives as sums from every task.

A language keeps the V terms of at least ``MIN_DOCUMENTS`` of its documents.
Each (lang, source) group, and each language, gives a kept term that occurs
``count`` times there the probability p = 1 + floor(10^9 (count + 1) / (N + V)),
N being the sum over kept terms. The divergence of two probabilities is
f = floor((p - q)^2 / q), p the group's.

* ``pair``: for every other source of the language, f summed over all kept terms;
* ``term``: the kept terms that the group has and favours over its language.

All terms count in a pair but only those that occur are touched. With z the
probability of a term that does not occur, the sum over all kept terms is the
sum over s's terms of f(p, z_t), plus that over t's terms of f(z_s, q), plus,
for terms of both, f(p, q) - f(p, z_t) - f(z_s, q), plus f(z_s, z_t) for each
term of neither. The first two come from a table of how many terms of a group
have each probability; only the third meets two sources at a term: a term held
by k sources costs k (k - 1) / 2 rows, summed on the map side. The result
itself has a row for every two sources of a language.

Arithmetic is exact: probabilities by decimal division (counts may be any
long), the rest in longs. Sums stay under about 10^18 as probabilities of a
group sum to 10^9 + V; an overflow raises, it never wraps.

Shuffles: sums by (lang, source, term), then by (lang, term), both stored once
in the shared folder as they are read several times; the group table (one row
for each lang and source) is stored too, so that Spark sees its file size and
broadcasts it only below its own threshold. Top ranks are cut on the map side
before the window.

Defined cases: null text, lang and source count as empty strings; groups
without terms have p = 1 + floor(10^9 / V) everywhere; a language without kept
terms has pairs of value 0 and no term rows; a language with one source has no
pairs; repeated rows are documents of their own; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderscope.llm.frames import picked
from orderscope.session import fresh_path

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# Different (lang, source, term) sums a task holds before it hands them on.
HELD = 400_000

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TRANSLATE = bytes(b if b >= 0x80 else ord(chr(b).lower()) if b in _LETTERS else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TRANSLATE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one task: rows ``lang, source, term, n, docs``; an empty term stands for the group itself."""
    count: dict[tuple, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
    docs: dict[tuple, Counter] = defaultdict(Counter)
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in count.items():
            names = [b"", *own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()),
                 pa.array(names, pa.binary()).cast(pa.string()), pa.array([0, *own.values()], pa.int64()),
                 pa.array([0, *map(docs[lang, source].__getitem__, own)], pa.int64())], ["lang", "source", "term", "n", "docs"])
        count.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()), strict=True):
            key = lang or "", source or ""
            seen = Counter(terms(text.as_py()))
            own = count[key]
            held -= len(own)
            for term, n in seen.items():
                own[term] += n
            docs[key].update(seen.keys())
            held += len(own)
            if held >= HELD:
                yield from flush()
                held = 0
    yield from flush()


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, and its size is known to Spark."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _probability(count: Column | str, total: Column | str) -> Column:
    """1 + floor(10^9 (count + 1) / total), exactly."""
    scaled = (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)")
    total = (F.col(total) if isinstance(total, str) else total).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", scaled * F.lit(SCALE).cast("decimal(10,0)"), total)


def _f(p: str, q: str) -> Column:
    return F.call_function("div", (F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q))


def term_sums(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Rows ``lang, source, term, n, docs``; the row of an empty term stands for the group."""
    slim = picked(docs, lang=lang_col, source=source_col, text=text_col)
    counted = slim.select(*[F.col(c).cast("string") for c in slim.columns]) \
        .mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows ``lang, source, part, item, value, rank``."""
    sums = _stored(term_sums(docs, lang_col, source_col, text_col), "divergence-sums")
    by_term = sums.filter("term != ''").groupBy("lang", "term") \
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("held"))
    kept = _stored(by_term.filter(F.col("docs") >= min_documents).drop("docs"), "divergence-kept")
    groups = _stored(_group_table(sums, kept), "divergence-groups")
    holders = kept.select("lang", "term", "lang_n", F.inline("held")).join(groups, ["lang", "source"]) \
        .withColumn("p", _probability("n", "total"))
    return _pairs(kept, groups, holders).unionByName(_terms(holders, top_terms))


def _group_table(sums: DataFrame, kept: DataFrame) -> DataFrame:
    """One row for each group: its and its language's totals (N + V), terms, and the probability of an absent term."""
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_sum"))
    own = kept.select("lang", F.inline("held")).groupBy("lang", "source").agg(F.sum("n").alias("own_sum"), F.count(F.lit(1)).alias("terms"))
    rows = sums.filter("term = ''").select("lang", "source").join(langs, "lang", "left").join(own, ["lang", "source"], "left") \
        .fillna(0, ["v", "lang_sum", "own_sum", "terms"])
    rows = rows.select("lang", "source", "v", "terms", (F.col("own_sum") + F.col("v")).alias("total"), (F.col("lang_sum") + F.col("v")).alias("lang_total"))
    return rows.withColumn("z", F.when(F.col("v") > 0, _probability(F.lit(0), F.greatest("total", F.lit(1)))).otherwise(1))


def _pairs(kept: DataFrame, groups: DataFrame, holders: DataFrame) -> DataFrame:
    # terms of a group by probability, against every other source's absent term
    levels = holders.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("many"))
    absent = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("other_z"))
    one_sided = levels.join(absent, "lang").filter("source != other").groupBy("lang", "source", "other").agg(
        F.sum(F.col("many") * _f("p", "other_z")).alias("to_absent"), F.sum(F.col("many") * _f("other_z", "p")).alias("from_absent"))
    from_own = one_sided.select("lang", "source", "other", "to_absent")
    from_other = one_sided.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "from_absent")

    # terms that both have: every two sources of a term once, for both directions
    side = F.struct("source", "p", "z")
    at_term = holders.groupBy("lang", "term").agg(F.array_sort(F.collect_list(side)).alias("side"))
    two = at_term.select("lang", F.col("side"), F.posexplode("side").alias("i", "a")) \
        .select("lang", "a", F.explode(F.slice("side", F.col("i") + 2, F.size("side"))).alias("b")) \
        .select("lang", F.col("a.source").alias("a"), F.col("a.p").alias("p"), F.col("a.z").alias("pz"),
                F.col("b.source").alias("b"), F.col("b.p").alias("q"), F.col("b.z").alias("qz"))
    met = two.groupBy("lang", "a", "b").agg(
        F.count(F.lit(1)).alias("both"), F.sum(_f("p", "q") - _f("p", "qz") - _f("pz", "q")).alias("forth"),
        F.sum(_f("q", "p") - _f("q", "pz") - _f("qz", "p")).alias("back"))
    met = met.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("other"), F.col("both"), F.col("forth").alias("shared")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("other"), F.col("both"), F.col("back").alias("shared")))).alias("m")).select("lang", "m.*")

    other = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("other_z"), F.col("terms").alias("other_terms"))
    keys = ["lang", "source", "other"]
    rows = groups.join(other, "lang").filter("source != other") \
        .join(from_own, keys, "left").join(from_other, keys, "left").join(met, keys, "left") \
        .fillna(0, ["to_absent", "from_absent", "both", "shared"])
    neither = F.col("v") - F.col("terms") - F.col("other_terms") + F.col("both")
    value = F.col("to_absent") + F.col("from_absent") + F.col("shared") + neither * _f("z", "other_z")
    return _ranked(rows.select("lang", "source", F.col("other").alias("item"), value.alias("value")), "pair", None)


def _terms(holders: DataFrame, top: int) -> DataFrame:
    favoured = holders.withColumn("q", _probability("lang_n", "lang_total")).filter("p > q")
    return _ranked(favoured.select("lang", "source", F.col("term").alias("item"), _f("p", "q").alias("value")), "term", top)


def _ranked(rows: DataFrame, part: str, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
