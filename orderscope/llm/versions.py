"""Document fingerprints as invertible Bloom lookup sketches.

A document's paragraphs are its lines, cut after sentence ends; its set of
64-bit paragraph digests goes into a table of cells. Each digest is in one
cell of each of three subtables; a cell holds the count of its digests and
the xor of the digests and of their checks. The fingerprint is the table of
``BASE_CELLS`` cells as text.

Two versions are compared by subtracting tables of one size cell by cell:
what both hold cancels, and a cell left with a single digest (count 1 or -1
and a check that agrees) gives it away, so it can be taken out of its other
cells too, and so on. The table size follows from the two digest counts, which
the tables hold. Where cells remain (about one pair in a hundred), the
comparison of those documents is repeated with eight times the cells and other
hashes. With d recovered digests the likeness is
``(a + b - d) / (a + b + d)``, the share of common ones (1 if both are empty).

Everything is DataFrame operations: cells are rows, adding up and subtracting
are aggregations, and a peeling step is an ``explode`` of the pure cells of
one subtable (where each digest is once) with another aggregation.

Scale. Texts are shuffled once, by id; cells are aggregated in the same
partitions without another exchange, however many steps. From the next
document only its head and digests are sent. The order of ids comes from a
distributed sort of the ids. A document's cells are rows, so a long document
is split over spilling aggregations and nothing is gathered but a fingerprint.

Defined cases: null text counts as empty; an empty text has no cells and the
fingerprint ``""``; every row is a document of its own; rows that share an id
follow each other in the order of their texts' hashes (null first); a null id
is the smallest and is returned as null; a table's only document is its own
next; an empty table gives no rows; other columns are ignored, whatever their
names. :func:`changed_paragraphs` matches versions by id: there, rows of one
table that share an id count as one version, the smallest of their texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderscope.llm.frames import id_key, key_id, numbered, one_text_per_id, own_keys, saved

BASE_CELLS = 12
SPARE_CELLS = 36
BROADCAST_IDS = 200_000
STEPS = 12                       # peeling steps of an attempt, one subtable each
CUT = r"(?<=[.!?])\s+|\n+"       # between paragraphs
CHECK = 1_000_003                # seed of the check hash
CELL = "struct<kind:tinyint,size:int,cell:int,n:bigint,digest:bigint,check:bigint,info:string>"


def digests(text: Column) -> Column:
    """Different paragraph digests of a text."""
    parts = F.filter(F.split(text, CUT), lambda x: F.trim(x) != "")
    return F.array_distinct(F.transform(parts, lambda x: F.xxhash64(x)))


def _place(digest: Column, size: Column, table: int, attempt: int) -> Column:
    return (F.pmod(F.xxhash64(digest, F.lit(table + 3 * attempt)), size) + size * table).cast("int")


def _cell(kind: Column, size: Column, cell: Column, n: Column, digest: Column, check: Column, info: Column) -> Column:
    return F.struct(kind.cast("tinyint").alias("kind"), size.cast("int").alias("size"), cell.cast("int").alias("cell"),
                    n.cast("bigint").alias("n"), digest.cast("bigint").alias("digest"),
                    check.cast("bigint").alias("check"), info.cast("string").alias("info"))


def _entries(values: Column, kind: int, size: Column, sign: int, attempt: int) -> Column:
    """Three cell entries for each digest of an array."""
    none = F.lit(None).cast("string")
    return F.flatten(F.transform(values, lambda x: F.array(*[
        _cell(F.lit(kind), size, _place(x, size, table, attempt), F.lit(sign), x, F.xxhash64(x, F.lit(CHECK)), none)
        for table in range(3)])))


def _summed(entries: DataFrame) -> DataFrame:
    """Add up entries to cells; cells that are empty after subtraction go."""
    return entries.groupBy("key", "kind", "size", "cell", "info") \
        .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check")) \
        .filter("n != 0 or digest != 0 or check != 0 or info is not null")


def _peel(cells: DataFrame, table: int, attempt: int, keep_digests: bool) -> DataFrame:
    """Take the pure cells of one subtable out of the others; what they held becomes a tally (cell -1)."""
    pure = (F.col("kind") >= 2) & (F.col("cell") >= F.col("size") * table) & (F.col("cell") < F.col("size") * (table + 1)) \
        & (F.abs("n") == 1) & (F.col("check") == F.xxhash64("digest", F.lit(CHECK)))
    kind, size, n, digest, check = (F.col(c) for c in ("kind", "size", "n", "digest", "check"))
    told = F.concat_ws(":", n.cast("string"), digest.cast("string")) if keep_digests else F.lit("")
    others = [_cell(kind, size, _place(digest, size, t, attempt), -n, digest, check, F.lit(None)) for t in range(3) if t != table]
    tally = _cell(kind, size, F.lit(-1), F.lit(1), F.lit(0), F.lit(0), told)
    itself = _cell(kind, size, F.col("cell"), n, digest, check, F.col("info"))
    return _summed(cells.select("key", F.inline(F.when(pure, F.array(tally, *others)).otherwise(F.array(itself)))))


def _peeled(rows: DataFrame, entries: Column, attempt: int, keep_digests: bool = False) -> DataFrame:
    """Build, subtract and peel: ``entries`` is an array of cell entries for each row of ``rows`` (with ``key``)."""
    cells = _summed(rows.select("key", F.inline(entries.cast(f"array<{CELL}>"))))
    for step in range(STEPS + 3 * attempt):
        cells = _peel(cells, step % 3, attempt, keep_digests)
    return cells


def _size(a: Column, b: Column, share: float, attempt: int) -> Column:
    """Cells of a subtable for versions with so many digests together."""
    cells = (F.size(a) + F.size(b)) * share + SPARE_CELLS
    return F.ceil(cells * (1 << 3 * attempt) / 3).cast("int")


def changed_paragraphs(old: DataFrame, new: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       share: float = 1.0, attempts: int = 8) -> DataFrame:
    """Digests by which two versions of the same documents differ: ``doc_id, digest, side``.

    ``side`` is 1 for digests of the old version alone and -1 for the new
    one's. ``share`` sets the first table size over the digest counts.
    Documents whose cells do not come apart are tried again, larger.
    """
    a = one_text_per_id(old, id_col, text_col).select("key", digests(F.coalesce("text", F.lit(""))).alias("a"))
    b = one_text_per_id(new, id_col, text_col).select("key", digests(F.coalesce("text", F.lit(""))).alias("b"))
    none = F.array().cast("array<bigint>")
    pairs = saved(a.join(b, "key", "full").select("key", F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b")))
    out: DataFrame | None = None
    for attempt in range(attempts):
        size = _size(F.col("a"), F.col("b"), share, attempt)
        entries = F.concat(_entries(F.col("a"), 2, size, 1, attempt), _entries(F.col("b"), 2, size, -1, attempt))
        cells = saved(_peeled(pairs, entries, attempt, keep_digests=True))
        failed = cells.filter("cell >= 0").select("key").distinct()
        told = F.split("info", ":")
        good = cells.filter("cell < 0").join(failed, "key", "left_anti").select(
            key_id("key").alias("doc_id"), told[1].cast("bigint").alias("digest"), told[0].cast("int").alias("side"))
        out = good if out is None else out.unionByName(good)
        if failed.isEmpty():
            return out
        pairs = saved(pairs.join(failed, "key", "left_semi"))
    raise RuntimeError(f"{attempts} table sizes did not decode")


def _next_links(docs: DataFrame, id_col: str) -> DataFrame:
    """Rows ``key, next_key``: ids in ascending order, the last before the first."""
    ranked = saved(numbered(docs.select(id_key(id_col).alias("key")).distinct(), "key"))
    total = ranked.count()
    after = ranked.select(F.col("key").alias("next_key"), F.pmod(F.col("rank") - 1, F.lit(max(total, 1))).alias("rank"))
    return saved(ranked.join(after, "rank").select("key", "next_key"))


def _versions(docs: DataFrame, links: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each linked document with its edited text and the digests a (own), e (edited), n (next)."""
    texts = one_text_per_id(docs, id_col, text_col).select("key", F.coalesce("text", F.lit("")).alias("text"))
    quarter = F.expr("cast(floor(length(text) / 4) as int)")
    wanted = links.join(texts.select("key", quarter.alias("k")), "key") \
        .select(F.col("next_key").alias("key"), F.col("key").alias("to"), "k")
    given = wanted.join(texts.hint("merge"), "key") \
        .select(F.col("to").alias("key"), F.expr("substring(text, 1, k)").alias("head"), digests(F.col("text")).alias("n"))
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"), F.col("head"))
    return texts.join(given.hint("merge"), "key") \
        .select("key", F.length("text").cast("bigint").alias("n_chars"), "text", edited.alias("edited"), "n") \
        .select("key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"),
                digests(F.col("edited")).alias("e"), "n")


def _likeness(a: Column, b: Column, d: Column) -> Column:
    return F.when(a + b + d == 0, F.lit(1.0)).otherwise((a + b - d) / (a + b + d))


def _compared(versions: DataFrame, attempt: int, base: int) -> DataFrame:
    """Fingerprints and both comparisons of each document, null where cells remain."""
    a, e, n = F.col("a"), F.col("e"), F.col("n")
    small = F.lit(-(-base // 3))
    near, far = _size(a, e, 0.75, attempt), _size(a, n, 2.0, attempt)
    info = F.concat_ws(";", F.col("n_chars").cast("string"), F.col("edited_sha256"), F.size(a).cast("string"),
                       F.size(e).cast("string"), F.size(n).cast("string"))
    entries = F.concat(
        _entries(a, 0, small, 1, 0), _entries(e, 1, small, 1, 0),
        _entries(a, 2, near, 1, attempt), _entries(e, 2, near, -1, attempt),
        _entries(a, 3, far, 1, attempt), _entries(n, 3, far, -1, attempt),
        F.array(_cell(F.lit(-1), F.lit(0), F.lit(-2), F.lit(1), F.lit(0), F.lit(0), info)))
    cells = _peeled(versions, entries, attempt)
    is_kind = lambda k: F.col("kind") == k
    text = F.concat(F.lpad(F.hex("cell"), 2, "0"), F.lit("."), F.col("n").cast("string"), F.lit("."),
                    F.lpad(F.hex("digest"), 16, "0"), F.lpad(F.hex(F.col("check").bitwiseAND(0xFFFFFFFF)), 8, "0"))
    table = lambda k: F.array_join(F.array_sort(F.collect_list(F.when(is_kind(k), F.lower(text)))), " ")
    found = lambda k: F.coalesce(F.sum(F.when(is_kind(k) & (F.col("cell") == -1), F.col("n"))), F.lit(0))
    rest = lambda k: F.count_if(is_kind(k) & (F.col("cell") >= 0))
    told = F.split("info", ";")
    counts = [told[i].cast("double") for i in (2, 3, 4)]
    return cells.groupBy("key").agg(
        F.max(F.when(is_kind(-1), F.col("info"))).alias("info"), table(0).alias("fingerprint"), table(1).alias("edited_fingerprint"),
        found(2).alias("d_edited"), found(3).alias("d_next"), rest(2).alias("rest_edited"), rest(3).alias("rest_next")) \
        .select("key", told[0].cast("bigint").alias("n_chars"), told[1].alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                F.when(F.col("rest_edited") == 0, _likeness(counts[0], counts[1], F.col("d_edited"))).alias("near_edited"),
                F.when(F.col("rest_next") == 0, _likeness(counts[0], counts[2], F.col("d_next"))).alias("near_next"))


def version_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: int = BASE_CELLS,
                         attempts: int = 8) -> DataFrame:
    """Rows ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last quarter (in code points, rounded down)
    replaced by the first as many of the next document's text.
    """
    docs, restored = own_keys(docs, id_col, text_col)
    links = _next_links(docs, "key")
    rows = saved(_compared(_versions(docs, links, "key", "text"), 0, base))
    open_ = F.col("near_edited").isNull() | F.col("near_next").isNull()
    failed, mended = rows.filter(open_).select("key"), []
    for attempt in range(1, attempts):
        n_failed = failed.count()
        if not n_failed:
            break
        again = saved(links.join(failed, "key"))
        needed = again.select("key").union(again.select("next_key")).distinct()
        # few ids as a rule: sent to all tasks only within a bound, else shuffled to the texts
        needed = F.broadcast(needed) if n_failed <= BROADCAST_IDS else needed
        some = docs.join(needed, "key", "left_semi")
        tried = saved(_compared(_versions(some, again, "key", "text"), attempt, base).select("key", "near_edited", "near_next"))
        mended.append(tried.filter(~open_))
        failed = tried.filter(open_).select("key")
    else:
        if not failed.isEmpty():
            raise RuntimeError(f"{attempts} table sizes did not decode")
    if mended:
        patch = reduce(DataFrame.unionByName, mended).withColumnsRenamed({"near_edited": "edited_", "near_next": "next_"})
        rows = rows.join(patch, "key", "left").withColumns({
            "near_edited": F.coalesce("edited_", "near_edited"), "near_next": F.coalesce("next_", "near_next")})
    return restored(rows.select("key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
