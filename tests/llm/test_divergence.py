"""Source divergence: the whole result against a dense computation in Python integers, awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pandas as pd

from orderscope.llm import divergence
from orderscope.llm.divergence import audit, terms
from orderscope.llm.queries import ORACLE, op13_divergence
from orderscope.plans.compare import duckdb_connection

from .conftest import AWKWARD, LOWER, REPEATED, with_clashing_columns

SF = "/root/testdata/sf0.01"
SCHEMA = "lang string, source string, text string"


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_audit(rows, least=3, top=200):
    total, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        total[lang, source].update(plain_terms(text))
        docs[lang].update(set(plain_terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        whole = sum((total[lang, s] for s in sources), Counter())

        def chances(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 1) // (n + len(kept)) for t in kept}
        p, q = {s: chances(total[lang, s]) for s in sources}, chances(whole)
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            own = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if total[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", own, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def made(seed, n=150, sources=6):
    rng = random.Random(seed)
    words = ["Uno", "dos", "tres", "vier", "fünf", "six-seven", "ÄÖ", "日本", "x1y", *[f"w{chr(97 + i)}" for i in range(26)]]
    rows = []
    for _ in range(n):
        s = rng.randrange(sources)
        some = words[s:s + 12] if rng.random() < 0.7 else words
        rows.append((rng.choice(["en", "en", "de", None]), f"s{s}", " ".join(rng.choices(some, k=rng.randrange(30)))))
    return rows + [("en", "silent", ""), ("en", "none", None), ("lone", "only", "a a a b"), ("zz", "p", "q"), ("zz", None, "q"), (None, None, None)]


def test_tokens_equal_the_pattern():
    texts = [t for _, t in AWKWARD] + ["A\x00B\x1cC\x85D", "aZ[`{~é x", "9a_b-c"]
    assert [[w.decode() for w in terms((t or "").encode())] for t in texts] == [plain_terms(t) for t in texts]


def test_whole_result_against_a_dense_computation(spark):
    for seed in (1, 2):
        rows = made(seed)
        docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert got(audit(docs)) == plain_audit(rows)
    assert got(audit(docs, top_terms=3, min_documents=1)) == plain_audit(rows, 1, 3)


def test_sums_do_not_depend_on_when_a_task_hands_them_on(spark, monkeypatch):
    docs = spark.createDataFrame(made(3), SCHEMA)
    whole = got(audit(docs))
    monkeypatch.setattr(divergence, "HELD", 7)
    assert got(audit(docs)) == whole


def test_query_equals_its_sql(spark):
    expected = duckdb_connection(SF).sql(ORACLE["op13_divergence"]).df()
    rows = op13_divergence(spark, SF)
    mine = pd.DataFrame(rows.collect(), columns=rows.columns)
    order = ["lang", "source", "part", "rank"]
    columns = [*order, "item", "value"]
    a, b = (x[columns].sort_values(order).reset_index(drop=True) for x in (mine, expected))
    assert len(a) > 1000
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    assert dict(rows.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}


def test_defined_cases(spark):
    assert got(audit(spark.createDataFrame([], SCHEMA))) == []
    assert got(audit(spark.createDataFrame([("en", "a", None), ("en", "b", "")], SCHEMA))) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    clash = with_clashing_columns(spark, AWKWARD + REPEATED)
    assert got(audit(clash)) == plain_audit([("en", "s", t) for _, t in AWKWARD + REPEATED])
    cased = spark.createDataFrame([("en", "a", "x x", "y", 1)] * 3, "lang string, source string, text string, TEXT string, term int")
    assert got(audit(cased)) == plain_audit([("en", "a", "x x")] * 3)


def test_counts_beyond_a_long_product_are_exact(spark):
    big = 5 * 10 ** 12
    df = spark.createDataFrame([(big, 7 * 10 ** 12)], "n long, total long")
    assert df.select(divergence._probability("n", "total").alias("p")).first().p == 1 + 10 ** 9 * (big + 1) // (7 * 10 ** 12)
