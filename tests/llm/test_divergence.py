"""The audit against a plain version of itself, and against SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from barline.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, value int, term string, salt string"


def plain(rows, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        every = Counter()
        for s in sources:
            every.update(counts[lang, s])

        def p(c, kept=kept):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // total for t in kept}

        price, q = {s: p(counts[lang, s]) for s in sources}, p(every)
        for s in sources:
            pair = [(-sum((price[s][t] - price[o][t]) ** 2 // price[o][t] for t in kept), o) for o in sources if o != s]
            term = [(-((price[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, s][t] and price[s][t] > q[t]]
            for part, got, most in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(sorted(got)[:most])]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(11)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Ünï", "日本", "don't", "A1b2", "tie", "eit", "ite"]
    rows = []
    for i in range(400):
        source = None if i % 37 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}"
        lang = None if i % 41 == 0 else ("en", "fr")[i % 7 == 0]
        text = " ".join(rng.choice(words, int(rng.integers(0, 60)), p=(w := np.arange(1, len(words) + 1)[::-1] ** 2.0) / w.sum()))
        rows.append((i, None if i % 29 == 0 else text, lang, source))
    rows += [(1000 + k, "copy Of a line", "en", "hot") for k in range(50)] + [(1000, "copy Of a line", "en", "hot")]
    rows += [(2000, "alone twice", "xx", "a"), (2001, "alone twice", "xx", "b"), (2002, "", "yy", "only"), (None, "tie eit ite \x00 🙂 x", "en", ""), (3000, "aa " * 50_000 + "Zz" * 9000, "fr", "long")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"HELD_TERMS": 50, "CHUNK": 40, "BLOCK_TERMS": 30, "COLUMNS": 24, "TILE_COLUMNS": 10}])
def test_audit_equals_the_plain_version(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(D, k, v)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(4)
    want = plain(rows)
    assert len(want) > 500 and ("xx", "a", "pair", "b", 0, 1) in want
    assert sorted(map(tuple, D.audited(df).collect())) == want
    if not sizes:
        assert D.audited(df.where("false")).count() == 0
        assert sorted(map(tuple, D.audited(df, top=3).collect())) == plain(rows, 3)


def test_level_products_in_whole_numbers(monkeypatch):
    monkeypatch.setattr(D, "COLUMNS", 8)
    big = 10**13  # occurrences whose product with the scale is no 64-bit number
    counts = np.array([[big, 0, 7], [3, big, 0], [big, 5, 1]])
    totals = counts.sum(axis=0).tolist()
    price = [[1 + D.SCALE * (int(c) + 1) // (n + 3) for c, n in zip(row, totals, strict=True)] for row in counts]
    want = [[sum((r[a] - r[b]) ** 2 // r[b] for r in price) for b in range(3)] for a in range(3)]
    assert D.level_products(counts, totals, 3).tolist() == want


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(D.SQL).fetchall())
    assert len(want) > 1000 and sorted(map(tuple, D.query(spark, sf).collect())) == want
