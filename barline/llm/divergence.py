"""Source divergence audit by one-hot level products.

Each language keeps the terms that stand in LEAST_DOCS of its documents. A source gives a
term the price p = 1 + floor(SCALE * (count + 1) / (N + V)), which depends on the term by its
count alone. So a block of terms becomes a matrix of indicator columns, one for each
(source, count level), and its transpose times itself holds the joint table of levels of
every two sources: how many terms have this count in the one and that count in the other.
A joint table's cells, priced once each and weighed by these numbers, give the divergence
of two sources. Sums of ones are below 2 ** 24, which float32 holds exactly.

Terms are sorted by their count in the language, so that a block has few levels; a block
with too many is halved. Blocks are rows, dealt out by range, so no language or source is
one task; a task returns one sum for each pair of sources, and each source's TOP terms.

Texts are counted where they are read and what was counted is added up by (lang, source,
term). All arithmetic is in whole numbers. A task holds a square of a language's sources,
of which there is one row each in the result; it is made for some thousands at most.

Defined results: null text, lang or source is ''; repeated rows count each; a language
without kept terms has pairs of value 0; a language's only source has no pair; an empty
table gives no row. Only text, lang and source are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.words import LOWER

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: Different (source, term) that a task counts before it hands them on, and bytes of text cut at once.
HELD_TERMS = 1 << 18
CHUNK = 1 << 22
#: Terms of a block, columns above which it is halved, and columns of one product.
BLOCK_TERMS = 1024
COLUMNS = 512
TILE_COLUMNS = 1024
#: Rows of the table of groups for each language, so that no language's blocks meet in one task.
SALTS = 16

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^a-z\x80-\xff]")


def occurrences(text: str) -> Counter[bytes]:
    """How often each term stands in a text, A-Z lowered."""
    raw = text.encode("utf-8", "surrogatepass").translate(LOWER)
    out: Counter[bytes] = Counter()
    at = 0
    while at < len(raw):
        cut = _BETWEEN.search(raw, at + CHUNK)
        end = cut.start() if cut else len(raw)
        out.update(_TERM.findall(raw, at, end))
        at = end
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs of what is read, added up as far as memory allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for lo in range(0, len(terms), 1 << 16):
                some = terms[lo : lo + (1 << 16)]
                cols = [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.string()), pa.array([n[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "docs"])
        held.clear()

    for b in batches:
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            if not text:
                continue
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, found = len(n), occurrences(text)
            n.update(found)
            docs.update(found.keys())
            size += len(n) - before
            if size > HELD_TERMS:
                yield from out()
                size = 0
    yield from out()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of terms of one language as one row each: terms, how many sources hold each, these sources and counts."""
    salt = TaskContext.get().partitionId() % SALTS
    lang, part = None, []

    def out() -> pa.RecordBatch:
        held = [h for _, hs in part for h in hs]
        cols = [[lang], [salt], [[t for t, _ in part]], [[len(hs) for _, hs in part]], [[h["source"] for h in held]], [[h["n"] for h in held]]]
        kinds = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["lang", "salt", "terms", "sizes", "sources", "counts"])

    for b in batches:
        for own, term, held in zip(*(b.column(c).to_pylist() for c in ("lang", "term", "held")), strict=True):
            if part and (own != lang or len(part) == BLOCK_TERMS):
                yield out()
                part = []
            lang = own
            part.append((term, held))
    if part:
        yield out()


def prices(counts: list[int], total: int, terms: int) -> np.ndarray:
    """p of each count in a group of ``total`` occurrences; whole numbers of any size go in, p is below 2 ** 31."""
    return np.array([1 + SCALE * (c + 1) // (total + terms) for c in counts], np.int64)


def level_products(counts: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
    """(source, source) sums over the rows of ``counts`` (term, source) of floor((p - q) ** 2 / q)."""
    rows, groups = counts.shape
    levels, codes = zip(*(np.unique(counts[:, g], return_inverse=True) for g in range(groups)), strict=True)
    edges = np.cumsum([0, *map(len, levels)])
    if edges[-1] > max(COLUMNS, 4 * groups) and rows > 1:
        return level_products(counts[: rows // 2], totals, terms) + level_products(counts[rows // 2 :], totals, terms)
    hot = np.zeros((rows, edges[-1]), np.float32)
    for g in range(groups):
        hot[np.arange(rows), edges[g] + codes[g]] = 1
    price = np.concatenate([prices(x.tolist(), n, terms) for x, n in zip(levels, totals, strict=True)])
    tiles, lo = [], 0
    while lo < groups:  # whole groups, so that a joint table is within one product
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + TILE_COLUMNS, "right")) - 1)
        tiles.append((lo, hi))
        lo = hi
    out = np.zeros((groups, groups), np.int64)
    for a, b in tiles:
        p, left = price[edges[a] : edges[b], None], hot[:, edges[a] : edges[b]].T
        for c, d in tiles:
            q = price[None, edges[c] : edges[d]]
            joint = (left @ hot[:, edges[c] : edges[d]]).astype(np.int64)
            cells = joint * ((p - q) ** 2 // q)
            out[a:b, c:d] = np.add.reduceat(np.add.reduceat(cells, edges[a:b] - edges[a], axis=0), edges[c:d] - edges[c], axis=1)
    return out


class _Audit:
    """One language's sums of pairs and best terms, over the blocks of a task."""

    def __init__(self, groups: list[dict], terms: int):
        self.sources, self.totals, self.terms = [g["source"] for g in groups], [g["n"] for g in groups], terms
        self.place = {s: i for i, s in enumerate(self.sources)}
        self.total = sum(self.totals)
        self.pairs = np.zeros((len(groups), len(groups)), np.int64)
        self.best: list[list[tuple[int, str]]] = [[] for _ in groups]
        self.least = np.zeros(len(groups), np.int64)  # of a value that can still be among the best

    def add(self, terms: list[str], sizes: list[int], sources: list[str], counts: list[int]) -> None:
        table = np.zeros((len(terms), len(self.sources)), np.int64)
        table[np.repeat(np.arange(len(terms)), sizes), [self.place[s] for s in sources]] = counts
        self.pairs += level_products(table, self.totals, self.terms)
        whole, code = np.unique(table.sum(axis=1), return_inverse=True)
        q = prices(whole.tolist(), self.total, self.terms)[code]
        for g, n in enumerate(self.totals):
            at = np.flatnonzero(table[:, g])
            level, code = np.unique(table[at, g], return_inverse=True)
            p = prices(level.tolist(), n, self.terms)[code]
            value = (p - q[at]) ** 2 // q[at]
            for i in np.flatnonzero((p > q[at]) & (value >= self.least[g])).tolist():
                self.best[g].append((-int(value[i]), terms[at[i]]))
            if len(self.best[g]) > 4 * TOP:
                self.best[g] = nsmallest(TOP, self.best[g])
                self.least[g] = -self.best[g][-1][0]

    def rows(self, lang: str) -> Iterator[tuple[str, str, str, str, int]]:
        for i, j in zip(*(x.tolist() for x in np.nonzero(self.pairs)), strict=True):
            if i != j:
                yield lang, self.sources[i], "pair", self.sources[j], int(self.pairs[i, j])
        for s, best in zip(self.sources, self.best, strict=True):
            for value, term in nsmallest(TOP, best):
                yield lang, s, "term", term, -value


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audits: dict[str, _Audit] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, audit in audits.items():
            rows = list(audit.rows(lang))
            for lo in range(0, len(rows), 1 << 16):
                some = list(zip(*rows[lo : lo + (1 << 16)], strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in some[:4]), pa.array(some[4], pa.int64())], ["lang", "source", "part", "item", "value"])
        audits.clear()

    for b in batches:
        for i in range(b.num_rows):
            row = {c: b.column(c)[i].as_py() for c in ("lang", "terms", "sizes", "sources", "counts")}
            lang = row.pop("lang")
            if lang not in audits:
                if len(audits) >= 8:
                    yield from out()
                audits[lang] = _Audit(b.column("groups")[i].as_py(), b.column("kept")[i].as_py())
            audits[lang].add(**row)
    yield from out()


def audited(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    common.prepare(docs.sparkSession)
    if top > TOP:
        raise ValueError(f"terms are ranked up to {TOP}")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held"))  # one for each source
    kept = common.stored(kept.where(F.col("docs") >= least_docs).select("lang", "term", "total", "held"))

    sums = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("n"))
    groups = common.stored(rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")))
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups")).join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang")
    langs = langs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    ordered = kept.repartitionByRange("lang", "total", "term").sortWithinPartitions("lang", "total", "term")
    blocks = ordered.select("lang", "term", "held").mapInArrow(_blocks, "lang string, salt int, terms array<string>, sizes array<int>, sources array<string>, counts array<long>")
    found = common.stored(blocks.join(langs, ["lang", "salt"]).mapInArrow(_audited, "lang string, source string, part string, item string, value long"))

    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(first))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def query(spark, sf_dir: str) -> DataFrame:
    return audited(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM x GROUP BY ALL),
p AS (SELECT x.lang, x.source, x.term, x.n, 1 + 1000000000::HUGEINT * (x.n + 1) // (s.total + v.v) AS p FROM x JOIN s USING (lang, source) JOIN v USING (lang)),
q AS (SELECT k.lang, k.term, 1 + 1000000000::HUGEINT * (k.n + 1) // (v.total + v.v) AS q FROM k JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 200
"""
