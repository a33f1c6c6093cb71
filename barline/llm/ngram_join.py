"""N-gram Jaccard join: prefix-tree join of globally ordered n-gram sets.

A text's set are its distinct runs of ``width`` words, as 64-bit hashes. One global order
holds for all sets: frequent n-grams first, by a table of counts over all texts (of a
fixed number of cells, so its size is bounded; a cell stands for all hashes that it
holds), and by hash where counts are alike. Any fixed order gives right results; this one
puts common lines first and what tells texts apart last.

Two sets that link overlap so much that they share one of their last n-grams, of which
each set is entered under as many as its size demands; the lesser one under fewer still.
Common lines are seldom among them, so texts that merely share a passage do not meet.

Sets that meet are compared in rounds. First each with the least set met under the key:
those of one leader are stored in a prefix tree (sorted, each set entered at the depth
where it leaves its forerunner; frequent n-grams stand first, so near copies share long
paths) that the leader's set traverses, sharing the overlap counted on common paths, and
leaving a subtree as soon as what remains on both sides can no longer reach the threshold
for any length. Then, where sets that met are still of different components, those whose
parity bits allow a link: a few nearest ones of each set first, then more, until none is
left. A pair within a component needs no comparison, so a group of thousands of near
copies costs a few comparisons each, yet no link between components is lost.

Wide lists: where more than WIDE sets met under a key and did not all link, they are met
anew by what tells them from one of them, the reference. Two sets that link, but not both
with the reference, differ from it in much the same n-grams, so they share one of the
rarest of these, of which each set is entered under about half. Copies that were altered
each in its own way then no longer meet, though what they have in common is the same.

Hot keys: a key that the table of counts shows to be frequent is gathered in several
parts, and sets that met are screened in pairs of blocks of BLOCK sets, so no task holds a
group. Neither pairs within a component nor pairs whose parities rule out a link leave the
task.

Defined results: equal sets are one class and link; null and empty texts, and texts of
white space, have an empty set and link with nothing; shorter texts than a run count
as one run; repeated rows stay, in one component; rows with a null id link like others,
but give a component no id: it is null where no row has one; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.components import components
from barline.llm.words import LOWER, hashed, mix, runs

#: Sets that one task compares with one leader.
PART = 512

#: Words of 64 bits in a set's parities.
ODD_WORDS = 8
_ODD = [f"odd{k}" for k in range(ODD_WORDS)]

#: The table of counts has 2 ** CELL_BITS cells, in chunks of CHUNK.
CELL_BITS = 22
CHUNK = 1 << 16
FAN = 256
#: A key of more entries, about, is gathered in parts.
KEY_ROWS = 1 << 17
#: Sets of a block, and how many of the nearest ones in another block are compared in each round.
BLOCK = 1024
#: Nearest sets that are compared first, and times as many in each further round.
FIRST, MORE = 8, 8
#: Lists of more sets are met anew, and sets from which their reference is chosen, about.
WIDE, SAMPLE = BLOCK, 128
#: Rows that a task screens, as a mean.
SCREEN_ROWS = 20_000
#: Bytes of text that are hashed at once.
CHUNK_BYTES = 1 << 20
#: Bits of the filter of wanted rows.
FILTER_BITS = 24


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Each text's set, sorted."""
    out: list[np.ndarray] = []
    part, held = [], 0
    for t in [*texts, None]:
        if part and (t is None or held + len(t) > CHUNK_BYTES):
            h, first = hashed(part)
            r = runs(h, width)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if b - a >= width:
                    out.append(np.unique(r[a : b - width + 1]))
                else:
                    out.append(runs(h[a:b], b - a) if b > a else np.zeros(0, np.uint64))
            part, held = [], 0
        if t is not None:
            part.append(t)
            held += len(t)
    return out


def packed_counts(counts: np.ndarray) -> list[tuple[int, bytes]]:
    """(chunk, compressed counts) of cells: all lowest bytes, then the next ones."""
    out = []
    for k in range(0, len(counts), CHUNK):
        part = counts[k : k + CHUNK]
        if part.any():
            out.append((k // CHUNK, zlib.compress(np.minimum(part, (1 << 32) - 1).astype("<u4").view(np.uint8).reshape(CHUNK, 4).T.tobytes(), 1)))
    return out


def unpacked_counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, CHUNK).T.copy().view("<u4").ravel().astype(np.int64)


def level_table(parts: DataFrame, fan: int = FAN) -> np.ndarray:
    """Level of each cell, from (chunk, counts) of all tasks: eight times the binary logarithm of its count.

    ``fan`` rows of a chunk are added at once, about; the driver gets one row a chunk.
    """

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for raw in t.column("counts").to_pylist():
            total += unpacked_counts(raw)
        return pa.table({"chunk": t.column("chunk")[:1], "counts": pa.array([v for _, v in packed_counts(total)], pa.binary())})

    many = parts.groupBy("chunk").count().agg(F.max("count")).first()[0] or 0
    while many > fan:
        groups = -(-many // fan)
        parts = parts.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(groups))).groupBy("chunk", "part")
        parts, many = common.stored(parts.applyInArrow(add, "chunk int, counts binary")), groups
    out = np.zeros(1 << CELL_BITS, np.uint8)
    for r in parts.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect():
        level = np.minimum(8 * np.log2(np.maximum(unpacked_counts(r["counts"]), 1)), 255)
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = level.astype(np.uint8)
    return out


def cells_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def ordered(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set in the global order, as numbers that ascend: the level, frequent first, then 56 bits of the hash."""
    return np.sort((np.uint64(255) - levels[cells_of(s)]) << np.uint64(56) | s >> np.uint64(8))


def parts_of(key: np.ndarray, key_rows: int) -> np.ndarray:
    """In how many parts a key's entries are gathered, by its level."""
    return (2.0 ** ((np.uint64(255) - (key >> np.uint64(56))).astype(np.int64) / 8) / key_rows).astype(np.int64) + 1


def prefixes(n: int, num: int, den: int) -> tuple[int, int]:
    """How many of its last elements a set of ``n`` is entered under, and how many of these count if it is the lesser of two."""
    return n - -(-n * num // den) + 1, n - -(-2 * n * num // (num + den)) + 1


def class_of(s: np.ndarray) -> int | None:
    """A number that equal sets share; none for the empty set."""
    return int(mix(mix(s).sum(keepdims=True, dtype=np.uint64) ^ np.uint64(len(s))).view(np.int64)[0]) if len(s) else None


def parities(s: np.ndarray) -> np.ndarray:
    """For each of 64 * ODD_WORDS cells of the hashes, whether it holds an odd number of elements."""
    bits = 64 * ODD_WORDS
    cell = mix(s + np.uint64(1)) % np.uint64(bits)
    return np.packbits(np.bincount(cell.astype(np.int64), minlength=bits).astype(np.uint8) & 1).view(np.int64)


def fine_parities(s: np.ndarray) -> bytes:
    """The same for a power of two of cells, as many as elements at least: a small part of the set's bytes."""
    bits = 1 << max(9, (len(s) - 1).bit_length())
    cell = mix(s + np.uint64(1)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(cell.astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Cells in which two sets' fine parities differ; those of more cells are folded onto as many as the other's."""
    x, y = (np.frombuffer(v, np.uint64) for v in (a, b))
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def traverse(leader: np.ndarray, members: list[np.ndarray], num: int, den: int) -> list[int]:
    """Places of the members that link with the leader; ``members`` is sorted as sequences."""
    m, hit = len(leader), []
    before, left = np.zeros(0, np.uint64), 1 << 62  # the path walked and the depth at which it was left
    count, ahead = np.zeros(1, np.int64), np.array([m])
    for k, s in enumerate(members):
        n = len(s)
        shared = min(n, len(before))
        differ = np.flatnonzero(s[:shared] != before[:shared])
        depth = int(differ[0]) if len(differ) else shared
        if depth >= left:
            continue
        at = np.searchsorted(leader, s[depth:])
        found = (at < m) & (leader[np.minimum(at, m - 1)] == s[depth:])
        count = np.concatenate([count[: depth + 1], count[depth] + np.cumsum(found)])
        ahead = np.concatenate([ahead[: depth + 1], m - at - found])
        # the best that any set below a place can reach has as many more as the leader has
        lost = np.flatnonzero((count + ahead) * (num + den) < num * (np.arange(n + 1) + ahead + m))
        before, left = s, int(lost[0]) if len(lost) else 1 << 62
        if not len(lost) and den * count[n] >= num * (n + m - count[n]):
            hit.append(k)
    return hit


def _thinned(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose fine parities allow a link; none that links is left out."""
    side = lambda x: sets.select(F.col("c").alias(x), F.col("n").alias("n_" + x), F.col("fine").alias("fine_" + x)).hint("merge")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            cols = (t.column(x).to_pylist() for x in ("fine_a", "fine_b", "n_a", "n_b"))
            keep = [differing(a, b) * (num + den) <= (m + n) * (den - num) for a, b, m, n in zip(*cols, strict=True)]
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return common.stored(pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(near, "a long, b long"))


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    salted = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    members = salted.join(sets.select(F.col("c").alias("b"), "s"), "b")
    leaders = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(sets.select(F.col("c").alias("a"), F.col("s").alias("leader")), "a")
    leaders = leaders.toDF("head", "cell", "leader")

    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            raw = sorted(zip(right.column("s").to_pylist(), right.column("b").to_pylist(), strict=True))
            leader = np.frombuffer(left.column("leader")[0].as_py(), ">u8").astype(np.uint64)
            b = [raw[k][1] for k in traverse(leader, [np.frombuffer(s, ">u8").astype(np.uint64) for s, _ in raw], num, den)]
            a = [left.column("head")[0].as_py()] * len(b)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return leaders.groupBy("head", "cell").cogroup(members.groupBy("a", "part")).applyInArrow(links, "a long, b long")


def reference(sets: list[np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    """Place of the set nearest to what most of ``sets`` hold; in what several of them differ from it, and how many."""
    e, many = np.unique(np.concatenate(sets), return_counts=True)
    most = e[2 * many > len(sets)]
    at = int(np.argmin([len(np.setxor1d(s, most, assume_unique=True)) for s in sets]))
    e, many = np.unique(np.concatenate([np.setxor1d(s, sets[at], assume_unique=True) for s in sets]), return_counts=True)
    return at, e[many > 1], many[many > 1]


def apart(s: np.ndarray, ref: np.ndarray, often: np.ndarray, many: np.ndarray, num: int, den: int) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether a set links with the reference, and in what it differs, rarest first: as much as one must share with sets that do not, and with any.

    Let sets of n and m elements differ from the reference, of r, in d and e. If they link, they differ from each other in at most
    (n + m) * t, t = (den - num) / (num + den), so d and e share (d + e - (n + m) * t) / 2 at least. As e is more than
    (m + r) * t where the other does not link with the reference, that is more than (d + (r - n) * t) / 2. For any other set,
    it is d - (n + m) * t at least, for e is no less than that, and m is n * den / num at most.
    """
    d = np.setxor1d(s, ref, assume_unique=True)
    n, r, k = len(s), len(ref), len(d)
    at = np.minimum(np.searchsorted(often, d), max(len(often) - 1, 0))
    d = d[np.lexsort((~d, np.where(often[at] == d, many[at], 0) if len(often) else np.zeros(k)))]
    links = k * (num + den) <= (n + r) * (den - num)
    wide = k + 1 - max(1, k - n * (den - num) // num)
    near = min(wide, k - (k * (num + den) + (r - n) * (den - num)) // (2 * (num + den)))
    return links, d[: max(near, 0)], d[:wide]


#: A class ``b`` entered under a key, with its size, below nothing if the entry counts for it as the lesser set.
ENTRY = np.dtype([("key", "<u8"), ("b", "<i8"), ("n", "<i4")])


def dealt(x: np.ndarray, bucket: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """(bucket, packed entries); columns one after another, which compresses better."""
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(edge)).tolist()
    return [(k, b"".join(x[f][order[edge[k] : edge[k + 1]]].tobytes() for f in ENTRY.names)) for k in full]


def unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // ENTRY.itemsize
    out, at = np.zeros(n, ENTRY), 0
    for f in ENTRY.names:
        out[f] = np.frombuffer(raw, ENTRY[f], n, at)
        at += n * ENTRY[f].itemsize
    return out


def met(x: np.ndarray, num: int, den: int, key_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """list, class, leader, hot of the entries of a bucket whose key may bring sets together.

    A leader is the least set that is not too small for the others. A key's classes are
    parted where sizes leave a gap; the same classes make one list. What is hot is part of a key's list, which is named by the key.
    """
    x = x[np.lexsort((x["b"], np.abs(x["n"]), x["key"]))]
    copy = (x["key"][1:] == x["key"][:-1]) & (x["b"][1:] == x["b"][:-1])  # one class from several batches
    x = x[np.append(True, ~copy)[: len(x)]]
    opens = np.flatnonzero(np.append(True, x["key"][1:] != x["key"][:-1])[: len(x)])
    if not len(opens):
        return x["b"], x["b"], x["b"], np.zeros(0, bool)
    many = np.diff(opens, append=len(x))
    hot = parts_of(x["key"][opens], key_rows) > 1
    size = np.abs(x["n"]).astype(np.int64)
    # no pair reaches over a gap between sizes, unless other parts of a hot key fill it
    whole = np.repeat(hot, many)
    gap = np.append(True, (size[1:] * num > size[:-1] * den) & ~whole[1:])[: len(x)]
    gap[opens] = True
    opens = np.flatnonzero(gap)
    many, hot = np.diff(opens, append=len(x)), whole[opens]
    listed = np.where(hot, x["key"][opens], mix(np.add.reduceat(mix(x["b"].astype(np.uint64)), opens) + many.astype(np.uint64)))
    use = hot | (many > 1) & np.logical_or.reduceat(x["n"] < 0, opens)
    use[use] = np.isin(np.arange(use.sum()), np.unique(listed[use], return_index=True)[1]) | hot[use]
    lead = np.repeat(x["b"][opens], many)
    wide = use & (size[opens] * den < size[opens + many - 1] * num)
    for a, n in zip(opens[wide].tolist(), many[wide].tolist()):
        at = a
        while at < a + n:
            end = a + int(np.searchsorted(size[a : a + n] * num, size[at] * den, "right"))
            lead[at:end] = x["b"][at]
            at = end
    keep = np.repeat(use, many)
    return np.repeat(listed, many)[keep].view(np.int64), x["b"][keep], lead[keep], np.repeat(hot, many)[keep]


def survivors(a: dict[str, np.ndarray], b: dict[str, np.ndarray], lo: int, hi: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Classes (of a, of b) of different components that may link by their parities, the ``lo``-th to ``hi``-th nearest of each; and whether there are more."""
    differ = np.zeros((len(a["n"]), len(b["n"])), np.int64)
    for k in range(a["odd"].shape[1]):
        differ += np.bitwise_count(a["odd"][:, k, None] ^ b["odd"][None, :, k])
    n, m = a["n"][:, None], b["n"][None]
    may = (differ * (num + den) <= (n + m) * (den - num)) & (np.minimum(n, m) * den >= np.maximum(n, m) * num) & (a["c"][:, None] != b["c"][None])
    apart = may & (a["k"][:, None] != b["k"][None])
    most = int(may.sum(axis=1).max()) if apart.any() else 0
    if most <= lo:
        return a["c"][:0], b["c"][:0], False
    rank = np.zeros(may.shape, np.int64)
    if lo or most > hi:
        order = np.argsort(np.where(may, differ, 1 << 40), axis=1, kind="stable")
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape).copy(), axis=1)
    i, j = np.nonzero(apart & (rank >= lo) & (rank < hi))
    return a["c"][i], b["c"][j], bool((apart & (rank >= hi)).any())


def _blocked(rest: DataFrame) -> DataFrame:
    """``rest`` (list, c, k, ...) in pairs of blocks lo, hi with side 0 or 1, for each pair that can hold different components.

    A block has BLOCK rows, about: of one component if that alone fills blocks, else of several.
    """
    size = rest.groupBy("list", "k").agg(F.count("*").alias("many"))
    small = size.groupBy("list").agg(F.sum(F.when(F.col("many") <= BLOCK, F.col("many")).otherwise(0)).alias("small"))
    large = F.col("many") > BLOCK
    number = F.when(large, F.pmod(F.xxhash64("c"), F.ceil(F.col("many") / BLOCK))).otherwise(F.pmod(F.xxhash64("k"), F.ceil(F.greatest("small", F.lit(1)) / BLOCK)))
    rows = rest.join(size, ["list", "k"]).join(small, "list").withColumn("pure", F.when(large, F.col("k")))
    rows = common.stored(rows.withColumn("block", F.xxhash64("pure", number.cast("long"))).drop("many", "small"))
    blocks = rows.select("list", "block", "pure").distinct()
    other = blocks.select("list", F.col("block").alias("hi"), F.col("pure").alias("other"))
    pairs = blocks.withColumnRenamed("block", "lo").join(other, "list").where("lo < hi or lo = hi and pure is null").where("not pure <=> other or pure is null").select("list", "lo", "hi")
    pairs = common.stored(pairs)
    side = lambda x, n: rows.drop("pure").withColumnRenamed("block", x).join(pairs, ["list", x]).select("list", "lo", "hi", F.lit(n).alias("side"), "c", "n", *_ODD)
    return common.stored(side("lo", 0).unionByName(side("hi", 1).where("lo <> hi")))


def _screened(held: DataFrame, placed: DataFrame, tasks: int, lo: int, hi: int, num: int, den: int) -> DataFrame:
    """a, b of the blocks' pairs that may link; list, lo, hi of the pairs of blocks that have more."""

    def screen(t: pa.Table) -> pa.Table:
        x = {f: t.column(f).to_numpy() for f in ("list", "lo", "hi", "side", "c", "n", "k")}
        x["odd"] = np.stack([t.column(f).to_numpy() for f in _ODD], axis=1).view(np.uint64)
        order = np.lexsort((x["c"], x["side"], x["hi"], x["lo"], x["list"]))
        x = {f: v[order] for f, v in x.items()}
        opens = np.flatnonzero(np.concatenate([[True], (x["list"][1:] != x["list"][:-1]) | (x["lo"][1:] != x["lo"][:-1]) | (x["hi"][1:] != x["hi"][:-1])]))
        us, vs, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for s, e in zip(opens.tolist(), [*opens[1:].tolist(), len(order)], strict=True):
            cut = s + int(np.searchsorted(x["side"][s:e], 1)) if x["lo"][s] != x["hi"][s] else e
            if (x["k"][s:e] == x["k"][s]).all():
                continue
            a = {f: v[s:cut] for f, v in x.items()}
            b = a if cut == e else {f: v[cut:e] for f, v in x.items()}
            for p, q in ((a, b), (b, a)) if cut < e else ((a, b),):
                u, v, again = survivors(p, q, lo, hi, num, den)
                us.append(u)
                vs.append(v)
                if again and more[-1:] != [s]:
                    more.append(s)
        u, v = np.concatenate(us), np.concatenate(vs)
        u, v = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
        cols = {f: pa.array(col, pa.int64()) for f, col in (("a", u), ("b", v))} | {f: pa.nulls(len(u), pa.int64()) for f in ("list", "lo", "hi")}
        again = {f: pa.nulls(len(more), pa.int64()) for f in ("a", "b")} | {f: pa.array(x[f][more], pa.int64()) for f in ("list", "lo", "hi")}
        return pa.concat_tables([pa.table(cols), pa.table(again)])

    at = F.pmod(F.xxhash64("list", "lo", "hi"), F.lit(tasks)).alias("task")
    return held.join(placed.select("c", "k"), "c").select(at, "*").groupBy("task").applyInArrow(screen, "a long, b long, list long, lo long, hi long").distinct()


def linked(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", key_rows: int = KEY_ROWS) -> DataFrame:
    """doc_id, row, n_shingles, component_id, first_row: one row per row of ``docs``.

    ``percent`` is the least similarity; ``row`` is a hash of id and text, and ``first_row``
    that of the row of the component's least id.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    num, den = percent, 100
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))

    def texts(b: pa.RecordBatch) -> list[bytes]:
        return [(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in b.column("text").to_pylist()]

    fields = {"doc_id": pa.int64(), "row": pa.int64(), "n": pa.int64(), "c": pa.int64(), **dict.fromkeys(_ODD, pa.int64()), "fine": pa.binary(), "chunk": pa.int32(), "counts": pa.binary()}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(**given) -> pa.RecordBatch:
            n = len(next(iter(given.values())))
            return pa.RecordBatch.from_arrays([given.get(f, pa.nulls(n, t)) for f, t in fields.items()], list(fields))

        total = np.zeros(1 << CELL_BITS, np.uint32)
        held, size = [np.zeros(0, np.int64)], 0

        def count() -> None:
            nonlocal held, size
            cell, many = np.unique(np.concatenate(held), return_counts=True)
            total[cell] += many.astype(np.uint32)
            held, size = [np.zeros(0, np.int64)], 0

        for b in batches:
            found = shingle_sets(texts(b), width)
            held += map(cells_of, found)
            size += sum(map(len, found))
            if size > 1 << 18:
                count()
            odd = np.stack([parities(s) for s in found]) if found else np.zeros((0, ODD_WORDS), np.int64)
            yield rows(doc_id=b.column("doc_id"), row=b.column("row"), n=pa.array([len(s) for s in found], pa.int64()), c=pa.array(map(class_of, found), pa.int64()), fine=pa.array(map(fine_parities, found), pa.binary()), **{f: pa.array(odd[:, k]) for k, f in enumerate(_ODD)})
        count()
        parts = packed_counts(total)
        yield rows(chunk=pa.array([k for k, _ in parts], pa.int32()), counts=pa.array([v for _, v in parts], pa.binary()))

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    read = common.stored(docs.mapInArrow(common.released(features), ", ".join(f"{f} {kinds[t]}" for f, t in fields.items())))
    feats = read.where("n is not null").drop("chunk", "counts")
    levels = level_table(read.where("chunk is not null").select("chunk", "counts"))
    by_id = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = common.stored(feats.where("c is not null").groupBy("c").agg(F.min(by_id).alias("id"), F.first(F.struct("n", *_ODD, "fine")).alias("of")).select("c", "id.doc_id", "id.row", "of.*"))
    buckets = common.buckets(spark, classes.count())

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = {class_of(s): s for s in shingle_sets(texts(b), width) if len(s)}
            keys, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
            for s in sets.values():
                many, few = prefixes(len(s), num, den)
                keys.append(ordered(s, levels)[len(s) - many :])
                sizes.append(np.full(many, len(s), np.int32))
                sizes[-1][many - few :] *= -1
            yield packed(keys, sizes, np.repeat(np.array(list(sets), np.int64), list(map(len, keys[1:]))))

    def packed(keys: list[np.ndarray], sizes: list[np.ndarray], b: np.ndarray) -> pa.RecordBatch:
        x = np.zeros(len(b), ENTRY)
        x["key"], x["n"], x["b"] = np.concatenate(keys), np.concatenate(sizes), b
        part = mix(x["b"].astype(np.uint64)) % parts_of(x["key"], key_rows).astype(np.uint64)
        rows = dealt(x, mix(mix(x["key"]) + part) % np.uint64(buckets), buckets)
        cols = zip(*rows, strict=True) if rows else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary()), strict=True)], ["bucket", "data"])

    def meet(t: pa.Table) -> pa.Table:
        cols = met(np.concatenate([np.zeros(0, ENTRY), *map(unpacked, t.column("data").to_pylist())]), num, den, key_rows)
        return pa.table([pa.array(c) for c in cols], ["list", "c", "lead", "hot"])

    entered = docs.select("text").mapInArrow(common.released(entries), "bucket int, data binary")
    shared = common.stored(entered.groupBy("bucket").applyInArrow(meet, "list long, c long, lead long, hot boolean").distinct())
    members = shared.select("list", "c").distinct()
    sides = common.stored(shared.select("c").distinct().join(classes, "c"))
    sides_of = lambda mark: sides.select(*(F.col(x).alias(mark + x) for x in ("n", "c", *_ODD)))
    differ = sum((F.bit_count(F.col("a_" + x).bitwiseXOR(F.col("b_" + x))) for x in _ODD), F.lit(0))
    # parities differ at most as often as the sets do
    close = (differ * (num + den) <= (F.col("a_n") + F.col("b_n")) * (den - num)) & (F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num)

    def sets_for(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        """c, s: the sets of the classes of ``pairs``, in global order, besides those known."""
        named = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
        named = named if known is None else named.join(known.select("c"), "c", "left_anti")
        wanted = common.stored(named.join(classes.select("c", "row"), "c"))
        passes = _row_filter(wanted)

        def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(pa.array(passes(b.column("row").to_numpy())))
                found = shingle_sets(texts(b), width)
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(map(class_of, found), pa.int64()), pa.array([ordered(s, levels).astype(">u8").tobytes() for s in found], pa.binary())], ["row", "c", "s"])

        # one row of each class
        some = docs.mapInArrow(common.released(sets_of), "row long, c long, s binary").join(wanted.hint("merge"), ["row", "c"], "left_semi")
        some = common.stored(some.groupBy("c").agg(F.first("s").alias("s")))
        return some if known is None else known.unionByName(some)

    hot = shared.where("hot").select("list", "lead").distinct()
    hot = hot.join(hot.groupBy("list").agg(F.min("lead").alias("to")), "list").select(F.col("to").alias("a_c"), F.col("lead").alias("b_c"))
    tried = shared.select(F.col("lead").alias("a_c"), F.col("c").alias("b_c")).union(hot).where("a_c <> b_c").distinct()
    tried = common.stored(tried.join(sides_of("b_"), "b_c").join(sides_of("a_"), "a_c").where(close).select(F.col("a_c").alias("a"), F.col("b_c").alias("b")))
    thin = _thinned(tried, sides, num, den)
    sets = sets_for(thin, None)
    links = common.stored(_verified(thin, sets, num, den))
    comp = components(links, "a", "b")

    def placed() -> DataFrame:
        return sides.join(comp.withColumnRenamed("id", "c"), "c", "left").withColumn("k", F.coalesce("component", "c"))

    def again(left: pa.Table, right: pa.Table) -> pa.Table:
        """The entries of sets under what tells them from the reference, and their links with it."""
        fields = {"a": pa.int64(), "b": pa.int64(), "bucket": pa.int32(), "data": pa.binary()}
        if not left.num_rows or not right.num_rows:
            return pa.table({f: pa.nulls(0, t) for f, t in fields.items()})
        pool, _, to, pool_rows, ref, often, times = (left.column(x)[0].as_py() for x in left.column_names)
        ref, often, times = (np.frombuffer(x, "<u8") for x in (ref, often, times))
        salt = mix(np.array([pool, pool + 1], np.int64).view(np.uint64))
        level = np.uint64(255 - min(255, int(8 * np.log2(pool_rows)))) << np.uint64(56)
        keys, sizes, b, near = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [], []

        def enter(c: int, n: int, e: np.ndarray, kind: int) -> None:
            # of what the reference holds, only the pool's rows bound how many sets lack it
            top = np.where(np.isin(e, ref), level, e & np.uint64(255 << 56))
            keys.append(top | mix(e ^ salt[kind]) >> np.uint64(8))
            sizes.append(np.full(len(e), n, np.int32))
            b.extend([c] * len(e))

        for c, raw in zip(right.column("c").to_pylist(), right.column("s").to_pylist(), strict=True):
            s = np.frombuffer(raw, ">u8").astype(np.uint64)
            links, few, all_ = apart(s, ref, often, times, num, den)
            if links:  # such sets need not meet each other
                near += [c] if c != to else []
                enter(c, -len(s), few, 1)
            else:
                enter(c, -len(s), few, 0)
                enter(c, len(s), all_, 1)
        rows = packed(keys, sizes, np.array(b, np.int64))
        found = {"a": pa.array([to] * len(near), pa.int64()), "b": pa.array(near, pa.int64())}
        entered = {"bucket": rows.column(0), "data": rows.column(1)}
        return pa.concat_tables([pa.table({f: x.get(f, pa.nulls(n, t)) for f, t in fields.items()}) for x, n in ((found, len(near)), (entered, rows.num_rows))])

    def pick(t: pa.Table) -> pa.Table:
        t = t.sort_by("c")
        found = [np.frombuffer(s, ">u8").astype(np.uint64) for s in t.column("s").to_pylist()]
        at, often, times = reference(found)
        raw = [x.astype("<u8").tobytes() for x in (found[at], often, times)]
        return pa.table({"head": t.column("pool")[:1], "to": t.column("c")[at : at + 1], "ref": [raw[0]], "often": [raw[1]], "times": [raw[2]]}).cast(pa.schema([("head", pa.int64()), ("to", pa.int64()), ("ref", pa.binary()), ("often", pa.binary()), ("times", pa.binary())]))

    before = 1 << 62
    while True:
        spread = members.join(placed().select("c", "k"), "c")
        mixed = spread.groupBy("list").agg(F.min("k").alias("k0"), F.max("k").alias("k1"), F.count("*").alias("many")).where("k0 <> k1").select("list", "many")
        mixed = common.stored(mixed)
        rows = mixed.where(F.col("many") > WIDE).agg(F.sum("many")).first()[0]
        if not rows or 2 * rows > before:  # what is left is screened in blocks
            break
        before = rows
        # lists of one large component share its reference
        wide = spread.join(mixed.where(F.col("many") > WIDE).select("list"), "list").groupBy("list", "k").count()
        wide = wide.groupBy("list").agg(F.max_by("k", F.struct("count", "k")).alias("pool"))
        pooled = common.stored(members.join(wide, "list").select("pool", "c").distinct())
        pools = common.stored(pooled.groupBy("pool").agg(F.count("*").alias("pool_rows"), F.min("c").alias("least")))
        sets = sets_for(pooled.select(F.col("c").alias("a"), F.col("c").alias("b")), sets)
        # any set can be the reference; the sample only makes it a near one
        some = pooled.join(pools, "pool").where((F.pmod(F.xxhash64("c"), F.col("pool_rows")) < SAMPLE) | (F.col("c") == F.col("least"))).select("pool", "c").join(sets, "c")
        refs = common.stored(some.select("pool", "c", "s").groupBy("pool").applyInArrow(pick, "head long, to long, ref binary, often binary, times binary"))
        parts = F.ceil(F.col("pool_rows") / PART).cast("int")
        heads = pools.select(F.col("pool").alias("head"), "pool_rows", F.explode(F.sequence(F.lit(0), parts - 1)).alias("cell")).join(refs, "head").select("head", "cell", "to", "pool_rows", "ref", "often", "times")
        dealt_out = pooled.join(pools, "pool").select("pool", "c", F.pmod(F.xxhash64("c"), parts).cast("int").alias("part")).join(sets, "c")
        found = common.stored(heads.groupBy("head", "cell").cogroup(dealt_out.groupBy("pool", "part")).applyInArrow(again, "a long, b long, bucket int, data binary"))
        links = common.stored(links.union(found.where("a is not null").select("a", "b")))
        comp = components(links, "a", "b")
        anew = found.where("a is null").select("bucket", "data").groupBy("bucket").applyInArrow(meet, "list long, c long, lead long, hot boolean").select("list", "c")
        members = common.stored(members.join(mixed.where(F.col("many") <= WIDE).select("list"), "list").select("list", "c").union(anew).distinct())
    mixed = mixed.select("list")
    lo, hi = 0, 0 if mixed.isEmpty() else FIRST
    if hi:
        held = _blocked(members.join(mixed, "list").join(placed().select("c", "k", "n", *_ODD), "c"))
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), held.count() // SCREEN_ROWS)
    while hi:
        found = common.stored(_screened(held, placed(), tasks, lo, hi, num, den))
        new = found.where("a is not null").select("a", "b").join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        new = common.stored(new)
        thin = _thinned(new, sides, num, den)
        if not thin.isEmpty():
            sets = sets_for(thin, sets)
            links = common.stored(links.union(_verified(thin, sets, num, den)))
            comp = components(links, "a", "b")
        more = found.where("a is null").select("list", "lo", "hi")
        if more.isEmpty():  # in the end, as no block has more sets than a window is wide
            break
        tried, held = tried.union(new), common.stored(held.join(more, ["list", "lo", "hi"]))
        lo, hi = hi, hi * MORE

    named = classes.join(comp.withColumnRenamed("id", "c"), "c", "left").select("c", by_id.alias("id"), F.coalesce("component", "c").alias("k"))
    least = named.groupBy("k").agg(F.min("id").alias("id"))
    of_class = named.select("c", "k").join(least, "k").select("c", F.col("id.doc_id").alias("component_id"), F.col("id.row").alias("first_row"))
    out = feats.select("doc_id", "row", "n", "c").join(of_class, "c", "left")
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("first_row", "row").alias("first_row"))


def _row_filter(wanted: DataFrame):
    """A test of ``row`` that all rows of ``wanted`` pass and few others: a bit for each of 2 ** FILTER_BITS cells of the hash."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.unique(b.column("row").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            word, at = np.unique(cell >> 5, return_inverse=True)
            value = np.zeros(len(word), np.int64)
            np.bitwise_or.at(value, at, 1 << (cell & 31))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], ["word", "value"])

    # as many words as cells / 32, however many rows
    words = wanted.select("row").mapInArrow(bits, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value"))
    words = words.toPandas()
    table = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["value"].to_numpy(np.int64)

    def passes(row: np.ndarray) -> np.ndarray:
        cell = (row.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        return (table[cell >> 5] >> (cell & 31).astype(np.uint32) & 1).astype(bool)

    return passes


def joined(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", key_rows: int = KEY_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``; ``percent`` is the least similarity."""
    with common.passing(docs.sparkSession):
        return common.lasting(linked(docs, width, percent, id_col, text_col, key_rows).select("doc_id", "n_shingles", "component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return joined(common.table(spark, sf_dir, "documents"), width=3, percent=90)
