"""Rows without an id, repeated rows, ids with several texts, very long and empty texts, clashing columns: for each operator."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barline.llm import ann, mixing, ngram_join, packing, rans, sharding, substring_dedup, toxicity

RUN = " ".join(f"run{i}" for i in range(25))
ROWS = [
    (None, f"no id at all {RUN}"), (None, f"no id at all {RUN}"), (None, "another without an id"), (7, f"twice {RUN} x"), (7, f"twice {RUN} x"), (7, "another text of the same id"),
    (1, None), (2, ""), (3, " \n\t "), (4, "word " * 60_000 + RUN), (5, "Tie one two three"), (6, "tie ONE two three"), (8, "ümläut " * 30 + "日本語 🙂"), (9, "a"), (10, "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", (None, "s", "t")[k % 3], k, "x", 1, "y", 2) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row int, size string, n int, bucket string, c int").repartition(4)


def encoded(name, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4")) for i, x in ROWS]


def test_token_output(spark, docs, tmp_path):
    path = f"file://{tmp_path}/f"
    rans.write_token_file(docs, public_tokenizers.path("word_bpe_49k.json"), path, 1)
    rows = sorted(rans.read_token_file(spark, path).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in encoded("word_bpe_49k.json", 1))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 2)) for i in (1, 4, 5, 6, 9)] + [(5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ROWS) and all(0 <= r.score <= 1 for r in got)
    assert set(toxicity.clean(docs, model).columns) == set(docs.columns)


def test_nearest_neighbours_of_unusual_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(400, [1.0, 2.0]), (450, []), (500, None), (None, [1.0] * 8), (50, [1.0] * 8), (1, [1.0] * 8)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, query_id string")
    got = defaultdict(list)
    for r in ann.nearest(df, lambda i: i % 50 == 0, ratio=100.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if i is not None and v is not None and len(v) == 8]
    assert set(got) == {0, 50, 100, 150, 200, 250}  # vectors of another length, empty and null ones take no part
    for q, v in ((i, v) for i, v in good if i % 50 == 0 and i != 50):
        want = sorted((-float(v @ w), i) for i, w in good if i != q)[:5]
        assert [i for i, _ in got[q]] == [i for _, i in want]
        np.testing.assert_allclose([x for _, x in got[q]], [-x for x, _ in want], rtol=1e-12)


def test_sharding(docs):
    got = sharding.sharded(docs, sharding.even_tree(5), sharding.grown(sharding.even_tree(5))).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ROWS)
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        shard_of[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in shard_of.values())


def test_packing(docs):
    got = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), 0).collect()
    want = encoded("byte_bpe_50k.json", 0)
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        assert [o for o, _ in sorted(s)] == np.cumsum([0, *(n for _, n in sorted(s))])[:-1].tolist() and sum(n for _, n in s) <= 1024
    due = Counter()
    for i, x in want:
        pieces = [r for r in got if r.doc_id == i and r.doc_tokens == len(x)]
        assert all(r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes()) for r in pieces if sum(len(y) == len(x) and j == i and (y != x).any() for j, y in want) == 0)
        due[i] += len(x)
    assert Counter({i: sum(r.length for r in got if r.doc_id == i) for i in due}) == due


def test_pieces_go_where_cost_is_least():
    rng = np.random.default_rng(12)
    for _ in range(20):
        lengths = rng.choice([1, 5, 100, 100, 300, 511, 700, 1023], int(rng.integers(1, 40))).tolist()
        count = -(-sum(lengths) // 1024)
        room, load, last = [1024] * count, [0.0] * count, float("inf")
        for item, start, n, s, offset in packing.place(lengths):
            left = lengths[item] - start
            fits = [k for k in range(count) if room[k] >= left]
            if fits:  # ties in cost go to the lower sequence
                assert n == left and s == min(fits, key=lambda k: (load[k], k))
            else:
                assert s == max(range(count), key=lambda k: (room[k], -k)) and n == room[s]
            if not start:
                assert packing.cost(lengths[item]) <= last  # descending
                last = packing.cost(lengths[item])
            assert offset == 1024 - room[s]
            room[s] -= n
            load[s] += packing.cost(n)


def test_substring_dedup(docs):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    order = sorted({(i is not None, i or 0, t or "", i, t) for i, t in ROWS}, key=lambda r: r[:3])
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.deduplicated(docs).collect())
    assert Counter((i, len(words(t))) for i, t in ROWS) == Counter((i, n) for (i, n, _, _), m in got.items() for _ in range(m))
    seen, first = set(), {}
    for *_, i, t in order:  # ids without ties between texts have one defined result
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 19):
            run = tuple(w[k : k + 20])
            gone[k : k + 20] |= run in seen
            seen.add(run)
        first[i, t] = (int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    for (i, t), (removed, kept) in first.items():
        if sum(j == i for j, _ in first) == 1 and i is not None:
            assert got[i, len(words(t)), removed, kept] == sum(r == (i, t) for r in ROWS), i


def test_mixing(docs):
    rows = mixing.mixed(docs)[0].collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, size(t)) for i, t in ROWS)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)


def test_ngram_join(docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.joined(docs, width=3, percent=90).collect())
    sets = []
    for _, t in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 3]) for k in range(max(len(w) - 2, 1))} if w else set())
    comp = list(range(len(ROWS)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                x, y = comp[i], comp[j]
                comp = [min(x, y) if c in (x, y) else c for c in comp]
    least = {c: min((ROWS[k][0] for k in range(len(ROWS)) if comp[k] == c and ROWS[k][0] is not None), default=None) for c in set(comp)}
    assert got == Counter((i, len(s), least[c]) for (i, _), s, c in zip(ROWS, sets, comp, strict=True))
