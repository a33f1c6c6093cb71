"""The pipeline stage by stage, on small and awkward documents, against plain versions."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barline.llm import common, mixing, packing, pipeline, tokens, toxicity

SF = "/root/testdata/sf0.01"
LINE = " ".join(f"w{i}" for i in range(60))
#: id, text, source
ROWS = [
    (1, LINE, "a"), (2, LINE + " tail", "a"), (2, LINE + " tail", "a"), (3, None, "b"), (4, "", None), (5, "one two", "b"), (5, "quite another text of its own here", "b"),
    (None, "no id at all but these words", None), (None, LINE, None), (6, "one two", "c"), (7, "par idiot en de la", "a"), (8, 'my token = "0123456789abcdef0123456789abcdef" stays secret', "b"),
    (9, "long " + "x1 " * 20000, "a"),
]
CLASHING = ["row", "other", "h", "k", "id", "values", "tox0", "high", "low", "cut", "times", "one", "best", "a b", "c.d"]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *CLASHING) for i, t, s in ROWS], schema).repartition(3)


def texts(df, docs):
    assert [f.simpleString() for f in df.schema] == [f.simpleString() for f in docs.schema]
    rows = df.collect()
    assert all([r[c] for c in CLASHING] == CLASHING for r in rows)
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


def test_empty_tables(spark, docs):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < 0"), SF).count() == 0


def test_toxicity(spark, docs):
    model = toxicity.fit(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")))
    toxic = {(r.doc_id, r.text) for r in docs.join(toxicity.scored(docs, model).where("score >= 0.5").select("doc_id"), "doc_id", "left_semi").collect()}
    assert texts(pipeline.drop_toxic(spark, docs, SF), docs) == sorted(((i, t) for i, t, _ in ROWS if (i, t) not in toxic), key=str)
    assert len(toxic) <= 1


def test_near_copies(spark, docs):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    label = list(range(len(ROWS)))
    sets = [shingles(t) for _, t, _ in ROWS]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= 0.8 * len(a | b):
                label = [label[j] if x == label[i] else x for x in label]
    want = [(ROWS[i][0], ROWS[i][1]) for i, s in enumerate(sets) if not s]
    for k in set(label):
        of = [ROWS[i] for i in range(len(ROWS)) if label[i] == k and sets[i]]
        if of:
            want.append(min(of, key=lambda r: (r[0] is None, r[0]))[:2])
    assert texts(pipeline.drop_near_copies(spark, docs, SF), docs) == sorted(want, key=str)


def test_secrets(spark, docs):
    got = dict(texts(pipeline.blot_secrets(spark, docs.where("doc_id <> 5"), SF), docs))
    assert got[8] == 'my token = "[SECRET]" stays secret'
    assert all(got[i] == t for i, t, _ in ROWS if i and i not in (5, 8))


def test_mixing(spark, docs):
    got = texts(pipeline.mix_sources(spark, docs, SF), docs)
    counts = mixing.mixed(docs)[0].where("size > 0").groupBy("doc_id").agg(F.max(F.round(F.col("taken") / F.col("size"))).cast("int").alias("n")).collect()
    times = {r.doc_id: r.n for r in counts}
    assert got == sorted(((i, t) for i, t, _ in ROWS if (t or "").strip() for _ in range(times[i])), key=str)
    got = pipeline.mix_sources(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).groupBy("doc_id").count()
    taken = mixing.mixed(spark.read.parquet(f"{SF}/documents.parquet"))[0].where("size > 0").select("doc_id", F.round(F.col("taken") / F.col("size")).cast("long").alias("count")).where("count > 0")
    assert got.exceptAll(taken).count() == 0 and taken.exceptAll(got).count() == 0


def test_packing(spark, docs):
    out = pipeline.pack(spark, docs, SF)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert out.agg(F.sum("length")).first()[0] == out.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert out.where("start = 0").count() == len(ROWS)


def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.where("length > 1024").count() == 0


def test_toxicity_of_parts_of_insults(spark):
    model = toxicity.fit(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")))
    rows = [(1, "quite another text of its own here"), (2, "their own words"), (3, "such a clown"), (4, "such a clxown")]
    got = {r.doc_id: r.score for r in toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert max(got[1], got[2]) < 0.5 < min(got[3], got[4])


def test_tasks_give_memory_back():
    def rss():
        return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

    pins = []

    def hog(batches):
        for b in batches:
            held = [bytearray(60_000) for _ in range(4000)]
            pins.append(bytearray(1000))  # stands after them
            del held
            yield b

    before = rss()
    assert list(common.released(hog)([1])) == [1] and rss() < before + 60


def test_encoders_go_before_other_tasks(spark):
    """A worker that packed holds no encoder while it scores; the next packing task still finds it."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    one = spark.createDataFrame([(1, "one two")], "doc_id long, text string").coalesce(1)

    def held(batches):
        from barline.llm import common

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(common.kept)], pa.int64())})

    names = []

    def seen(batches):
        names.append(sorted(common.kept))
        yield from batches

    common.kept.clear()
    assert len(tokens.encoder(path).encode("one two")) == 8
    for keeps in (tokens.kept_as(path), "", tokens.kept_as(path)):
        assert list(common.released(seen, keeps)([1])) == [1]
    assert names == [[tokens.kept_as(path)], [], []]
    for _ in range(8):  # whichever worker gets the task
        packing.packed(one, path, end_id=0).collect()
    assert {r.n for r in one.mapInArrow(held, "n long").collect()} == {1}
    assert {r.n for _ in range(8) for r in one.mapInArrow(common.released(held), "n long").collect()} == {0}
