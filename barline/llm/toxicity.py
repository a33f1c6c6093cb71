"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Two words are alike by the three-letter subsequences that they share, gaps allowed: a
subsequence that spans ``n`` characters weighs DECAY ** n, spans reach SPAN characters,
and what is not a letter only widens a gap. Inserted characters and dotted or spaced
spellings therefore keep most of a word's likeness. Landmarks are words of the labelled
sample; a word's Nyström features are its likeness to them, whitened.

Training is by instances within labelled texts. Stems (first letters of words, and whole
words) are held against the labels by a likelihood ratio test, over all stems of the
sample. A stem tells alone if texts with one word of it are toxic, and jointly if only
texts with two or more different words of it are. Two SVMs learn from the words of the
stems of each kind, against words of clean texts; clean words that score highest are added
and the SVM is fitted again. The first also learns from its words with one letter or
two inserted or one put before them, and takes some of these as landmarks; stems that only tell jointly are
parts of clean words too, so theirs stay as they are. A document has the score of its most toxic unit (a word, its
letters alone, or a run of single characters joined) by the first SVM and its POOL highest
by the second (three letters are too few for likeness: such a unit tells only if it is learnt from), joined by a logistic model fitted on the sample's toxic texts and on a
third of its clean ones, whose words the SVMs do not learn from.

The sample is bounded: SAMPLE_TOXIC and SAMPLE_CLEAN labelled documents, least hash
first. Scoring reads every whole text. The kernel of a word with all landmarks is linear
in the word's subsequences, so it folds into one weight per subsequence.

Defined results: null and empty texts have no unit and the score of a unit without
likeness; without labelled rows of both kinds every score is the sample's toxic share
(0 without any); rows repeat as they are; an empty table gives no row; of the documents
only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm import common

SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 4000
LANDMARKS = 256
#: Stems and words of each kind that are learnt from, the most telling first.
STEMS = 4000
WITNESSES = 2000
#: A stem has so many letters at least; longer ones up to the second number, and whole words.
STEM = (3, 8)
#: Units that a document's joint score looks at.
POOL = 3
#: Unit scores beyond these count as these: what lies past the margin of an SVM is seen often, not more toxic.
CUT = (-1.0, 0.5)
CLEAN_WORDS = 4000
#: Forms with more letters of each word that tells alone, and of all such words together.
ALTERED = 24
ALTERED_WORDS = 2000
HARD_WORDS = 500
HARD_ROUNDS = 2
DECAY = 0.7
SPAN = 7
#: Longer words are scored in overlapping stretches of this many characters.
STRETCH = 32
_LETTERS = 34
#: Stands before the first letter of a word.
_START = "\x01"
_CACHE = 120_000

_code = np.zeros(0x250, np.int64)
_code[ord("a") : ord("z") + 1] = np.arange(1, 27)
for _c in range(0xAA, 0x250):
    if chr(_c).isalpha():
        _code[_c] = 27 + _c % 6
_code[ord(_START)] = _LETTERS - 1
_gaps = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of every three-letter subsequence; weights of a word have norm 1 or all are none."""
    size = max([3, *map(len, words)]) + SPAN
    raw = np.frombuffer("".join(w.ljust(size) for w in words).encode("utf-32-le"), np.uint32).reshape(-1, size)
    c = _code[np.minimum(raw, len(_code) - 1)]
    rows, keys, weights = [], [], []
    for a, b in _gaps:
        x, y, z = c[:, : size - b], c[:, a : size - b + a], c[:, b:]
        i, j = np.nonzero((x > 0) & (y > 0) & (z > 0))
        rows.append(i)
        keys.append((x[i, j] * _LETTERS + y[i, j]) * _LETTERS + z[i, j])
        weights.append(np.full(len(i), DECAY ** (b + 1)))
    row, key, weight = np.concatenate(rows), np.concatenate(keys), np.concatenate(weights)
    norm = np.sqrt(np.bincount(row, weight**2, len(words)))
    return row, key, weight / np.maximum(norm[row], 1e-12)


def dense(words: list[str]) -> np.ndarray:
    row, key, weight = subsequences(words)
    out = np.zeros((len(words), _LETTERS**3))
    np.add.at(out, (row, key), weight)
    return out


def units(text: str) -> set[str]:
    """Words of a text in lower case, and runs of three or more single characters, joined."""
    tokens = text.lower().split()
    out = set(tokens)
    run: list[str] = []
    if sum(map((1).__eq__, map(len, tokens))) > 2:
        for t in [*tokens, "  "]:
            if len(t) == 1:
                run.append(t)
            else:
                if len(run) > 2:
                    out.add("".join(run))
                run = []
    return out


def forms(unit: str) -> list[str]:
    """What is scored of a unit: itself in stretches, and its letters alone."""
    letters = unit if unit.isalpha() else "".join(filter(str.isalpha, unit))
    out = []
    for u in {unit, letters}:
        u = _START + u
        out += [u[lo : lo + STRETCH] for lo in range(0, max(1, len(u) - STRETCH // 2), STRETCH // 2)] if len(u) > STRETCH else [u]
    return out


def stems(all_units: set[str]) -> dict[str, int]:
    """How many different words, letters alone, have each stem; a whole word ends in "$"."""
    out: dict[str, int] = {}
    for w in {u if u.isalpha() else "".join(filter(str.isalpha, u)) for u in all_units}:
        for n in range(STEM[0], min(STEM[1] + 1, len(w))):
            out[w[:n]] = out.get(w[:n], 0) + 1
        if STEM[0] <= len(w) <= STRETCH:
            out[f"{w}$"] = 1
    return out


def altered(word: str, copies: int) -> list[str]:
    """Forms of a word with more letters: one within it, one before it, or two within it; the same at each call."""
    rng = np.random.default_rng(list(word.encode()))
    within = lambda w, at: w[:at] + chr(ord("a") + int(rng.integers(26))) + w[at:]
    place = lambda w: int(rng.integers(1, max(2, len(w))))
    kinds = [lambda w: within(w, place(w)), lambda w: within(w, 0), lambda w: within(within(w, place(w)), place(w))]
    return sorted({kinds[k % 3](word) for k in range(copies)})


@dataclass
class Model:
    weights: np.ndarray  # of each subsequence, a row for each SVM: of what tells alone, of what tells jointly
    bias: np.ndarray
    slopes: np.ndarray  # of the features of a document
    offset: float
    short: frozenset[str] | None = None  # the only units of STEM[0] letters that tell; all do if none

    def both(self, all_units: list[str]) -> np.ndarray:
        """Scores of each unit by both SVMs: those of its most toxic forms."""
        out = np.repeat(self.bias[:, None], len(all_units), axis=1)
        for lo in range(0, len(all_units), 2048):
            part = [forms(u) if self.tells(u) else [""] for u in all_units[lo : lo + 2048]]
            owner = np.repeat(np.arange(len(part)), list(map(len, part)))
            row, key, weight = subsequences([f for fs in part for f in fs])
            for k in range(2):
                score = np.bincount(row, weight * self.weights[k][key], len(owner)) + self.bias[k]
                np.maximum.at(out[k, lo : lo + 2048], owner, score)
        return out

    def raw(self, all_units: list[str]) -> np.ndarray:
        """Score of each unit by what tells alone."""
        return self.both(all_units)[0]

    def tells(self, unit: str) -> bool:
        """Whether likeness is asked of a unit: it has more letters than STEM[0], or is learnt from."""
        if self.short is None or len(letters := unit if unit.isalpha() else "".join(filter(str.isalpha, unit))) > STEM[0]:
            return True
        return letters in self.short


def constant(p: float) -> Model:
    """Every score is ``p``."""
    return Model(np.zeros((2, _LETTERS**3)), np.full(2, -1.0), np.zeros(1 + POOL), float(np.clip(np.log(max(p, 1e-30) / max(1 - p, 1e-30)), -50, 50)))


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 50.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with hinge loss, by dual coordinate descent."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    upper, square = c * weight, (x1 * x1).sum(axis=1)
    alpha, w = np.zeros(len(x)), np.zeros(x1.shape[1])
    rng = np.random.default_rng(11)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            step = np.clip(alpha[i] - (y[i] * (x1[i] @ w) - 1) / square[i], 0, upper[i]) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x1[i]
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Slopes and offset of a logistic model, by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    t = np.zeros(a.shape[1])
    damp = np.array([ridge] * x.shape[1] + [1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ t, -50, 50)))
        g = a.T @ (weight * (p - y)) + damp * t
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(damp)
        t -= np.clip(np.linalg.solve(h, g), -2, 2)
    return t[:-1], float(t[-1])


_FEATURES = [f"tox{i}" for i in range(1 + POOL)]


def _pooled(docs: DataFrame, model: Model, keep: list[str], features: list[str] = _FEATURES) -> DataFrame:
    """``keep`` columns and a text's features: its highest score alone, the POOL highest joint ones of words of different letters; all cut to CUT."""
    every = docs.columns
    kept = [every.index(k) for k in keep]
    text = every.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[float, float, str]] = {}
        plain = (CUT[0], CUT[0], "")
        for b in batches:
            cut = [units(t) if t else set() for t in b.column(text).to_pylist()]
            new = list(set().union(*cut).difference(known))
            for w, s, t in zip(new, *np.clip(model.both(new), *CUT).tolist(), strict=True):
                # most words tell nothing, and share one entry
                known[w] = plain if s <= CUT[0] and t <= CUT[0] else (s, t, "".join(filter(str.isalpha, w)) if t > CUT[0] else "")
            x = []
            for u in cut:
                alone, joint = CUT[0], {}
                for s, t, letters in map(known.__getitem__, u):
                    alone = max(alone, s)
                    if t > CUT[0]:
                        joint[letters] = max(t, joint.get(letters, t))
                top = nlargest(POOL, joint.values())
                x.append([alone, *top, *[CUT[0]] * (POOL - len(top))])
            if len(known) > _CACHE:
                for u in new:
                    del known[u]
            columns = np.array(x, float).reshape(len(x), len(_FEATURES)).T
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), *(pa.array(c) for c in columns)], [*keep, *features])

    schema = T.StructType([*(docs.schema.fields[k] for k in kept), *(T.StructField(f, T.DoubleType()) for f in features)])
    return docs.toDF(*(f"c{i}" for i in range(len(every)))).mapInArrow(common.released(run), schema)  # whatever the columns are called


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _ratio(toxic: str, clean: str, share: dict[int, int]) -> Column:
    """Log likelihood ratio of so many toxic and clean texts against the sample's shares; 0 where toxic ones are not more."""
    a, n = F.col(toxic).cast("double"), F.col(toxic) + F.col(clean)
    expected = [n * (share[y] / (share[0] + share[1])) for y in (1, 0)]
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    return F.when(a > expected[0], part(a, expected[0]) + part(F.col(clean).cast("double"), expected[1])).otherwise(0.0)


def _telling(rows: DataFrame, share: dict[int, int]) -> tuple[set[str], set[str]]:
    """Stems that tell alone, and stems that tell jointly.

    A ratio is enough if chance among as many stems would hardly reach it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                for stem, n in stems(units(t)).items() if t else ():
                    seen.setdefault(stem, [0, 0, 0, 0])[2 * (n > 1) + y] += 1
            numbers = np.array(list(seen.values()), np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array(c) for c in numbers)], ["stem", "clean1", "toxic1", "clean2", "toxic2"])

    parts = rows.where("apart = 0").select("y", "text").mapInArrow(common.released(count), "stem string, clean1 long, toxic1 long, clean2 long, toxic2 long")
    sums = parts.groupBy("stem").agg(*(F.sum(c).alias(c) for c in ("clean1", "toxic1", "clean2", "toxic2"))).where("clean1 + toxic1 + clean2 + toxic2 > 2")
    found = common.stored(sums.withColumns({"alone": _ratio("toxic1", "clean1", share), "jointly": _ratio("toxic2", "clean2", share)}))
    tried = found.agg(F.sum((F.col("clean1") + F.col("toxic1") > 2).cast("int")), F.sum((F.col("clean2") + F.col("toxic2") > 2).cast("int"))).first()
    least = [1 + np.log(max(1, n or 0)) for n in tried]
    tells = lambda k: F.col(f"toxic{k}") > 10 * share[1] / share[0] * F.col(f"clean{k}")

    def best(name: str, k: int, at: float) -> set[str]:
        """Without those whose toxic texts a longer one mostly has too."""
        held = {r["stem"]: r["n"] for r in found.where((F.col(name) >= at) & tells(k)).orderBy(F.desc(name), "stem").limit(STEMS).select("stem", F.col(f"toxic{k}").alias("n")).collect()}
        longer: dict[str, int] = {}
        for stem, n in held.items():
            for size in range(STEM[0], len(stem)):
                longer[stem[:size]] = max(n, longer.get(stem[:size], 0))
        return {stem for stem, n in held.items() if longer.get(stem, 0) < 0.8 * n}

    alone, jointly = best("alone", 1, least[0]), best("jointly", 2, least[1])
    jointly -= alone
    within = lambda stem: any(stem[:n] in jointly for n in range(STEM[0], len(stem)))
    return {x for x in alone if not within(x)}, jointly


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fits on labelled documents that are not held out, a bounded sample of them."""
    common.prepare(docs.sparkSession)
    with common.passing(docs.sparkSession):
        return _fit(docs, labels, label)


def _fit(docs: DataFrame, labels: DataFrame, label: str) -> Model:
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    sample = known.where("y = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC).unionByName(known.where("y = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN))
    sample = common.stored(sample.dropDuplicates(["doc_id"]))
    apart = (F.col("y") == 0) & (F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(3)) == 0)
    rows = common.stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("apart", apart.cast("int")))  # the sample has a fixed bound
    share = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not share.get(0) or not share.get(1):
        return constant(float(bool(share.get(1))))
    learnt = {r["y"]: r["n"] for r in rows.where("apart = 0").groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = share[1] / share[0]
    if not learnt.get(0):
        return constant(rate / (1 + rate))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [sorted({"".join(filter(str.isalpha, u)) for u in units(t)} - {""}) if t else [] for t in b.column("text").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(cut)), list(map(len, cut))), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("y").take(at), b.column("apart").take(at), pa.array([w[:STRETCH] for u in cut for w in u], pa.string())], ["y", "apart", "word"])

    exploded = rows.select("y", "apart", "text").mapInArrow(common.released(explode), "y int, apart int, word string")
    words = common.stored(exploded.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y") - F.col("apart")).alias("clean")))
    kinds = _telling(rows, learnt)

    def witnesses(stem_set: set[str]) -> list[tuple[str, int]]:
        def belong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not stem_set.isdisjoint(stems({w})) for w in b.column("word").to_pylist()], pa.bool_()))

        seen = words.where((F.col("toxic") > 0) & (F.col("toxic") > 3 * rate * F.col("clean"))).select("word", "toxic").mapInArrow(common.released(belong), "word string, toxic long")
        return [(r["word"], r["toxic"]) for r in seen.orderBy(F.desc("toxic"), "word").limit(WITNESSES).collect()]

    clean = words.where((F.col("clean") > 0) & (F.col("toxic") <= 10 * F.col("clean")))
    common_words = [r["word"] for r in clean.orderBy(F.desc("clean"), "word").limit(CLEAN_WORDS // 2).collect()]
    other = [r["word"] for r in clean.orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS // 2).collect()]
    alone, jointly = kinds
    negative = {*common_words, *other}
    learnt_from = [witnesses(alone), witnesses(jointly)]
    fitted = [_unit_svm(clean, learnt_from[0], alone, negative, ALTERED), _unit_svm(clean, learnt_from[1], jointly, negative)]
    if not any(f[0].any() for f in fitted):
        return constant(rate / (1 + rate))
    model = Model(np.stack([f[0] for f in fitted]), np.array([f[1] for f in fitted]), np.zeros(1 + POOL), 0.0)
    model.short = frozenset(w for found in learnt_from for w, _ in found if len(w) <= STEM[0])
    got = _pooled(rows.select("y", "apart", "text"), model, ["y", "apart"]).toPandas()  # the sample's rows
    if got["apart"].any():
        got = got[(got["y"] == 1) | (got["apart"] == 1)]  # clean texts whose words the SVMs have not seen
    every = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    y = got["y"].to_numpy()
    weight = np.where(y == 1, every[1] / share[1], every[0] / max(1, (y == 0).sum()))  # both kinds as often as among all labels
    model.slopes, model.offset = logistic(got[_FEATURES].to_numpy(), y.astype(float), weight)
    return model


def _unit_svm(clean: DataFrame, witnesses: list[tuple[str, int]], stem_set: set[str], negative: set[str], copies: int = 0) -> tuple[np.ndarray, float]:
    """Weights of subsequences and bias: an SVM of witnesses, with how many texts hold each, against clean words.

    ``copies`` altered forms of each witness are learnt from too, but for those that are words of clean texts.
    """
    if not witnesses:
        return np.zeros(_LETTERS**3), -1.0
    copies = min(copies, ALTERED_WORDS // len(witnesses))
    changed = {a: n for w, n in witnesses for a in altered(w, copies)}
    if changed:
        forms_of = clean.sparkSession.createDataFrame([(a,) for a in changed], "word string")  # ALTERED_WORDS at most
        real = {r["word"] for r in clean.join(F.broadcast(forms_of), "word", "left_semi").select("word").collect()}
        changed = {a: n for a, n in sorted(changed.items()) if a not in real}
    names = {w for w, _ in witnesses}
    fair = lambda ws: sorted(w for w in {*ws} - names if stem_set.isdisjoint(stems({w})))
    first = fair(negative)
    landmarks = [w for w, _ in witnesses[: LANDMARKS // 2]]
    room = LANDMARKS // 2 - len(landmarks)
    landmarks += list(changed)[:: max(1, -(-len(changed) // max(1, room)))][:room]
    landmarks += [w for w in first if len(w) > 3][:: max(1, len(first) // LANDMARKS)][: LANDMARKS - len(landmarks)]
    marks = dense([_START + w for w in landmarks])
    values, vectors = np.linalg.eigh(marks @ marks.T)
    whiten = vectors / np.sqrt(np.maximum(values, 1e-6))
    known = [*(w for w, _ in witnesses), *changed]
    covers = np.array([*(n for _, n in witnesses), *changed.values()], float)

    def fitted(negative: list[str]) -> tuple[np.ndarray, float]:
        examples = [_START + w for w in [*known, *negative]]
        y = np.array([1.0] * len(known) + [-1.0] * len(negative))
        # each kind weighs the same in all; a witness by how many hold it
        weight = np.concatenate([0.5 + covers / covers.mean() / 2, np.full(len(negative), 1.0)])
        x = np.concatenate([dense(examples[k : k + 64]) @ marks.T for k in range(0, len(examples), 64)]) @ whiten
        w, bias = linear_svm(x, y, weight)
        return (whiten @ w) @ marks, bias

    out = fitted(first)
    for _ in range(HARD_ROUNDS):
        model = Model(np.stack([out[0], out[0]]), np.array([out[1], out[1]]), np.zeros(1 + POOL), 0.0)

        def score(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(model.raw(b.column("word").to_pylist()))], ["word", "s"])

        hard = clean.select("word").mapInArrow(common.released(score), "word string, s double").orderBy(F.desc("s"), "word").limit(HARD_WORDS)
        first = sorted({*first, *fair(r["word"] for r in hard.collect())})
        out = fitted(first)
    return out


def _score(model: Model, features: list[str] = _FEATURES) -> Column:
    z = sum((float(w) * F.col(f) for w, f in zip(model.slopes, features, strict=True)), F.lit(model.offset))
    z = F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))
    return 1 / (1 + F.exp(-z))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score: one row per row of ``docs``."""
    common.prepare(docs.sparkSession)
    pooled = _pooled(docs.select("doc_id", "text"), model, ["doc_id"])
    return pooled.select("doc_id", _score(model).alias("score"))


def clean(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score less than ``below``, with all their columns."""
    common.prepare(docs.sparkSession)
    features = common.unused(docs, *_FEATURES)
    return _pooled(docs, model, docs.columns, features).where(_score(model, features) < below).select(*common.columns(docs))


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
