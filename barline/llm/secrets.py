"""Secret scans: candidates by shape, false positives removed by a random forest.

Candidates come from words of LEAST_CHARS characters or more with a digit, and from any
word where it or one of the two before it speaks of secrets: the word's value (what
stands after its last assignment, without quotes) and every other value that is assigned
in it. Features: length of the value, shares and transitions of character kinds, variety
of characters, how much of it frequent words of the corpus cover, marks of paths and
addresses, whether its own name or one of the two words before it speaks of secrets, and
whether such a name is assigned this value. The forest learns from labelled findings, a
bounded sample of SAMPLE of each kind: a table of them, or those that formats tell (access
key ids, hexadecimal tokens beside a telling name, values assigned to one; addresses, plain
numbers, dotted numbers and plain words on the other side). It decides every candidate,
those with a label too. Findings of a fifth of the documents, by the crc32 of doc_id, are
held out of its training.

All work is DataFrame functions and the ML library's forest; there is no Python in it.

Defined results: null and empty texts have no candidate; without labelled findings of
both kinds a candidate's score is its label, or 0; repeated rows give findings each; rows
without an id are told apart by their texts, and train; an empty table gives no row. Of the documents only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm import common

LEAST_CHARS = 12
SAMPLE = 5000
TREES = 40
DEPTH = 6
DICTIONARY = 500
MARK = "[SECRET]"

#: Names that speak of secrets.
TELLING = "(?i)(passw|passphrase|pwd|secret|token|api_?key|access_?key|credential|auth)"

#: A name, and after "=" or ":" the value assigned to it; values may lie within one another. Lengths are bounded, for words of any length.
PAIR = r"""([A-Za-z0-9_.\-]{0,64})["'\\]{0,4}[=:](?=("[^"]{1,4096}"|'[^']{1,4096}'|["'\\]{0,4}[^"',;&?(){}\[\]<>\\]{1,4096}))"""

FEATURES = ["length", "digits", "uppers", "lowers", "others", "hex", "transitions", "variety", "covered", "slashes", "dots", "ats", "colons", "assigned", "named", "near", "further", "stated"]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of id and text), place, word, value, name, near, further: one row per candidate, place counting words from 0."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x09-\x0D]", " ")), " +")
    tells = lambda w: F.coalesce(w.rlike(TELLING), F.lit(False))
    long = lambda w: (F.length(w) >= LEAST_CHARS) & w.rlike("[0-9]")

    # the words before stand beside each word: a lambda that reads a whole array of words would split the text for each
    before = lambda n: F.concat(F.array_repeat(F.lit(None).cast("string"), n), words)
    placed = F.transform(F.arrays_zip(words.alias("word"), before(1).alias("w1"), before(2).alias("w2")), lambda x, i: F.struct(i.alias("place"), x["word"].alias("word"), x["w1"].alias("w1"), x["w2"].alias("w2")))
    told = lambda x: tells(x["word"]) | tells(x["w1"]) | tells(x["w2"])
    hits = F.when(tells(F.col("text")), F.filter(placed, lambda x: x["word"].isNotNull() & (long(x["word"]) | told(x)))).otherwise(F.filter(placed, lambda x: x["word"].isNotNull() & long(x["word"])))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.explode(hits).alias("h")).select("doc_id", "row", "h.*")
    whole = F.regexp_replace(F.regexp_replace("word", r"""^.*[=:]["']?(?=.{8})|^["'(<\[]+""", ""), r"""["')>\],.;!?]+$""", "")
    quoted = F.regexp_extract("word", r"""^["']([^"']+)["'][^"'=:]*$""", 1)
    pair = lambda g: F.when(F.col("word").rlike("[=:]"), F.regexp_extract_all("word", F.lit(PAIR), F.lit(g))).otherwise(F.array().cast("array<string>"))
    bare = lambda v: F.regexp_replace(F.regexp_replace(v, r"""^["'\\]+""", ""), r"""["'!.\\]+$""", "")
    pairs = F.zip_with(pair(1), pair(2), lambda n, v: F.struct(n.alias("name"), bare(v).alias("value")))
    cut = rows.withColumn("pairs", pairs)
    name = F.coalesce(F.when(F.size("pairs") > 0, F.element_at("pairs", -1)["name"]), F.regexp_extract("word", r"^(.*)[=:]", 1))
    first = F.array(F.struct(name.alias("name"), F.when(quoted != "", quoted).otherwise(whole).alias("value")))
    more = F.filter("pairs", lambda p: (p["value"] != first[0]["value"]) & ((F.length(p["value"]) >= 8) | tells(p["name"]) | tells(F.col("w1")) | tells(F.col("w2"))))
    found = cut.select("doc_id", "row", "place", "word", "w1", "w2", F.explode(F.array_distinct(F.concat(first, more))).alias("p")).where(F.col("p.value").rlike(r"[\p{L}0-9]"))
    return found.select("doc_id", "row", F.col("place").cast("long").alias("place"), "word", "p.value", "p.name", F.coalesce("w1", F.lit("")).alias("near"), F.coalesce("w2", F.lit("")).alias("further"))


def dictionary(docs: DataFrame) -> list[str]:
    """The DICTIONARY most frequent lower-case words of four letters and more, counted over all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(r"(?<!\S)\p{L}{4,}(?!\S)"), F.lit(0))).alias("w"))
    return [r["w"] for r in words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(DICTIONARY).collect()]


def stated() -> Column:
    """Whether a telling name is assigned the value: its own, or that of the words before it."""
    near, further = F.col("near"), F.col("further")
    return F.col("name").rlike(TELLING) | (near.rlike(TELLING) & near.rlike(r"""[=:]["']?$""")) | (near.isin("=", ":", ":=", "=>") & further.rlike(TELLING))


def featured(found: DataFrame, frequent: list[str]) -> DataFrame:
    """Adds FEATURES, all doubles."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    share = lambda pattern: F.coalesce(F.regexp_count(v, F.lit(pattern)), F.lit(0)) / n
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "c")
    known = "|".join(sorted(frequent, key=lambda w: (-len(w), w))) or "(?!)"
    tells = lambda c: F.col(c).rlike(TELLING).cast("double")
    return found.select(
        *found.columns,
        F.struct(
            n.alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"), share("[a-z]").alias("lowers"), share("[^A-Za-z0-9]").alias("others"), share("[0-9a-f]").alias("hex"),
            (F.regexp_count(kinds, F.lit("a(?!a)|b(?!b)|c(?!c)|-(?!-)")) / n).alias("transitions"), (F.size(F.array_distinct(F.split(v, ""))) / n).alias("variety"),
            (1 - F.length(F.regexp_replace(F.lower(v), known, "")) / n).alias("covered"), share("/").alias("slashes"), share("[.]").alias("dots"), share("@").alias("ats"), share(":").alias("colons"),
            (F.col("name") != "").cast("double").alias("assigned"), tells("name").alias("named"), tells("near").alias("near"), tells("further").alias("further"), stated().cast("double").alias("stated"),
        ).alias("f"),
    )


def by_format(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1 or 0 where a public format decides, else null."""
    v = F.col("value")
    tells = F.concat_ws(" ", "name", "near", "further").rlike(TELLING)
    key = v.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | v.rlike("^gh[pousr]_[0-9A-Za-z]{36}$") | v.rlike("^eyJ[0-9A-Za-z_-]+[.][0-9A-Za-z_-]+[.][0-9A-Za-z_-]+$")
    token = tells & v.rlike("^[0-9a-f]{16,}$")
    other = v.rlike("^[^@]+@[^@]+[.][A-Za-z]+$") | v.rlike("^[0-9.,:/+-]+$") | v.rlike("^(https?://|www[.])") | (~tells & v.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))
    word = v.rlike(r"^\p{L}+$") & ((F.length(v) < 8) | (F.col("f.covered") >= 1) | ~stated())
    given = stated() & (F.length(v) >= 6)
    return found.withColumn("label", F.when(key | token, 1).when(other | word, 0).when(given, 1))


def held_out() -> Column:
    """Whether a document's findings are kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(found: DataFrame) -> PipelineModel | None:
    """A forest over labelled findings (label, f) that are not held out; none without both kinds."""
    known = found.where(F.col("label").isNotNull() & ~held_out()).select("label", "f.*", F.xxhash64("doc_id", "place", "value").alias("_h"))
    rows = known.where("label = 1").orderBy("_h", *FEATURES).limit(SAMPLE).unionByName(known.where("label = 0").orderBy("_h", *FEATURES).limit(SAMPLE))
    rows = common.stored(rows.drop("_h").coalesce(1))  # a bounded sample
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="x", handleInvalid="keep")
    return PipelineModel([assembler, forest.fit(assembler.transform(rows))])


def labelled(found: DataFrame, findings: DataFrame) -> DataFrame:
    """Adds ``label`` from a table of labelled findings (doc_id, value, label); what is labelled both ways has none."""
    told = findings.groupBy(F.col("doc_id").alias("_id"), F.col("value").alias("_value")).agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    told = told.where("label = _most").drop("_most")
    return found.join(told, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("value") == F.col("_value")), "left").drop("_id", "_value")


def scanned(docs: DataFrame, findings=by_format) -> DataFrame:
    """doc_id, place, value, score, is_secret, label, held_out, row: one row per candidate.

    ``findings`` is a table of labelled ones (doc_id, value, label), or adds ``label`` to
    candidates: 1 a secret, 0 a false positive, null unknown.
    """
    found = featured(candidates(docs.select("doc_id", "text")), dictionary(docs))
    found = common.stored(labelled(found, findings) if isinstance(findings, DataFrame) else findings(found))
    model, told = fit(found), F.col("label").cast("double")
    kept = ["doc_id", "row", "place", "value", "label"]
    if model is None:
        out = found.withColumn("score", F.coalesce(told, F.lit(0.0)))
    else:
        x = model.stages[0].transform(found.select(*kept, "f.*"))
        out = model.stages[1].transform(x).withColumn("score", vector_to_array("probability")[1])
    return out.select("doc_id", "place", "value", "score", (F.col("score") >= 0.5).cast("int").alias("is_secret"), F.col("label").cast("int").alias("label"), held_out().alias("held_out"), "row")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret's value replaced by MARK, and n_chars renewed where a text changed.

    Values under LEAST_CHARS characters are replaced where no letter or digit adjoins them.
    """
    row, values = common.unused(docs, "row", "values")
    with common.passing(docs.sparkSession):
        secrets = scanned(docs).where("is_secret = 1").groupBy("row").agg(F.collect_set("value").alias("values"))  # one text's
        secrets = common.lasting(secrets).toDF(row, values)
    joined = docs.join(secrets, F.xxhash64("doc_id", "text") == F.col(row), "left")
    longest = F.array_sort(values, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    alone = lambda s: F.concat(F.lit(r"(?<![\p{L}0-9])\Q"), s, F.lit(r"\E(?![\p{L}0-9])"))
    blot = lambda t, s: F.when((F.length(s) < LEAST_CHARS) & ~s.contains("\\E"), F.regexp_replace(t, alone(s), F.lit(MARK))).otherwise(F.replace(t, s, F.lit(MARK)))
    clean = F.when(F.col(values).isNull(), F.col("text")).otherwise(F.aggregate(longest, F.col("text"), blot))
    out = joined.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(values).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*common.columns(docs))


def query(spark, sf_dir: str) -> DataFrame:
    return scanned(common.table(spark, sf_dir, "documents"))
