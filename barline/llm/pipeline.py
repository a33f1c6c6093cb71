"""A corpus from documents: toxic ones go, one of each group of near copies stays, secrets
are blotted out, sources are mixed to their weights, and what is left is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents, whatever else these are. ``run`` writes each stage and reads it
again. What a stage stores on its way is deleted when it has returned.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import common, mixing, ngram_join, packing, secrets, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the tables' labelled documents."""
    model = toxicity.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group that five-word runs link at 0.8.

    Rows that repeat id and text are one document; texts without words all stay; a row
    without an id stays only if its group has none with one.
    """
    row, other = common.unused(docs, "row", "other")
    with common.passing(spark):
        found = ngram_join.linked(docs, width=5, percent=80).where("n_shingles > 0")
        marks = found.groupBy("row").agg(F.max(F.col("row") != F.col("first_row")).alias("gone"), F.count("*").alias("many"))
        marks = common.lasting(marks.where("gone or many > 1").select(F.col("row").alias(other), "gone"))
    keyed = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    here = F.col(row) == F.col(other)
    out = keyed.join(marks, here, "left_anti")
    again = marks.where("not gone")
    if not again.isEmpty():
        out = out.unionByName(keyed.join(again, here, "left_semi").dropDuplicates([row]))
    return out.select(*common.columns(docs))


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("secrets", blot_secrets), ("mixing", mix_sources), ("packing", pack)]

#: No stage but mixing can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with common.passing(spark):
            docs = common.lasting(stage(spark, docs, sf_dir))
    return docs
