"""What the operators of this subpackage share: tables, the shared folder, sessions."""

from __future__ import annotations

import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every operator here: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch. Texts can be long, so batches are kept short.
BATCH_ROWS = 512


#: Frees a query's shuffle files as soon as it ends, not when the driver's heap is next swept.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings that bound the memory of Arrow batches.

    They stay set: what an operator returns is run only after it has returned.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: What tasks leave in their Python worker for later ones, each under what it is.
kept: dict[str, object] = {}


def _hand_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def _drop_others(keeps: str) -> None:
    """A function of the module: a task's own functions are sent with copies of the globals they name."""
    if others := {*kept} - {keeps}:
        for name in others:
            del kept[name]
        _hand_back()


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and what its task freed goes back to the system: Python workers live on beside other tasks' memory.

    What tasks before it ``kept`` goes as well, first of all, but for what is under the name of ``keeps``.
    """

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_others(keeps)
        yield from run(batches)
        _hand_back()

    return held


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that setting is absent and all runs on one machine (tests), a temporary
    folder is made and set as the checkpoint folder; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/barline-{uuid.uuid4().hex}"


class _Scopes(threading.local):
    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scopes = _Scopes()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes within are deleted at the end, but for those of ``lasting``."""
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def lasting(df: DataFrame) -> DataFrame:
    """Like ``stored``, for a table that is read after ``passing`` has ended."""
    return stored(df, shared_dir(df.sparkSession))


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: lineage ends here.

    What was shuffled to make it is freed once it is written.
    """
    spark = df.sparkSession
    if not path:
        path = shared_dir(spark)
        if _scopes.open:
            _scopes.open[-1].append(path)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


#: Documents whose keys one task gathers, at most as a mean.
BUCKET_DOCS = 4000


def buckets(spark: SparkSession, documents: int) -> int:
    """Buckets for keys of so many documents: at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), documents // BUCKET_DOCS)


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever they are called."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def word_count(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
