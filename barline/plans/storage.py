"""Sessions, scratch folders and partitioned tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_KEYS = ("symbol", "landing_date")


def session(name: str = "barline", options: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution, dynamic partition overwrite and RocksDB state."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    return SparkSession.builder.appName(name).config(map=conf | (options or {})).getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset and all runs on one machine, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/bars-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back: lineage ends here."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def database_exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{location}'" if location else ""))


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def upsert_partitions(df: DataFrame, table: str, keys: tuple[str, ...] = PARTITION_KEYS) -> None:
    """Creates ``table`` or replaces just the partitions present in ``df``; no rows change nothing.

    Rows are rebalanced by the keys: small partitions share a task, and one of more than
    spark.sql.adaptive.advisoryPartitionSizeInBytes is written by several, in as many files.
    """
    spark = df.sparkSession
    df = df.select(*(c for c in df.columns if c not in keys), *keys).hint("rebalance", *keys)
    if not table_exists(spark, table):
        df.write.partitionBy(*keys).format("parquet").saveAsTable(table)
        return
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def partition_scan(df: DataFrame, symbol: str, landing_date: str) -> DataFrame:
    """One partition; both keys prune files."""
    return df.where((F.col("symbol") == symbol) & (F.col("landing_date") == F.to_date(F.lit(landing_date))))
