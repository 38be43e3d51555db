"""Sinks: tables, upserts, JSON lines, CSV manifests, text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or none where nothing is written yet."""
    return spark.read.parquet(path) if exists(spark, path) else None


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def upsert(df: DataFrame, path: str, key: str) -> None:
    """New rows replace those of the same key, others stay; nothing is deleted.

    ``df`` has one row per key.  The new table is written whole before the old
    one goes.
    """
    old = read_or_none(df.sparkSession, path)
    if old is None:
        write_table(df, path)
        return
    kept = old.join(df.select(key), key, "left_anti")
    scratch = Scratch(df.sparkSession, "upsert")
    write_table(scratch.save(kept.unionByName(df, allowMissingColumns=True), "merged"), path)
    scratch.close()


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_manifest(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; arrays are joined by ``|``. One file only where asked for (small manifests)."""
    flat = df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    (flat.coalesce(1) if single_file else flat).write.mode("overwrite").csv(path, header=True, escape='"')


def write_texts(df: DataFrame, name: str, text: str, path: str) -> None:
    """A folder for each name that holds its text as a file."""
    df.select(F.col(name).alias("name"), F.col(text).alias("value")).write.mode("overwrite").partitionBy("name").text(path)
