"""Incremental ingest: new export files rewrite only the buckets of ids they touch."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import corpus
from ..session import Scratch, ship
from ..sources.sinks import exists

#: Buckets of a new table, and rows of a bucket on average above which their number is doubled.
BUCKETS, BUCKET_ROWS = 64, 200_000


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("buckets", F.lit(buckets)).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of buckets the table is written in: one, or two after an interrupted doubling."""
    if not exists(spark, path):
        return []
    target, fs = _hadoop(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(target)]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"buckets=(\d+)", n)))


def _write(rows: DataFrame, path: str) -> None:
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("buckets", "bucket").parquet(path)


def _merge(batch: DataFrame, path: str, dedupe, buckets: int, bucket_rows: int) -> None:
    """Best rows of old and new for the buckets the batch touches; other buckets are not read or written.

    Rows are kept by id, as they are deduplicated by it.  When buckets get
    large the whole table is written once in twice as many, so a batch of n
    ids rewrites at most n buckets of bounded size.
    """
    spark = batch.sparkSession
    scratch = Scratch(spark, "ingest")
    now = _numbers(spark, path)
    for stale in now[1:]:  # a doubling that was interrupted is done anew
        target, fs = _hadoop(spark, f"{path}/buckets={stale}")
        fs.delete(target, True)
    buckets = now[0] if now else buckets
    new = scratch.save(_bucketed(batch, buckets), "new")
    touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    rows = new
    if now:
        rows = rows.unionByName(spark.read.schema(new.schema).parquet(path).where((F.col("buckets") == buckets) & F.col("bucket").isin(touched)))
    _write(scratch.save(_bucketed(dedupe(rows.drop("buckets", "bucket")), buckets), "merged"), path)
    whole = spark.read.schema(new.schema).parquet(path)
    if whole.count() > bucket_rows * buckets:
        _write(_bucketed(whole.where(F.col("buckets") == buckets), 2 * buckets), path)
        target, fs = _hadoop(spark, f"{path}/buckets={buckets}")
        aside, _ = _hadoop(spark, f"{path}/_old-{buckets}")  # one step, and readers pass over such names
        fs.rename(target, aside)
        fs.delete(aside, True)
    scratch.close()


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, *, kind: str = "comments", buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> StreamingQuery:
    """Reads all files of ``source`` that are not ingested yet and ends.

    ``kind`` is ``comments`` or ``submissions``.  Late and redelivered records
    simply reopen their bucket; a batch that is replayed after a failure gives
    the same table, as merging is idempotent.
    """
    ship(spark)
    lines = spark.readStream.text(source).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    normalise, dedupe = (corpus.comments_from_raw, corpus.dedupe_comments) if kind == "comments" else (corpus.submissions_from_raw, corpus.dedupe_submissions)

    def take(batch: DataFrame, _: int) -> None:
        place = F.struct(F.lit(0).alias("pair"), "file", "block", F.monotonically_increasing_id().alias("line"))
        raw = batch.select("value", place.alias("ord")).where(F.trim("value") != "").select(
            F.parse_json("value").alias("raw"), F.size(F.json_object_keys("value")).alias("raw_keys"), "ord"
        )
        _merge(normalise(raw), target, dedupe, buckets, bucket_rows)

    return lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
