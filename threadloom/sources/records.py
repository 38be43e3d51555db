"""Readers: JSON lines, JSON arrays, zstd, CSV, thread files, raw file pairs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes of raw exports, by role.
ROLES = {"posts": "submissions", "submissions": "submissions", "comments": "comments"}
FORMATS = ("jsonl", "ndjson", "json", "zst")


def json_records(spark: SparkSession, *paths: str, pair: int = 0) -> DataFrame:
    """``raw`` (variant), ``raw_keys`` and ``ord`` of each record of JSON-lines files, plain or .zst.

    Blank lines are skipped, malformed ones fail the job, and so do records
    that are no objects.  ``ord`` (pair, block, line) keeps the file order.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.struct(F.lit(pair).alias("pair"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("ord")
    )
    rows = lines.where(F.trim(F.regexp_replace("value", r"[\x{feff}\s]+", " ")) != "")
    raw = F.parse_json("value")
    whole = F.when(F.schema_of_variant(raw).startswith("OBJECT"), raw).otherwise(F.raise_error(F.lit("record is no JSON object")).cast("variant"))
    return rows.select(whole.alias("raw"), F.size(F.json_object_keys("value")).alias("raw_keys"), "ord")


def json_array_records(spark: SparkSession, *paths: str, pair: int = 0) -> DataFrame:
    """As ``json_records`` for files that hold one JSON array of objects."""
    whole = spark.read.text(list(paths), wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    whole.createOrReplaceTempView("_threadloom_arrays")
    rows = spark.sql("SELECT file, pos, v.value AS raw FROM _threadloom_arrays, LATERAL variant_explode(parse_json(_threadloom_arrays.value)) v")
    ordinal = F.struct(F.lit(pair).alias("pair"), "file", F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("line"))
    return rows.select("raw", F.size(F.json_object_keys(F.to_json("raw"))).alias("raw_keys"), ordinal.alias("ord"))


def is_array_file(spark: SparkSession, path: str) -> bool:
    """Whether the first sign of the file that is no blank is an opening bracket."""
    for row in spark.read.text(path).where(F.trim("value") != "").limit(1).collect():
        return row[0].lstrip("﻿ \t").startswith("[")
    return False


def records(spark: SparkSession, path: str, pair: int = 0) -> DataFrame:
    return json_array_records(spark, path, pair=pair) if is_array_file(spark, path) else json_records(spark, path, pair=pair)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns strings, quoted line breaks allowed."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def threads(spark: SparkSession, *paths: str, schema=None) -> DataFrame:
    """Thread files in the given order (``file_no``)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    out = None
    for n, path in enumerate(paths):
        part = reader.json(path).withColumn("file_no", F.lit(n))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def payload(spark: SparkSession, path: str) -> DataFrame:
    """One row ``v`` (variant): the JSON file, or the array of a .jsonl file's lines; an empty file is {}."""
    text = spark.read.text(path, wholetext=True)
    if path.endswith(".jsonl"):
        joined = F.concat(F.lit("["), F.array_join(F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != ""), ","), F.lit("]"))
        return text.select(F.parse_json(joined).alias("v"))
    return text.select(F.parse_json(F.when(F.trim("value") == "", "{}").otherwise(F.col("value"))).alias("v"))


def input_pairs(files: DataFrame) -> DataFrame:
    """``folder, base, submissions_path, comments_path`` of raw exports (null where one is missing).

    ``files`` has a string column ``path``; names end in a role and a format,
    as in ``forum_posts.jsonl`` or ``forum_comments.zst``, in any case.
    """
    pattern = rf"(?i)^(.*?)([^/]*)_({'|'.join(ROLES)})\.({'|'.join(FORMATS)})$"
    parts = files.select("path", *[F.regexp_extract("path", pattern, n).alias(a) for n, a in ((1, "folder"), (2, "base"), (3, "role"))]).where("role <> ''")
    role = F.lower("role")
    return parts.groupBy("folder", "base").agg(
        F.min(F.when(role.isin("posts", "submissions"), F.col("path"))).alias("submissions_path"),
        F.min(F.when(role == "comments", F.col("path"))).alias("comments_path"),
    )


def discover(spark: SparkSession, root: str) -> DataFrame:
    """``input_pairs`` of all files below a folder; those without a partner have a null path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")  # listed, not read
    return input_pairs(files)


def json_value(spark: SparkSession, path: str) -> object:
    """A small JSON file (a configuration) as a value on the driver."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def file_fingerprints(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, sha256, bytes, lines`` (line feeds) of files."""
    files = spark.read.format("binaryFile").load(list(paths))
    content = F.col("content")
    lines = F.length(content) - F.length(F.replace(F.decode(content, "ISO-8859-1"), F.lit("\n"), F.lit("")))
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), lines.cast("bigint").alias("lines"))
