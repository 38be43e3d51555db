"""Evidence references: walk of nested JSON and validation of quotes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalized_text
from ..session import Scratch
from .ordering import running_total

REQUIRED = ("thread_id", "submission_id", "comment_id", "subreddit", "quote")
#: Characters of a thread's joined text that are searched together.
WINDOW = 65_536


def _children(level: DataFrame) -> DataFrame:
    """Members of objects and elements of arrays with their paths; plain values are not carried on."""
    view = f"_threadloom_{uuid.uuid4().hex}"
    level.createOrReplaceTempView(view)
    out = level.sparkSession.sql(f"""
        SELECT concat(path, CASE WHEN e.key IS NULL THEN concat('[', e.pos, ']') ELSE concat('.', e.key) END) AS path, e.value AS node
        FROM {view}, LATERAL variant_explode(node) e
        WHERE schema_of_variant(e.value) LIKE 'OBJECT%' OR schema_of_variant(e.value) LIKE 'ARRAY%'""")
    level.sparkSession.catalog.dropTempView(view)
    return out


def walk(payload: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``path, node`` of every object with a ``thread_id`` at any depth of column ``v`` (variant).

    Goes down level by level over written tables, so neither depth nor the
    number of nodes is bounded; paths read like ``$.a[0].b``.  Null payloads
    hold nothing.
    """
    scratch = scratch or Scratch(payload.sparkSession, "evidence")
    level = payload.where("v is not null").select(F.lit("$").alias("path"), F.col("v").alias("node"))
    found, depth = None, 0
    while True:
        if depth:
            level = scratch.save(level, f"level{depth}")
            if level.isEmpty():
                break
        own = level.where(F.try_variant_get("node", "$.thread_id", "variant").isNotNull())
        found = own if found is None else found.unionByName(own)
        level, depth = _children(level), depth + 1
    return found


def from_nodes(nodes: DataFrame) -> DataFrame:
    """Evidence rows with the required keys they lack (a JSON null counts as present)."""
    fields = [F.try_variant_get("node", f"$.{k}", "string").alias(k) for k in REQUIRED]
    lacking = [F.when(F.try_variant_get("node", f"$.{k}", "variant").isNull(), F.lit(k)) for k in REQUIRED]
    return nodes.select("path", *fields, F.array_compact(F.array(*lacking)).alias("missing_keys"))


def validate(evidence: DataFrame, threads: DataFrame, texts: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``status`` of each evidence row: unknown_thread, quote_mismatch or valid.

    ``threads``: ``thread_id``; ``texts``: ``thread_id, place, text`` rows, in
    the order of ``place``.  Case and blanks do not count.  A quote may run
    over any number of texts of its thread.  The joined text of a thread is
    cut into windows that overlap by the longest quote, so a thread of any
    size is searched in pieces of bounded size and never gathered.
    """
    wanted = evidence.where("thread_id is not null").select("evidence_id", "thread_id", normalized_text(F.col("quote")).alias("q"))
    known = threads.select("thread_id", F.lit(True).alias("known")).distinct()
    needed = texts.join(wanted.select("thread_id").distinct(), "thread_id", "left_semi").select("thread_id", "place", normalized_text(F.col("text")).alias("t")).where("t <> ''")
    longest = wanted.agg(F.max(F.length("q"))).first()[0] or 0
    size = max(window, longest)
    # a blank follows each text
    at = running_total(needed, "thread_id", ["place"], F.length("t") + 1)
    first = F.greatest(F.lit(0), F.floor((F.col("before") - longest) / size))
    pieces = at.withColumn("w", F.explode(F.sequence(first.cast("bigint"), F.floor((F.col("before") + F.length("t")) / size).cast("bigint"))))
    begin = F.greatest(F.lit(0), F.col("w") * size - F.col("before")).cast("int")
    end = F.least(F.length("t"), (F.col("w") + 1) * size + longest - F.col("before")).cast("int")
    pieces = pieces.select("thread_id", "w", "before", F.substring(F.col("t"), begin + 1, end - begin).alias("t"))
    joined = pieces.groupBy("thread_id", "w").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("before", "t"))), lambda x: x["t"]), " ").alias("t"))
    held = wanted.where("q <> ''").join(joined, "thread_id").where(F.contains("t", F.col("q"))).select("evidence_id", F.lit(True).alias("held")).distinct()
    out = evidence.select("evidence_id", "thread_id", "quote").join(known, "thread_id", "left").join(held, "evidence_id", "left")
    empty = normalized_text(F.col("quote")) == ""
    return out.select("evidence_id", "thread_id", F.when(F.col("known").isNull(), "unknown_thread").when(F.col("held") | empty, "valid").otherwise("quote_mismatch").alias("status"))
