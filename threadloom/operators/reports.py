"""Sampling, reading packs, change detection and next batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import matches


def any_keyword(text: str, keywords: list[str]) -> Column:
    """Whether one of the case-insensitive patterns occurs in the text."""
    return matches(F.col(text), "(?:" + "|".join(f"(?:{k})" for k in keywords) + ")")


def sample(threads: DataFrame, *, subreddits: list[str] = (), keywords: list[str] = (), after: float | None = None, before: float | None = None, min_comments: int = 0,
           min_score: int = -(10**9), sort_by: str = "created_utc", descending: bool = False, limit: int = 0) -> DataFrame:
    """Filtered threads in order; ties keep ``thread_ord``. Cheap conditions come first, texts last."""
    out = threads
    if subreddits:
        out = out.where(F.lower("subreddit").isin([s.lower() for s in subreddits]))
    if after is not None:
        out = out.where(F.col("created_utc") >= after)
    if before is not None:
        out = out.where(F.col("created_utc") < before)
    if min_comments > 0:
        out = out.where(F.coalesce("comment_count", F.lit(0)) >= min_comments)
    out = out.where(F.coalesce("score", F.lit(0)) >= min_score)
    if keywords:
        out = out.where(any_keyword("text", keywords))
    key = F.coalesce(F.col(sort_by), F.lit(0))
    out = out.orderBy(key.desc() if descending else key.asc(), F.col("thread_ord").asc())
    return out.limit(limit) if limit else out


def sequential_packs(threads: DataFrame, *, max_threads: int = 25, max_chars: int = 120_000) -> DataFrame:
    """Packs threads in order: ``thread_id, pack_no``.

    A pack ends when it holds ``max_threads`` or the next thread would exceed
    ``max_chars``; a larger thread is a pack of its own.  Filling in order is
    sequential by definition, so one task reads the narrow rows (order, id and
    length) as a stream in sorted order and keeps only the open pack's totals.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held, chars = 0, 0, 0
        for batch in batches:
            out = []
            for size in batch["chars"]:
                if held == 0 or held >= max_threads or chars + size > max_chars:
                    number, held, chars = number + 1, 0, 0
                held, chars = held + 1, chars + int(size)
                out.append(number)
            batch["pack_no"] = out
            yield batch[["thread_ord", "thread_id", "chars", "pack_no"]]

    order = "thread_ord"
    if "struct" in dict(threads.dtypes)[order]:  # a struct comes as a dictionary: pass its text
        threads = threads.withColumn("place", F.col(order))
    else:
        threads = threads.withColumn("place", F.struct(order))
    narrow = threads.select("place", F.to_json("place").alias("thread_ord"), "thread_id", "chars").repartition(1).sortWithinPartitions("place", "thread_id").drop("place")
    packed = narrow.mapInPandas(run, "thread_ord string, thread_id string, chars bigint, pack_no int")
    return packed.withColumn("thread_ord", F.from_json("thread_ord", threads.schema["place"].dataType))


def pack_manifest(packs: DataFrame) -> DataFrame:
    """``pack_no, pack_id, thread_count, text_chars, char_count, thread_ids`` of packs; ``char_count`` is the size of the pack's file.

    A file has a heading, a blank line, two lines of counts, a blank line and
    each thread's text with a rule after it.
    """
    rows = packs.groupBy("pack_no").agg(F.count("*").alias("thread_count"), F.sum("chars").alias("text_chars"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("thread_ord", "thread_id"))), lambda x: x["thread_id"]), ",").alias("thread_ids"))
    digits = lambda c: F.length(F.col(c).cast("string"))
    size = F.greatest(F.lit(3), digits("pack_no")) + digits("thread_count") + digits("text_chars") + 36 + F.col("text_chars") + 4 + 7 * F.col("thread_count")
    return rows.select("pack_no", F.concat(F.lit("pack_"), F.lpad(F.col("pack_no").cast("string"), F.greatest(F.lit(3), digits("pack_no")), F.lit("0"))).alias("pack_id"), "thread_count", "text_chars", size.cast("bigint").alias("char_count"), "thread_ids")


def pack_texts(packs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pack_no, text`` of packs and their threads' ``thread_id, text``; a pack is bounded by its limits."""
    parts = packs.join(texts, "thread_id").groupBy("pack_no").agg(
        F.count("*").alias("n"), F.sum("chars").alias("chars"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("thread_ord", F.concat("text", F.lit("\n\n---\n")).alias("part")))), lambda x: x["part"]), "\n").alias("body")
    )
    head = F.concat(F.lit("# Research Pack "), F.lpad(F.col("pack_no").cast("string"), F.greatest(F.lit(3), F.length(F.col("pack_no").cast("string"))), F.lit("0")), F.lit("\n\n- threads: "), "n", F.lit("\n- chars: "), "chars", F.lit("\n\n"))
    return parts.select("pack_no", F.concat(head, F.regexp_replace("body", r"\s+\z", ""), F.lit("\n")).alias("text"))


def changes(now: DataFrame, before: DataFrame, key: list[str], compared: list[str]) -> DataFrame:
    """``status`` of each current row: new, changed or unchanged; rows only in ``before`` do not count."""
    old = before.select(*key, F.struct(*compared).alias("_old"))
    return now.join(old, key, "left").select(
        *now.columns, F.when(F.col("_old").isNull(), "new").when(F.struct(*compared).eqNullSafe(F.col("_old")), "unchanged").otherwise("changed").alias("status")
    )


def registry_plan(changes_: DataFrame, *, allow_changed: bool = False, force: bool = False, complete: bool = True) -> bool:
    """Whether the corpus must be built anew, from the status counts of the file pairs.

    Changed pairs are an error unless they are allowed.  Nothing new or changed
    and a ``complete`` output leave nothing to do, unless forced.
    """
    counts = {r["status"]: r["count"] for r in changes_.groupBy("status").count().collect()}  # three rows
    if counts.get("changed") and not (allow_changed or force):
        raise ValueError(f"{counts['changed']} file pairs changed; allow it to rebuild")
    return bool(force or not complete or counts.get("new") or counts.get("changed"))


def valid_ids(ids: DataFrame, known: DataFrame) -> DataFrame:
    """Of ``place, thread_id`` those known, at their first place only."""
    return ids.join(known.select("thread_id").distinct(), "thread_id", "left_semi").groupBy("thread_id").agg(F.min("place").alias("place"))


def signature(rows: DataFrame, columns: list[str]) -> str:
    """A digest of the rows that does not depend on their order."""
    each = F.sha2(F.to_json(F.struct(*columns)), 256)
    parts = [F.sum(F.conv(F.substring(each, 8 * k + 1, 8), 16, 10).cast("decimal(38,0)")).alias(f"p{k}") for k in range(8)]
    return rows.agg(F.count("*").alias("n"), *parts).select(F.sha2(F.concat_ws(",", "*"), 256)).first()[0]


def next_batch(rows: DataFrame, processed: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows (by ``row_ord``) whose thread is not processed yet."""
    return rows.where("thread_id <> ''").join(processed.select("thread_id"), "thread_id", "left_anti").orderBy("row_ord").limit(n)
