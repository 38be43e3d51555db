"""Normalised, deduplicated submissions and comments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, full_name, to_double, to_long, truthy


def parent_fields(parent_id: Column, link: Column) -> Column:
    """Struct of kind, parent comment and parent submission of a ``parent_id``."""
    kind, bare = full_name(parent_id)
    post = (kind == "t3") | (F.coalesce(kind, F.lit("")) != "t1") & (bare == link)
    return F.struct(
        F.when(post, "t3").otherwise(kind).alias("parent_kind"),
        F.when(parent_id.isNotNull() & ~F.coalesce(post, F.lit(False)), bare).alias("parent_comment_id"),
        F.when(post, bare).alias("parent_submission_id"),
    )


def _text(raw: Column, *names: str) -> Column:
    return F.coalesce(*[truthy(F.try_variant_get(raw, f"$.{n}", "string")) for n in names])


def _kept(keep_raw: bool) -> list[Column]:
    return [F.to_json("raw").alias("raw_json")] if keep_raw else []


def submissions_from_raw(raw: DataFrame, *, keep_raw: bool = False) -> DataFrame:
    """Normalises JSON records (``raw, raw_keys, ord``); records without id go. ``keep_raw`` adds their JSON text."""
    r = F.col("raw")
    created = F.coalesce(F.nullif(to_double(_text(r, "created_utc")), F.lit(0.0)), to_double(_text(r, "created")))
    over = F.try_variant_get(r, "$.over_18", "string")
    return raw.select(
        full_name(_text(r, "id", "name"))[1].alias("id"), F.coalesce(_text(r, "subreddit"), F.lit("unknown")).alias("subreddit"), collapse(_text(r, "title")).alias("title"),
        collapse(_text(r, "selftext", "body")).alias("selftext"), _text(r, "author").alias("author"), created.alias("created_utc"),
        to_long(_text(r, "score")).alias("score"), to_long(_text(r, "num_comments")).alias("num_comments"), _text(r, "permalink").alias("permalink"),
        _text(r, "url").alias("url"), (F.lower(over) == "true").alias("over_18"), "raw_keys", "ord", *_kept(keep_raw),
    ).where("id is not null and id <> ''")


def comments_from_raw(raw: DataFrame, *, keep_raw: bool = False) -> DataFrame:
    """Normalises JSON records; those without id or ``link_id`` go. ``keep_raw`` adds their JSON text."""
    r = F.col("raw")
    link = full_name(_text(r, "link_id", "submission_id"))[1]
    created = F.coalesce(F.nullif(to_double(_text(r, "created_utc")), F.lit(0.0)), to_double(_text(r, "created")))
    return raw.select(
        full_name(_text(r, "id", "name"))[1].alias("id"), F.coalesce(_text(r, "subreddit"), F.lit("unknown")).alias("subreddit"), link.alias("link_id"),
        _text(r, "parent_id").alias("parent_id"), parent_fields(_text(r, "parent_id"), link).alias("p"), collapse(_text(r, "body")).alias("body"),
        _text(r, "author").alias("author"), created.alias("created_utc"), to_long(_text(r, "score")).alias("score"), _text(r, "permalink").alias("permalink"), "raw_keys", "ord", *_kept(keep_raw),
    ).where("id is not null and id <> '' and link_id is not null and link_id <> ''").select("*", "p.*").drop("p")


def submissions_from_table(table: DataFrame) -> DataFrame:
    """The same for rows that are columns already; ``rec_no`` is their order."""
    return table.select(
        full_name(truthy(F.col("id")))[1].alias("id"), F.coalesce(truthy(F.col("subreddit")), F.lit("unknown")).alias("subreddit"), collapse(F.col("title")).alias("title"),
        collapse(F.col("selftext")).alias("selftext"), truthy(F.col("author")).alias("author"), F.col("created_utc").cast("double").alias("created_utc"), "score", "num_comments",
        truthy(F.col("permalink")).alias("permalink"), truthy(F.col("url")).alias("url"), "over_18", F.lit(0).alias("raw_keys"), F.col("rec_no").alias("ord"),
    ).where("id is not null")


def comments_from_table(table: DataFrame) -> DataFrame:
    link = full_name(truthy(F.col("link_id")))[1]
    return table.select(
        full_name(truthy(F.col("id")))[1].alias("id"), F.coalesce(truthy(F.col("subreddit")), F.lit("unknown")).alias("subreddit"), link.alias("link_id"),
        truthy(F.col("parent_id")).alias("parent_id"), parent_fields(truthy(F.col("parent_id")), link).alias("p"), collapse(F.col("body")).alias("body"),
        truthy(F.col("author")).alias("author"), F.col("created_utc").cast("double").alias("created_utc"), "score", truthy(F.col("permalink")).alias("permalink"),
        F.lit(0).alias("raw_keys"), F.col("rec_no").alias("ord"),
    ).where("id is not null and link_id is not null").select("*", "p.*").drop("p")


def completeness(columns: list[tuple[str, str]]) -> Column:
    """Number of filled values: '', 0, 0.0 and false count as not filled."""
    empty = {"string": "", "number": 0, "boolean": False}
    filled = [F.when(F.col(c).isNotNull() & (F.col(c) != F.lit(empty[kind])), 1).otherwise(0) for c, kind in columns]
    return reduce(lambda a, b: a + b, filled)


def _best(rows: DataFrame, quality: list[Column]) -> DataFrame:
    """The best row of each id; ties go to the last.

    Only ids, qualities and places are aggregated (sorted, as the packed
    qualities have no fixed size); texts move once, and only those of ids that
    occur in several rows are compared at all.
    """
    ranked = rows.select(F.col("id").alias("_id"), F.struct(*[q.alias(f"q{n}") for n, q in enumerate(quality)], F.col("ord")).alias("q"))
    best = ranked.groupBy("_id").agg(F.max("q").alias("q"), F.count("*").alias("n")).where("n > 1").select("_id", F.col("q.ord").alias("_ord"))
    return rows.join(best, F.col("id") == F.col("_id"), "left").where("_id is null or ord = _ord").drop("_id", "_ord")


def dedupe_submissions(rows: DataFrame) -> DataFrame:
    """By completeness, length of text and of title, number of raw keys, last."""
    fields = [("title", "string"), ("selftext", "string"), ("author", "string"), ("created_utc", "number"), ("score", "number"), ("num_comments", "number"), ("permalink", "string"), ("url", "string"), ("over_18", "boolean")]
    return _best(rows, [completeness(fields), F.length("selftext"), F.length("title"), F.col("raw_keys")])


def dedupe_comments(rows: DataFrame) -> DataFrame:
    """By completeness, length of the body, number of raw keys, last."""
    strings = ["parent_id", "parent_kind", "parent_comment_id", "parent_submission_id", "body", "author", "permalink"]
    fields = [(c, "string") for c in strings] + [("created_utc", "number"), ("score", "number")]
    return _best(rows, [completeness(fields), F.length("body"), F.col("raw_keys")])
