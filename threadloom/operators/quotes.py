"""Quote candidates: passages of all text sources, by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.text import distinct_ci, matches, occurrences, passages


def sources(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Texts of every thread: body (0), title (1) and comments (2), each a row."""
    body = submissions.select(
        F.concat(F.lit("t3_"), "id").alias("thread_id"), F.col("id").alias("submission_id"), F.lit(None).cast("string").alias("comment_id"), "subreddit", "author", "score", "title",
        F.explode(F.array(F.struct(F.lit(0).alias("n"), F.lit("submission_body").alias("source_type"), F.col("selftext").alias("text")), F.struct(F.lit(1).alias("n"), F.lit("submission_title").alias("source_type"), F.col("title").alias("text")))).alias("s"),
    ).select("thread_id", "submission_id", "comment_id", "subreddit", "author", "score", "title", "s.*")
    replies = comments.select(
        F.concat(F.lit("t3_"), "link_id").alias("thread_id"), F.col("link_id").alias("submission_id"), F.col("id").alias("comment_id"), "subreddit", "author", "score",
        F.lit("").alias("title"), F.lit(2).alias("n"), F.lit("comment").alias("source_type"), F.col("body").alias("text"),
    )
    return body.unionByName(replies).where("text <> ''")


def explode_passages(texts: DataFrame) -> DataFrame:
    return texts.select("*", F.posexplode(passages(F.col("text"))).alias("passage_no", "passage")).drop("text")


def flags(text: Column, words: dict[str, str]) -> list[Column]:
    return [matches(text, rf"\b({w})\b").alias(f"has_{k}") for k, w in words.items()]


def categories(categories_: dict[str, list[str]] = lexicon.CATEGORIES) -> Column:
    """Categories in order, from the flag columns of their word lists."""
    items = []
    for name, lists in categories_.items():
        met = F.col(f"has_{lists[0]}")
        for k in lists[1:]:
            met = met | F.col(f"has_{k}")
        items.append(F.when(met, F.lit(name)))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def categorised(texts: DataFrame, words: dict[str, str] = lexicon.WORDS, categories_: dict[str, list[str]] = lexicon.CATEGORIES) -> DataFrame:
    """Passages with at least one category; each word list is tested once per passage."""
    flagged = explode_passages(texts).select("*", *flags(F.col("passage"), words))
    return flagged.withColumn("categories", categories(categories_)).where(F.size("categories") > 0)


def strength() -> Column:
    """1 for the first person, 0.5 for several categories, 0.25 each for length and imagery."""
    part = lambda c, v: F.when(c, v).otherwise(0.0)
    return part(F.col("has_first_person"), 1.0) + part(F.size("categories") > 1, 0.5) + part(F.length("passage") >= 40, 0.25) + part(F.col("has_visual"), 0.25)


def candidates(texts: DataFrame, words: dict[str, str] = lexicon.WORDS, categories_: dict[str, list[str]] = lexicon.CATEGORIES, *, with_signals: bool = True) -> DataFrame:
    """A row for each passage and category, with signals, strength and an id that is stable over runs."""
    rows = categorised(texts, words, categories_).withColumn("quote_strength", strength())
    if with_signals:
        # each list is extracted once for a passage, and only where it occurs
        none = F.array().cast("array<string>")
        rows = rows.select("*", *[F.when(F.col(f"has_{k}"), occurrences(F.col("passage"), rf"\b({w})\b", 1)).otherwise(none).alias(f"hits_{k}") for k, w in words.items()])
        items = [F.when(F.array_contains("categories", name), F.struct(F.lit(name).alias("category"), distinct_ci(F.flatten(F.array(*[F.col(f"hits_{k}") for k in lists]))).alias("signals"))) for name, lists in categories_.items()]
        rows = rows.select("*", F.explode(F.array_compact(F.array(*items))).alias("item")).select("*", "item.*").drop("item", *[f"hits_{k}" for k in words])
    else:
        rows = rows.select("*", F.explode("categories").alias("category"))
    digest = F.substring(F.md5(F.concat("passage", F.lit("‖"), "category")), 1, 12)
    rows = rows.withColumn("quote_id", F.concat_ws(":", "thread_id", F.coalesce("comment_id", F.lit("submission")), "category", digest))
    why = F.create_map(*[F.lit(x) for kv in lexicon.WHY.items() for x in kv])
    return rows.withColumn("why_it_matters", why[F.col("category")]).drop("categories", *[f"has_{k}" for k in words])
