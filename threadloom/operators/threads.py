"""Reply trees and threads; the flat ``nodes`` table is the working form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .hierarchy import SPACING, resolve_known
from .ordering import running_total


#: Signs of a sibling key before the id.
KEY_SIGNS = 32


def sibling_key(created: Column, id_: Column) -> Column:
    """Text that sorts like (created or 0, id), for times of any sign below 9e19 (beyond, all are equal)."""
    bounded = F.greatest(F.lit(-9e19), F.least(F.lit(9e19), F.coalesce(F.nanvl(created, F.lit(0.0)), F.lit(0.0))))
    moved = bounded.cast("decimal(38,9)") + F.lit("5" + "0" * 20).cast("decimal(38,9)")  # 21 digits before the point, always
    return F.concat(F.lpad(moved.cast("decimal(38,9)").cast("string"), KEY_SIGNS - 1, "0"), F.lit("|"), id_)


def nodes(comments: DataFrame, *, with_paths: bool = True, scratch: Scratch | None = None, spacing: int = SPACING) -> DataFrame:
    """Comments with depth, ancestry, number of children and reading order.

    A comment whose parent is not in its thread is a root (an orphaned one if
    it names a parent comment); comments on or below a loop are left out.
    ``sort_path`` is the list of sibling keys from the root; sorting a thread
    by it gives depth-first pre-order.  Without paths there is no ancestry and
    no order, which is enough for statistics and much cheaper.  No nested thread is built here, so a
    thread may be of any size.
    """
    scratch = scratch or Scratch(comments.sparkSession, "threads")
    keyed = comments.withColumn("node", F.concat(F.col("link_id"), F.lit("\u0001"), sibling_key(F.col("created_utc"), F.col("id"))))
    known = keyed.select(F.col("link_id"), F.col("id").alias("parent_comment_id"), F.col("node").alias("parent"))
    # rows without a parent stay out of the join: those of a hot thread would all meet in one task
    found = keyed.where("parent_comment_id is not null").join(known, ["link_id", "parent_comment_id"], "left")
    bare = keyed.where("parent_comment_id is null").withColumn("parent", F.lit(None).cast("string"))
    joined = scratch.save(found.unionByName(bare), "joined")
    tree = resolve_known(joined.select("node", "parent"), spacing=spacing, with_paths=with_paths, scratch=scratch)
    children = joined.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").cast("int").alias("children_count"))
    flat = joined.join(tree.where("depth >= 0"), "node").join(children, "node", "left")
    plain = flat.select(
        *comments.columns, F.col("depth").cast("int").alias("depth"), F.coalesce("children_count", F.lit(0)).alias("children_count"),
        F.when(F.col("parent").isNull(), F.col("parent_comment_id")).alias("orphaned_parent_comment_id"), *(["path"] if with_paths else []),
    )
    if not with_paths:
        return plain
    steps = F.transform("path", lambda x: F.substring_index(x, "\u0001", -1))
    ancestry = F.transform(F.slice(steps, 1, F.size("path") - 1), lambda x: F.substring(x, KEY_SIGNS + 1, 1 << 30))
    return plain.withColumns({"ancestry_comment_ids": ancestry, "sort_path": steps}).drop("path")


def thread_stats(flat: DataFrame) -> DataFrame:
    return flat.groupBy("link_id").agg(
        F.count("*").alias("comment_count"), F.count_if(F.col("depth") == 0).alias("top_level_comment_count"), F.max("depth").alias("max_depth"),
        F.count_if(F.col("orphaned_parent_comment_id").isNotNull()).alias("orphaned_root_count"),
    )


def manifest(submissions: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per submission with its reconstructed counts, threads without comments included.

    With a column ``missing`` (``with_orphans``) it also names the thread's text file.
    """
    joined = submissions.join(stats, submissions["id"] == stats["link_id"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.select(
        F.concat(F.lit("t3_"), "id").alias("thread_id"), F.col("id").alias("submission_id"), "subreddit", "created_utc", "score", F.col("num_comments").alias("num_comments_submission"),
        zero("comment_count").alias("comment_count_reconstructed"), zero("max_depth").alias("max_depth"), zero("orphaned_root_count").alias("orphaned_root_count"), "title",
        *([file_name(F.col("missing"), F.col("subreddit"), F.col("id")).alias("markdown_path")] if "missing" in submissions.columns else []),
    )


def orphaned_roots(comments: DataFrame) -> DataFrame:
    """``id, link_id, parent_comment_id`` of comments whose parent comment is not in their thread."""
    known = comments.select("link_id", F.col("id").alias("parent_comment_id"))
    rows = comments.where("parent_comment_id is not null").select("id", "link_id", "parent_comment_id")
    return rows.join(known, ["link_id", "parent_comment_id"], "left_anti").select("id", "link_id", "parent_comment_id")


def orphan_threads(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Comments whose submission is missing, as threads: subreddit and sort time of the smallest comment id."""
    lost = comments.join(submissions.select(F.col("id").alias("link_id")), "link_id", "left_anti")
    first = F.min(F.struct("id", "subreddit", "created_utc"))
    return lost.groupBy("link_id").agg(first.alias("f"), F.count("*").alias("comments")).select(
        F.concat(F.lit("t3_"), "link_id").alias("thread_id"), F.col("f.subreddit").alias("subreddit"), F.col("f.created_utc").alias("created_utc"), "comments"
    )


def corpus_summary(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Threads, comments in threads, orphan threads and their comments."""
    present = submissions.select(F.col("id").alias("link_id"), F.lit(True).alias("present"))
    per_thread = comments.groupBy("link_id").agg(F.count("*").alias("n")).join(present, "link_id", "left")
    total = per_thread.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("comments"), F.coalesce(F.sum(F.when(F.col("present"), F.col("n"))), F.lit(0)).alias("thread_comments"),
        F.count_if(F.col("present").isNull()).alias("orphan_threads"), F.coalesce(F.sum(F.when(F.col("present").isNull(), F.col("n"))), F.lit(0)).alias("orphan_comments"),
    )
    return total.crossJoin(submissions.agg(F.count("*").alias("threads")))  # one row each


def thread_records(submissions: DataFrame, flat: DataFrame, stats: DataFrame) -> DataFrame:
    """Nested threads for sinks: the ordered comments of each submission in one array.

    Submissions as from ``with_orphans`` give threads of missing ones too.
    This gathers a thread in one row by design of the format; use ``nodes``
    for processing.
    """
    fields = [F.concat(F.lit("t1_"), "id").alias("fullname"), *[c for c in flat.columns if c != "sort_path"]]
    missing = F.col("submission.missing") if "missing" in submissions.columns else F.lit(False)
    nested = flat.groupBy("link_id").agg(F.array_sort(F.collect_list(F.struct("sort_path", F.struct(*fields).alias("c")))).alias("l"))
    posts = submissions.select(F.col("id").alias("link_id"), F.struct(F.concat(F.lit("t3_"), "id").alias("fullname"), *submissions.columns).alias("submission"))
    return posts.join(nested, "link_id", "left").join(stats, "link_id", "left").select(
        F.concat(F.lit("t3_"), "link_id").alias("thread_id"), F.col("link_id").alias("submission_id"), F.col("submission.subreddit").alias("subreddit"), "submission",
        F.transform("l", lambda x: x["c"]).alias("comments"), "comment_count", "top_level_comment_count", "max_depth", "orphaned_root_count", missing.alias("missing_submission"),
    )


def comment_lines(flat: DataFrame) -> DataFrame:
    """Each comment's two lines of a rendered thread, indented by depth."""
    indent = F.repeat(F.lit("  "), F.col("depth"))
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    head = F.concat(
        indent, F.lit("- comment_id: `"), F.col("id"), F.lit("` | author: `"), F.coalesce("author", F.lit("unknown")), F.lit("` | score: `"), value("score"), F.lit("` | depth: `"), value("depth"), F.lit("`")
    )
    body = F.concat(indent, F.lit("  "), F.coalesce(F.nullif("body", F.lit("")), F.lit("[deleted/empty]")))
    return flat.withColumn("line", F.concat(head, F.lit("\n"), body))


def with_orphans(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Submissions, and an empty one for each thread whose submission is missing (``missing``).

    Its forum is that of the thread's smallest comment id.
    """
    lost = comments.join(submissions.select(F.col("id").alias("link_id")), "link_id", "left_anti")
    first = lost.groupBy("link_id").agg(F.min(F.struct("id", "subreddit")).alias("f"))
    empty = {"id": F.col("link_id"), "subreddit": F.col("f.subreddit"), "title": F.lit(""), "selftext": F.lit("")}
    kinds = dict(submissions.dtypes)
    ghosts = first.select(*[empty.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in submissions.columns], F.lit(True).alias("missing"))
    return submissions.withColumn("missing", F.lit(False)).unionByName(ghosts)


def thread_times(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """``id, created``: a thread's time, else that of its earliest comment."""
    earliest = comments.groupBy("link_id").agg(F.min("created_utc").alias("earliest"))
    return submissions.join(earliest, submissions["id"] == earliest["link_id"], "left").select("id", F.coalesce("created_utc", "earliest").alias("created"))


def thread_texts(submissions: DataFrame, comments: DataFrame, order: list[str]) -> DataFrame:
    """Title, text and bodies of each thread joined by line feeds, empty parts left out.

    ``order`` names the columns that order a thread's comments; ``sort_path``
    is the reading order.  The format gathers a thread in one row.
    """
    parts = comments.where("body <> ''").groupBy("link_id").agg(F.array_sort(F.collect_list(F.struct(*order, "body"))).alias("l"))
    joined = submissions.join(parts, submissions["id"] == parts["link_id"], "left")
    items = F.concat(F.array("title", "selftext"), F.coalesce(F.transform("l", lambda x: x["body"]), F.array().cast("array<string>")))
    return joined.select(submissions["id"].alias("id"), F.array_join(F.filter(items, lambda x: x != ""), "\n").alias("text"))


def numbered(flat: DataFrame) -> DataFrame:
    """``pos``: each comment's place in its thread's reading order, from 1.

    A hot thread is counted in several tasks.
    """
    return running_total(flat, "link_id", ["sort_path"], F.lit(1)).withColumn("pos", F.col("before") + 1).drop("before")


def _shown(c: str, other: str = "None") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(other))


def _shown_time(c: str) -> Column:
    """A double without exponent, with at least one decimal."""
    digits = F.regexp_replace(F.col(c).cast("decimal(30,9)").cast("string"), r"0+$", "")
    return F.coalesce(F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits), F.lit("None"))


def file_name(missing: Column, subreddit: Column, id_: Column) -> Column:
    """Name of a thread's text file."""
    return F.concat(subreddit, F.when(missing, "__orphan__").otherwise("__"), id_, F.lit(".md"))


def rendered(submissions: DataFrame, flat: DataFrame, most: int | None = None) -> DataFrame:
    """``id, text, chars``: each thread as a Markdown text with header, body and indented comments.

    ``submissions`` as from ``with_orphans``, ``flat`` from ``nodes`` with
    paths.  With ``most`` only so many comments are shown, in reading order,
    and a footer counts the rest; then a row of the result is bounded by them.
    """
    placed = comment_lines(numbered(flat.withColumn("body", F.coalesce("body", F.lit("")))))
    shown = placed if most is None else placed.where(F.col("pos") <= most)
    lists = shown.groupBy("link_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l"))
    counts = flat.groupBy("link_id").agg(F.count("*").alias("n"))
    rows = submissions.join(counts, submissions["id"] == counts["link_id"], "left").drop("link_id").join(lists, submissions["id"] == lists["link_id"], "left")
    line = lambda name, value: F.concat(F.lit(f"- {name}: `"), value, F.lit("`"))
    title = F.when(F.col("title") != "", F.col("title")).otherwise(F.when(F.col("missing"), "[missing submission]").otherwise("[untitled submission]"))
    body = F.when(F.col("selftext") != "", F.col("selftext")).otherwise(F.when(F.col("missing"), "[submission missing from source export]").otherwise("[no selftext]"))
    head = [
        F.concat(F.lit("# "), title), F.lit(""), line("thread_id", F.concat(F.lit("t3_"), "id")), line("submission_id", F.col("id")), line("subreddit", _shown("subreddit", "unknown")),
        line("missing_submission", F.initcap(F.col("missing").cast("string"))), line("author", _shown("author", "unknown")), line("created_utc", _shown_time("created_utc")), line("score", _shown("score")),
        line("num_comments", _shown("num_comments")), line("permalink", _shown("permalink", "")), F.lit(""), F.lit("## Submission body"), F.lit(""), body, F.lit(""), F.lit("## Comments"), F.lit(""),
    ]
    some = F.array_join(F.transform("l", lambda x: F.concat(x["line"], F.lit("\n"))), "\n")
    text = F.concat(F.array_join(F.array(*head), "\n"), F.lit("\n"), F.when(F.col("l").isNull(), F.lit("_No comments captured._")).otherwise(some))
    if most is not None:
        footer = F.format_string("\n_Truncated after %d comments; %d additional comments omitted._", F.lit(most), F.col("n") - most)
        text = F.when(F.coalesce(F.col("n") > most, F.lit(False)) & F.col("l").isNotNull(), F.concat(text, footer)).otherwise(text)
    whole = F.concat(F.regexp_replace(text, r"\A(?U)\s+|(?U)\s+\z", ""), F.lit("\n"))
    return rows.select("id", whole.alias("text")).withColumn("chars", F.length("text"))
