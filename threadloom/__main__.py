"""Command line: ``python -m threadloom COMMAND ...``; every command reads and writes files or folders."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import lexicon
from .functions.text import iso_seconds
from .operators import corpus, evidence, quotes, reports, states, threads
from .session import SETTINGS, Scratch, ship
from .sources import records, sinks


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("threadloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _load(spark: SparkSession, posts: list[str], replies: list[str]) -> tuple[DataFrame, DataFrame]:
    """Deduplicated submissions and comments of file pairs, in their order."""
    scratch = Scratch(spark, "load")
    p = _union([corpus.submissions_from_raw(records.records(spark, f, n), keep_raw=True) for n, f in enumerate(posts)])
    r = _union([corpus.comments_from_raw(records.records(spark, f, n), keep_raw=True) for n, f in enumerate(replies)])
    return scratch.save(corpus.dedupe_submissions(p), "posts"), scratch.save(corpus.dedupe_comments(r), "replies")


def _write_corpus(posts: DataFrame, replies: DataFrame, out: str) -> None:
    """Tables, nested threads, text files and manifests of a corpus, threads of missing submissions included."""
    spark = posts.sparkSession
    scratch = Scratch(spark, "corpus")
    sinks.upsert(posts, f"{out}/submissions", "id")
    sinks.upsert(replies, f"{out}/comments", "id")
    all_ = scratch.save(threads.with_orphans(posts, replies), "threads")
    flat = scratch.save(threads.nodes(replies), "nodes")
    stats = threads.thread_stats(flat)
    sinks.write_json_lines(threads.thread_records(all_, flat, stats), f"{out}/threads")
    named = all_.select("id", threads.file_name(F.col("missing"), F.col("subreddit"), F.col("id")).alias("name"))
    sinks.write_texts(threads.rendered(all_, flat).join(named, "id"), "name", "text", f"{out}/texts")
    manifest = threads.manifest(all_, stats)
    sinks.write_manifest(manifest, f"{out}/manifest", single_file=True)


def ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    posts, replies = _load(spark, [a.submissions], [a.comments])
    if posts.isEmpty():
        return 1
    _write_corpus(posts, replies, a.out)
    print(json.dumps(threads.corpus_summary(posts, replies).first().asDict()))
    return 0


def update(spark: SparkSession, a: argparse.Namespace) -> int:
    """Rebuilds the corpus when file pairs are new or changed."""
    pairs = records.discover(spark, a.input_root)
    whole = pairs.where("submissions_path is not null and comments_path is not null").orderBy("submissions_path").collect()  # a row per export
    if not whole:
        return 1
    prints = records.file_fingerprints(spark, *[p for r in whole for p in (r["submissions_path"], r["comments_path"])])
    old = sinks.read_or_none(spark, f"{a.out}/registry")
    old = old if old is not None else prints.limit(0)
    changes = reports.changes(prints, old, ["path"], ["sha256", "bytes", "lines"])
    if not reports.registry_plan(changes, allow_changed=a.allow_changed, force=a.force, complete=sinks.exists(spark, f"{a.out}/manifest")):
        print(json.dumps({"skipped": True}))
        return 0
    prints = Scratch(spark, "registry").save(prints, "prints")
    posts, replies = _load(spark, [r["submissions_path"] for r in whole], [r["comments_path"] for r in whole])
    _write_corpus(posts, replies, a.out)
    sinks.write_table(prints, f"{a.out}/registry")
    print(json.dumps(threads.corpus_summary(posts, replies).first().asDict() | {"unpaired": pairs.count() - len(whole)}))
    return 0


def _built(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posts, kept replies with their places, and all threads of a written corpus."""
    scratch = Scratch(spark, "built")
    posts, replies = spark.read.parquet(f"{folder}/submissions"), spark.read.parquet(f"{folder}/comments")
    return posts, scratch.save(threads.nodes(replies), "nodes"), scratch.save(threads.with_orphans(posts, replies), "threads")


def extract_quotes(spark: SparkSession, a: argparse.Namespace) -> int:
    posts, nodes, _ = _built(spark, a.corpus)
    sinks.write_json_lines(quotes.candidates(quotes.sources(posts, nodes)), a.out)
    return 0


def build_packs(spark: SparkSession, a: argparse.Namespace) -> int:
    _, nodes, all_ = _built(spark, a.corpus)
    texts = Scratch(spark, "packs").save(threads.rendered(all_, nodes, a.max_comments).withColumn("thread_id", F.concat(F.lit("t3_"), "id")), "texts")
    order = all_.select(F.concat(F.lit("t3_"), "id").alias("thread_id"), F.struct("missing", F.coalesce("created_utc", F.lit(0.0)).alias("time"), "id").alias("thread_ord"))
    packed = reports.sequential_packs(order.join(texts.select("thread_id", F.col("chars").cast("bigint").alias("chars")), "thread_id"), max_threads=a.max_threads, max_chars=a.max_chars)
    packed = Scratch(spark, "packs").save(packed, "packed")
    named = reports.pack_texts(packed, texts.select("thread_id", "text")).withColumn("name", F.format_string("pack_%03d.md", "pack_no"))
    sinks.write_texts(named, "name", "text", f"{a.out}/packs")
    sinks.write_manifest(reports.pack_manifest(packed), f"{a.out}/manifest", single_file=True)
    return 0


def sample(spark: SparkSession, a: argparse.Namespace) -> int:
    posts, nodes, _ = _built(spark, a.corpus)
    counts = nodes.groupBy(F.col("link_id").alias("id")).agg(F.count("*").alias("comment_count"))
    rows = posts.join(counts, "id", "left").withColumn("thread_ord", F.struct(F.coalesce("created_utc", F.lit(0.0)).alias("c"), "id"))
    if a.keyword:
        hit = quotes.sources(posts, nodes).where(reports.any_keyword("text", a.keyword)).select(F.col("submission_id").alias("id")).distinct()
        rows = rows.join(hit, "id", "left_semi")
    out = reports.sample(rows, subreddits=a.subreddit, after=iso_seconds(a.after) if a.after else None, before=iso_seconds(a.before) if a.before else None, min_comments=a.min_comments, min_score=a.min_score, sort_by=a.sort_by, descending=a.descending, limit=a.limit)
    out = out.select(F.concat(F.lit("t3_"), "id").alias("thread_id"), "subreddit", "created_utc", "score", "comment_count", "title", "permalink")
    sinks.write_manifest(out, a.out) if a.format == "csv" else sinks.write_json_lines(out, a.out)
    return 0


def build_slice(spark: SparkSession, a: argparse.Namespace) -> int:
    config = states.read_config(spark, a.config) if a.config else lexicon.STATES
    posts, nodes, all_ = _built(spark, a.corpus)
    place = F.struct(F.when(F.col("n") == 2, 2).otherwise(1 - F.col("n")).alias("a"), F.coalesce("sort_path", F.array().cast("array<string>")).alias("b"))
    texts = quotes.sources(posts, nodes).join(nodes.select(F.col("id").alias("comment_id"), "sort_path"), "comment_id", "left").withColumn("place", place)
    times = threads.thread_times(all_, nodes).select(F.concat(F.lit("t3_"), "id").alias("thread_id"), F.col("created").alias("created_utc"))
    rows = all_.select(
        F.concat(F.lit("t3_"), "id").alias("thread_id"), F.col("id").alias("submission_id"), F.when(F.col("missing"), "orphan").otherwise("thread").alias("source_kind"), "subreddit", "title",
        F.struct("missing", F.coalesce("created_utc", F.lit(0.0)).alias("time"), "id").alias("thread_ord"), threads.file_name(F.col("missing"), F.col("subreddit"), F.col("id")).alias("markdown_path"),
    ).join(times, "thread_id")
    scored = Scratch(spark, "slice").save(states.scored(texts, config).join(rows, "thread_id"), "scored")
    order = [F.desc("score"), F.desc(F.coalesce("created_utc", F.lit(0.0))), "thread_id"]
    sinks.write_manifest(states.slice_manifest(scored, states.matched_terms(texts, config)).orderBy(*order), f"{a.out}/manifest", single_file=True)
    sinks.write_json_lines(states.slice_report(scored).orderBy("section", "rank"), f"{a.out}/report")
    sinks.write_json_lines(states.top_threads(scored), f"{a.out}/top")
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Checks the evidence of a JSON file against a corpus; with --strict invalid evidence is an error."""
    posts, nodes, all_ = _built(spark, a.corpus)
    found = evidence.from_nodes(evidence.walk(records.payload(spark, a.json))).withColumn("evidence_id", F.col("path"))
    found = Scratch(spark, "evidence").save(found, "found")
    place = F.struct(F.when(F.col("n") == 2, 2).otherwise(1 - F.col("n")).alias("a"), F.coalesce("sort_path", F.array().cast("array<string>")).alias("b"))
    texts = quotes.sources(posts, nodes).join(nodes.select(F.col("id").alias("comment_id"), "sort_path"), "comment_id", "left").withColumn("place", place)
    checked = evidence.validate(found, all_.select(F.concat(F.lit("t3_"), "id").alias("thread_id")), texts)
    report = found.select("path", "missing_keys").join(checked.select(F.col("evidence_id").alias("path"), "thread_id", "status"), "path")
    report = Scratch(spark, "evidence").save(report.withColumn("valid", (F.col("status") == "valid") & (F.size("missing_keys") == 0)), "report")
    sinks.write_json_lines(report, a.out)
    return 1 if a.strict and not report.where("not valid").isEmpty() else 0


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="threadloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(run, *options: tuple[str, dict]) -> None:
        own = commands.add_parser(run.__name__.replace("_", "-"), help=(run.__doc__ or "").strip() or None)
        own.set_defaults(run=run)
        for name, more in options:
            own.add_argument(name, **more)

    need, many, flag = {"required": True}, {"action": "append", "default": []}, {"action": "store_true"}
    number = lambda n: {"type": int, "default": n}
    command(ingest, ("--submissions", need), ("--comments", need), ("--out", need))
    command(update, ("--input-root", need), ("--out", need), ("--allow-changed", flag), ("--force", flag))
    command(extract_quotes, ("--corpus", need), ("--out", need))
    command(build_packs, ("--corpus", need), ("--out", need), ("--max-threads", number(25)), ("--max-chars", number(120_000)), ("--max-comments", number(80)))
    command(
        sample, ("--corpus", need), ("--out", need), ("--format", {"choices": ["json", "csv"], "default": "json"}), ("--subreddit", many), ("--keyword", many), ("--after", {}), ("--before", {}),
        ("--min-comments", number(0)), ("--min-score", number(-(10**9))), ("--sort-by", {"choices": ["created_utc", "score", "comment_count"], "default": "created_utc"}), ("--descending", flag), ("--limit", number(0)),
    )
    command(build_slice, ("--corpus", need), ("--out", need), ("--config", {}))
    command(validate, ("--json", need), ("--corpus", need), ("--out", need), ("--strict", flag))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    return a.run(spark or _session(), a)


if __name__ == "__main__":
    sys.exit(main())
