"""Weighted state clusters: matching, scores, slices and their roll-ups.

Patterns do not cross line ends, so a thread matches where one of its texts
does; each text is tested on its own row and combined by aggregates, and a
thread's text is never gathered.  Weights are decimals: scores round half up.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.text import collapse, matches, unicode_regex
from ..sources.records import json_value

ADJACENT_WEIGHT = Decimal("0.35")
MOST_TERMS = 8


def compiled(config: dict) -> dict:
    """Defaults filled in: thresholds 0 and 1, the priority threshold that of the core."""
    core = config.get("min_core_score", 0.0)
    return config | {
        "min_core_score": core, "min_core_states": config.get("min_core_states", 1), "priority_min_core_score": config.get("priority_min_core_score", core),
        "priority_core_state_groups": config.get("priority_core_state_groups", []), "core_states": config.get("core_states", []), "adjacent_states": config.get("adjacent_states", []),
    }


def read_config(spark: SparkSession, path: str) -> dict:
    """States of a JSON file, with the defaults filled in."""
    return compiled(json_value(spark, path))


def _matches(text: Column, state: dict) -> Column:
    return matches(text, "(?:" + "|".join(f"(?:{p})" for p in state["patterns"]) + ")")


def _weight(state: dict) -> Column:
    return F.lit(Decimal(str(state.get("weight", 1.0)))).cast("decimal(10,4)")


def scored(texts: DataFrame, config: dict = lexicon.STATES) -> DataFrame:
    """``thread_id`` with matched states, scores and the three decisions.

    ``texts``: ``thread_id, text``; one aggregate per thread with map-side
    combine, so a thread with a third of all comments is no hot spot.
    """
    c = compiled(config)
    tiers = {"core": c["core_states"], "adjacent": c["adjacent_states"]}
    all_states = [*tiers["core"], *tiers["adjacent"]]
    tested = texts.select("thread_id", *[_matches(F.col("text"), s).alias(s["id"]) for s in all_states])
    met = tested.groupBy("thread_id").agg(*[F.bool_or(s["id"]).alias(s["id"]) for s in all_states])

    def ids(states: list[dict]) -> Column:
        return F.filter(F.array(*[F.when(F.col(s["id"]), F.lit(s["id"])) for s in states]), lambda x: x.isNotNull())

    def score(states: list[dict]) -> Column:
        zero = F.lit(Decimal("0")).cast("decimal(10,4)")
        return F.round(reduce(lambda a, b: a + b, [F.when(F.col(s["id"]), _weight(s)).otherwise(zero) for s in states], zero), 2)

    out = met.select("thread_id", ids(tiers["core"]).alias("core_ids"), ids(tiers["adjacent"]).alias("adjacent_ids"), score(tiers["core"]).alias("core_score"), score(tiers["adjacent"]).alias("adjacent_score"))
    qualifies = (F.col("core_score") >= F.lit(c["min_core_score"])) & (F.size("core_ids") >= c["min_core_states"])
    groups = [F.arrays_overlap("core_ids", F.array(*[F.lit(x) for x in g])) for g in c["priority_core_state_groups"] if g]
    priority = reduce(lambda a, b: a & b, groups, F.col("core_score") >= F.lit(c["priority_min_core_score"]))
    near = ~F.col("qualifies") & ((F.size("core_ids") > 0) | (F.size("adjacent_ids") >= 2))
    return (
        out.withColumn("score", F.round(F.col("core_score") + F.lit(ADJACENT_WEIGHT) * F.col("adjacent_score"), 2).cast("decimal(12,2)"))
        .withColumn("qualifies", qualifies).withColumn("is_priority", F.col("qualifies") & priority).withColumn("is_near_miss", near)
    )


def matched_terms(texts: DataFrame, config: dict = lexicon.STATES, most: int = MOST_TERMS) -> DataFrame:
    """``thread_id, state_id, terms``: a state's first distinct hits, by pattern and then by position.

    ``texts``: ``thread_id, place, text`` where ``place`` orders a thread's texts.
    """
    c = compiled(config)
    states_ = [*c["core_states"], *c["adjacent_states"]]
    if not states_:
        return texts.sparkSession.createDataFrame([], "thread_id string, state_id string, terms array<string>")
    # one test for each state first: most texts meet none, and few meet more than one
    met = [F.when(_matches(F.col("text"), s), F.lit(n)) for n, s in enumerate(states_)]
    hit = texts.select("thread_id", "place", "text", F.explode(F.array_compact(F.array(*met))).alias("state"))
    # the patterns are values of the rows that are left, so the expression stays small however many there are
    regexes = F.array(*[F.array(*[F.struct(F.lit(s["id"]).alias("state_id"), F.lit(n).alias("pattern"), F.lit("(?i)" + p).alias("plain"), F.lit(unicode_regex(p)).alias("any")) for n, p in enumerate(s["patterns"])]) for s in states_])
    rows = hit.select("thread_id", "place", "text", F.explode(F.element_at(regexes, F.col("state") + 1)).alias("p"))
    regex = F.when(F.octet_length("text") == F.length("text"), F.col("p.plain")).otherwise(F.col("p.any"))
    rows = rows.select("thread_id", "place", F.struct("p.state_id", "p.pattern", F.regexp_extract_all("text", regex, F.lit(0)).alias("hits")).alias("f")).where(F.size("f.hits") > 0)
    rows = rows.select("thread_id", "place", "f.state_id", "f.pattern", F.posexplode("f.hits").alias("nth", "term")).withColumn("term", collapse(F.col("term"))).where("term <> ''")
    first = rows.groupBy("thread_id", "state_id", F.lower("term").alias("low")).agg(F.min(F.struct("pattern", "place", "nth", "term")).alias("t"))
    # distinct terms of a state in a thread: bounded by the patterns, not by the comments
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("thread_id", "state_id").orderBy("t.pattern", "t.place", "t.nth"))).where(F.col("rank") <= most)
    return ranked.groupBy("thread_id", "state_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col("t.term").alias("term")))), lambda x: x["term"]).alias("terms"))


def all_terms(terms: DataFrame) -> DataFrame:
    """``thread_id, matched_terms``: the distinct terms of all states, by lower-cased then plain spelling."""
    one = terms.select("thread_id", F.explode("terms").alias("term")).distinct()
    return one.groupBy("thread_id").agg(F.transform(F.array_sort(F.collect_set(F.struct(F.lower("term").alias("low"), "term"))), lambda x: x["term"]).alias("matched_terms"))


def slice_report(threads_: DataFrame) -> DataFrame:
    """``section, key, threads, rank``: totals, and counts of qualifying threads by kind, forum, state and pair.

    ``threads_``: scored threads with ``thread_ord, source_kind, subreddit``.
    Ranks go by count, then by first occurrence in thread order.
    """
    hits = threads_.where("qualifies")
    one = lambda section, key: hits.select(F.lit(section).alias("section"), key.alias("key"), F.struct("thread_ord", F.lit(0).alias("pos")).alias("at"))
    many = lambda section, items: hits.select("thread_ord", F.posexplode(items).alias("pos", "key")).select(F.lit(section).alias("section"), "key", F.struct("thread_ord", "pos").alias("at"))
    ids = F.col("core_ids")
    pairs = F.flatten(F.transform(ids, lambda a, i: F.transform(F.filter(ids, lambda b, j: j > i), lambda b: F.concat(F.least(a, b), F.lit("|"), F.greatest(a, b)))))
    rows = one("source_kind", F.col("source_kind")).unionByName(one("subreddit", F.col("subreddit")).where("key <> ''")).unionByName(many("core", ids)).unionByName(many("adjacent", F.col("adjacent_ids"))).unionByName(many("pair", pairs))
    counted = rows.groupBy("section", "key").agg(F.count("*").alias("threads"), F.min("at").alias("at"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("section").orderBy(F.desc("threads"), "at"))).drop("at")  # as many rows as keys
    totals = threads_.agg(F.count("*").alias("scored"), F.count_if("qualifies").alias("matched"), F.count_if("is_priority").alias("priority"))
    total = totals.select(F.explode(F.array(*[F.struct(F.lit("total").alias("section"), F.lit(k).alias("key"), F.col(k).alias("threads"), F.lit(n + 1).alias("rank")) for n, k in enumerate(("scored", "matched", "priority"))])).alias("t")).select("t.*")
    return ranked.unionByName(total)


def slice_manifest(threads_: DataFrame, terms: DataFrame) -> DataFrame:
    """Qualifying threads with score, states, terms, title and file name; order by score and time where written."""
    joined = threads_.where("qualifies").join(all_terms(terms), "thread_id", "left")
    lists = [F.array_join(c, "|").alias(n) for c, n in (("core_ids", "matched_core_states"), ("adjacent_ids", "matched_adjacent_states"), ("matched_terms", "matched_terms"))]
    return joined.select("thread_id", "submission_id", "source_kind", "subreddit", "created_utc", "score", "core_score", "adjacent_score", F.col("is_priority").alias("priority_qualifies"), *lists, "title", "markdown_path")


def top_threads(threads_: DataFrame, n: int = 25) -> DataFrame:
    """The best qualifying threads: score, then later time, then id."""
    return threads_.where("qualifies").orderBy(F.desc("score"), F.desc(F.coalesce("created_utc", F.lit(0.0))), "thread_id").limit(n)


def counts(scored_: DataFrame, column: str) -> DataFrame:
    """How many qualifying threads hold each id of an array column; ``first_seen`` settles ties."""
    rows = scored_.where("qualifies").select("thread_id", F.posexplode(column).alias("pos", "id"))
    return rows.groupBy("id").agg(F.count("*").alias("threads"), F.min(F.struct("thread_id", "pos")).alias("first_seen")).select("id", "threads", F.col("first_seen.thread_id").alias("first_seen"))


def cooccurrence(scored_: DataFrame) -> DataFrame:
    """Unordered pairs of core states in qualifying threads; pairs come from each row's own short array."""
    ids = F.array_sort("core_ids")
    pairs = F.flatten(F.transform(ids, lambda a: F.transform(F.filter(ids, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return scored_.where("qualifies").select(F.explode(pairs).alias("p")).groupBy(F.col("p.a").alias("state_a"), F.col("p.b").alias("state_b")).agg(F.count("*").alias("threads"))


def near_misses(scored_: DataFrame, n: int = 25) -> DataFrame:
    """The best threads that just fail."""
    order = [F.size("core_ids").desc(), F.size("adjacent_ids").desc(), F.col("score").desc(), F.col("thread_id").asc()]
    return scored_.where("is_near_miss").orderBy(*order).limit(n)
