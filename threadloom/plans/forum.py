"""Queries of the forum operators over the whole test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.text import collapse, iso_seconds, passages
from ..functions.text import sentences as split_sentences
from ..operators import corpus, evidence, quotes, reports, states, threads
from ..session import Scratch, table


class _Corpus:
    """The built corpus of a folder: written once in a session, read by all queries, as runs over one corpus do.

    ``posts`` and ``replies`` are deduplicated; ``tree`` is the narrow reply
    tree, ``ordered`` that with paths; ``kept`` are the replies in the tree,
    without those on or below loops; ``threads`` are the posts and an empty one
    for each missing submission.
    """

    _known: dict[tuple, "_Corpus"] = {}

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d, self.scratch, self._made = spark, d, Scratch(spark, "corpus"), {}

    @classmethod
    def of(cls, spark: SparkSession, d: str) -> "_Corpus":
        """The corpus of these very files: their times and sizes are part of its key."""
        state = []
        for name in ("submissions", "comments"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet")
            files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
            state += [(name, f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in files]
        key = (spark.sparkContext.applicationId, d, tuple(sorted(state)))
        if key not in cls._known:
            cls._known[key] = cls(spark, d)
        return cls._known[key]

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.scratch.save(make(), name)
        return self._made[name]

    @property
    def posts(self) -> DataFrame:
        return self._once("posts", lambda: corpus.dedupe_submissions(corpus.submissions_from_table(table(self.spark, self.d, "submissions"))))

    @property
    def replies(self) -> DataFrame:
        return self._once("replies", lambda: corpus.dedupe_comments(corpus.comments_from_table(table(self.spark, self.d, "comments"))))

    @property
    def tree(self) -> DataFrame:
        return self.ordered.drop("ancestry_comment_ids", "sort_path")  # one walk for both

    @property
    def ordered(self) -> DataFrame:
        return self._once("ordered", lambda: threads.nodes(self._links))

    @property
    def _links(self) -> DataFrame:
        return self.replies.select("id", "link_id", "parent_comment_id", "created_utc")

    @property
    def kept(self) -> DataFrame:
        return self._once("kept", lambda: self.replies.join(self.tree.select("id"), "id", "left_semi"))

    @property
    def nodes(self) -> DataFrame:
        """Kept replies with their place in the tree."""
        places = self.ordered.select("id", "depth", "children_count", "orphaned_parent_comment_id", "ancestry_comment_ids", "sort_path")
        return self._once("nodes", lambda: self.replies.join(places, "id"))

    @property
    def threads(self) -> DataFrame:
        return self._once("threads", lambda: threads.with_orphans(self.posts, self.replies))


def _posts(spark: SparkSession, d: str) -> DataFrame:
    return _Corpus.of(spark, d).posts


def _replies(spark: SparkSession, d: str) -> DataFrame:
    return _Corpus.of(spark, d).replies


def _nodes(spark: SparkSession, d: str, with_paths: bool = True) -> DataFrame:
    return _Corpus.of(spark, d).nodes if with_paths else _Corpus.of(spark, d).tree


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """Texts of all threads, those of missing submissions included; comments on loops are in no thread."""
    c = _Corpus.of(spark, d)
    return quotes.sources(c.posts, c.kept)


def _placed(spark: SparkSession, d: str) -> DataFrame:
    """Texts with their place in the thread: title, text, then comments in reading order."""
    c = _Corpus.of(spark, d)
    place = F.struct(F.when(F.col("n") == 2, 2).otherwise(1 - F.col("n")).alias("a"), F.coalesce("sort_path", F.array().cast("array<string>")).alias("b"))
    paths = c.ordered.select(F.col("id").alias("comment_id"), "sort_path")
    texts = quotes.sources(c.posts, c.kept)
    own = texts.where("n = 2").join(paths, "comment_id")
    return texts.where("n < 2").withColumn("sort_path", F.lit(None).cast("array<string>")).unionByName(own).withColumn("place", place).drop("sort_path")


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """``thread_id, thread_ord`` and what reports need: posts by time, then threads of missing submissions by their smallest comment id's time."""
    c = _Corpus.of(spark, d)
    ghost = threads.orphan_threads(c.replies, c.posts).select(F.col("thread_id"), F.col("created_utc").alias("ghost"))
    rows = c.threads.withColumn("thread_id", F.concat(F.lit("t3_"), "id")).join(ghost, "thread_id", "left").join(threads.thread_times(c.threads, c.kept), "id")
    order = F.struct(F.col("missing"), F.coalesce("created_utc", "ghost", F.lit(0.0)).alias("time"), F.col("id"))
    return rows.select(
        "thread_id", F.col("id").alias("submission_id"), order.alias("thread_ord"), F.when(F.col("missing"), "orphan").otherwise("thread").alias("source_kind"), "subreddit", F.col("created").alias("created_utc"), "title",
        threads.file_name(F.col("missing"), F.col("subreddit"), F.col("id")).alias("markdown_path"),
    )


def thread_manifest(spark: SparkSession, d: str) -> DataFrame:
    out = threads.manifest(_posts(spark, d), threads.thread_stats(_nodes(spark, d, with_paths=False)))
    return out.orderBy(F.coalesce("created_utc", F.lit(0.0)), "submission_id")


def full_manifest(spark: SparkSession, d: str) -> DataFrame:
    """All threads, those of missing submissions included, with the names of their text files."""
    return threads.manifest(_Corpus.of(spark, d).threads, threads.thread_stats(_nodes(spark, d, with_paths=False)))


def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    flat = _nodes(spark, d)
    return flat.select("id", "link_id", "depth", "children_count", F.array_join("ancestry_comment_ids", ">").alias("ancestry"), "orphaned_parent_comment_id")


def thread_stats(spark: SparkSession, d: str) -> DataFrame:
    return threads.thread_stats(_nodes(spark, d, with_paths=False))


def comment_lines(spark: SparkSession, d: str) -> DataFrame:
    return threads.comment_lines(_nodes(spark, d)).select("link_id", "id", F.md5("line").alias("line_md5"))


def orphan_threads(spark: SparkSession, d: str) -> DataFrame:
    return threads.orphan_threads(_replies(spark, d), _posts(spark, d)).orderBy(F.coalesce("created_utc", F.lit(0.0)), "thread_id")


def corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    return threads.corpus_summary(_posts(spark, d), _replies(spark, d))


def orphaned_roots(spark: SparkSession, d: str) -> DataFrame:
    return threads.orphaned_roots(_replies(spark, d))


def dedupe_submissions(spark: SparkSession, d: str) -> DataFrame:
    return _posts(spark, d).select("id", F.col("ord").alias("rec_no"), "subreddit", "title", F.md5("selftext").alias("text_md5"), "author", "score", "over_18")


def dedupe_comments(spark: SparkSession, d: str) -> DataFrame:
    return _replies(spark, d).select("id", F.col("ord").alias("rec_no"), "link_id", "author", F.md5("body").alias("body_md5"), "score")


def normalize_ids(spark: SparkSession, d: str) -> DataFrame:
    return corpus.comments_from_table(table(spark, d, "comments")).select(F.col("ord").alias("rec_no"), "id", "link_id", "parent_kind", "parent_comment_id", "parent_submission_id")


def collapse_whitespace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(collapse(F.col("text"))).alias("md5"), F.length(collapse(F.col("text"))).alias("chars"))


def passages_of_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(passages(F.col("text"))).alias("passage"))


def sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.size(split_sentences(F.col("text"))).alias("sentences"))


def quote_categories(spark: SparkSession, d: str) -> DataFrame:
    rows = quotes.categorised(_sources(spark, d))
    return rows.select("thread_id", "comment_id", "source_type", "passage_no", F.array_join("categories", "|").alias("categories"))


def quote_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = quotes.candidates(_sources(spark, d))
    return rows.select("quote_id", "source_type", "category", "quote_strength", F.array_join("signals", "|").alias("signals"), F.md5("passage").alias("passage_md5"))


def category_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = quotes.candidates(_sources(spark, d), with_signals=False)
    return rows.groupBy("category", "source_type").agg(F.count("*").alias("quotes"), F.count_distinct("thread_id").alias("threads"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Scores of all threads with their order, kind, forum, time and title."""
    return states.scored(_sources(spark, d)).join(_orders(spark, d), "thread_id")


def state_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select(
        "thread_id", "source_kind", "created_utc", F.array_join("core_ids", "|").alias("core_ids"), F.array_join("adjacent_ids", "|").alias("adjacent_ids"), F.col("core_score").cast("double").alias("core_score"),
        F.col("adjacent_score").cast("double").alias("adjacent_score"), F.col("score").cast("double").alias("score"), "qualifies", "is_priority", "is_near_miss",
    )


def slice_matched(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored(spark, d).where("qualifies")
    return rows.orderBy(F.desc("score"), F.desc(F.coalesce("created_utc", F.lit(0.0))), "thread_id").select("thread_id", "title", "created_utc", F.col("score").cast("double").alias("score"))


def slice_manifest(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored(spark, d)
    terms = states.matched_terms(_placed(spark, d).join(scored.where("qualifies").select("thread_id"), "thread_id", "left_semi"))
    out = states.slice_manifest(scored, terms)
    return out.select(*[F.col(c).cast("double").alias(c) if c in ("score", "core_score", "adjacent_score") else F.col(c) for c in out.columns])


def slice_report(spark: SparkSession, d: str) -> DataFrame:
    return states.slice_report(_scored(spark, d))


def top_threads(spark: SparkSession, d: str) -> DataFrame:
    return states.top_threads(_scored(spark, d)).select("thread_id", "title", "subreddit", F.col("score").cast("double").alias("score"), F.array_join("core_ids", "|").alias("core_ids"), "is_priority")


def top_priority(spark: SparkSession, d: str) -> DataFrame:
    return states.top_threads(_scored(spark, d).where("is_priority"), 50).select("thread_id", "subreddit", F.col("score").cast("double").alias("score"))


def priority_threads(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("is_priority").select("thread_id", F.col("score").cast("double").alias("score"))


def near_miss(spark: SparkSession, d: str) -> DataFrame:
    return states.near_misses(_scored(spark, d)).select("thread_id", F.size("core_ids").alias("core"), F.size("adjacent_ids").alias("adjacent"), F.col("score").cast("double").alias("score"))


def state_counts(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    both = [states.counts(s, c).withColumn("tier", F.lit(t)) for c, t in (("core_ids", "core"), ("adjacent_ids", "adjacent"))]
    return both[0].unionByName(both[1]).orderBy(F.desc("threads"), "first_seen").select("tier", "id", "threads")


def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return states.cooccurrence(_scored(spark, d))


def matched_terms(spark: SparkSession, d: str) -> DataFrame:
    return states.matched_terms(_placed(spark, d)).select("thread_id", "state_id", F.array_join("terms", "|").alias("terms"))


def sample_threads(spark: SparkSession, d: str) -> DataFrame:
    """Threads of three forums with at least two comments, between two dates, with a keyword in any of their texts, best first."""
    c = _Corpus.of(spark, d)
    counts = c.tree.groupBy(F.col("link_id").alias("id")).agg(F.count("*").alias("comment_count"))
    words = [r"\bear\b", "sleep"]
    # keywords do not cross line ends: a thread matches where one of its texts does
    hits = _sources(spark, d).select(F.col("submission_id").alias("id"), reports.any_keyword("text", words).alias("hit")).groupBy("id").agg(F.bool_or("hit").alias("hit"))
    rows = c.posts.join(counts, "id", "left").join(hits.where("hit"), "id").withColumn("thread_ord", F.struct(F.coalesce("created_utc", F.lit(0.0)).alias("c"), "id"))
    out = reports.sample(rows, subreddits=["JawClub", "quietears", "nightring"], after=iso_seconds("2008-01-10"), before=iso_seconds("2030-01-01T00:00:00+00:00"), min_comments=2, sort_by="score", descending=True)
    return out.select(F.concat(F.lit("t3_"), "id").alias("thread_id"), "subreddit", "created_utc", "score", "comment_count")


def sample_events(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").select("event_type", "user_id", F.col("ts").cast("timestamp").cast("double").alias("created_utc"), F.lit(0).alias("score"), F.lit(0).alias("thread_ord"))
    bounds = reports.sample(ev, after=iso_seconds("2024-01-05"), before=iso_seconds("2024-01-20"))
    return bounds.groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


def evidence_status(spark: SparkSession, d: str) -> DataFrame:
    known = _Corpus.of(spark, d).threads.select(F.concat(F.lit("t3_"), "id").alias("thread_id"))
    return evidence.validate(table(spark, d, "evidence_refs"), known, _placed(spark, d))


def evidence_walk(spark: SparkSession, d: str) -> DataFrame:
    """Each reference wrapped two levels deep, found again with its path."""
    refs = table(spark, d, "evidence_refs").where("thread_id is not null")
    inner = F.struct("thread_id", "submission_id", "comment_id", "subreddit", "quote")
    wrapped = refs.select(F.parse_json(F.to_json(F.struct(F.col("evidence_id").alias("no"), F.struct(F.array(F.struct(inner.alias("ref"))).alias("items")).alias("report")))).alias("v"))
    found = evidence.from_nodes(evidence.walk(wrapped))
    return found.select("path", "thread_id", F.col("submission_id"), F.array_join(F.array_sort("missing_keys"), "|").alias("missing_keys"))


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    """Threads as texts of at most 80 comments."""
    c = _Corpus.of(spark, d)
    return c._once("rendered", lambda: threads.rendered(c.threads, c.nodes, 80).withColumn("thread_id", F.concat(F.lit("t3_"), "id")))


def _thread_sizes(spark: SparkSession, d: str) -> DataFrame:
    sizes = _rendered(spark, d).select("thread_id", F.col("chars").cast("bigint").alias("chars"))
    return _orders(spark, d).join(sizes, "thread_id").select("thread_id", "chars", "thread_ord")


def rendered_threads(spark: SparkSession, d: str) -> DataFrame:
    return _rendered(spark, d).select("thread_id", F.md5("text").alias("text_md5"), "chars")


def packs(spark: SparkSession, d: str) -> DataFrame:
    return reports.sequential_packs(_thread_sizes(spark, d)).select("thread_id", "pack_no")


def pack_manifest(spark: SparkSession, d: str) -> DataFrame:
    return reports.pack_manifest(reports.sequential_packs(_thread_sizes(spark, d), max_threads=5, max_chars=45_000))


def pack_texts(spark: SparkSession, d: str) -> DataFrame:
    packed = reports.sequential_packs(_thread_sizes(spark, d))
    return reports.pack_texts(packed, _rendered(spark, d).select("thread_id", "text")).select("pack_no", F.md5("text").alias("text_md5"), F.length("text").alias("char_count"))


def thread_text(spark: SparkSession, d: str) -> DataFrame:
    c = _Corpus.of(spark, d)
    return threads.thread_texts(c.threads, c.nodes, ["sort_path"]).select("id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


def next_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d).select("thread_id", F.col("thread_ord").alias("row_ord"))
    done = table(spark, d, "evidence_refs").select("thread_id").where("thread_id is not null").distinct()
    return reports.next_batch(rows, done, 5).select("thread_id")


def processed_ids(spark: SparkSession, d: str) -> DataFrame:
    """Cited threads that exist, at their first citation."""
    cited = table(spark, d, "evidence_refs").select(F.col("evidence_id").alias("place"), "thread_id").where("thread_id is not null")
    return reports.valid_ids(cited, _Corpus.of(spark, d).threads.select(F.concat(F.lit("t3_"), "id").alias("thread_id")))


def registry_changes(spark: SparkSession, d: str) -> DataFrame:
    """Orders against an older state in which some were absent and some had another status."""
    now = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    old = now.where("o_orderkey % 10 <> 3").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 5, "X").otherwise(F.col("o_orderstatus")))
    return reports.changes(now, old, ["o_orderkey"], ["o_custkey", "o_orderstatus"]).groupBy("status").agg(F.count("*").alias("orders"), F.round(F.sum("price"), 2).alias("price"))


def orders_as_threads(spark: SparkSession, d: str) -> DataFrame:
    """Orders as posts and line items as replies, one below the other: the thread manifest over them."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("link_id"), (F.col("l_linenumber") - 1).alias("depth"), F.when(F.col("l_linenumber") == 1, "root").alias("orphaned_parent_comment_id"))
    posts = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("subreddit"), F.lit(None).cast("double").alias("created_utc"), F.lit(None).alias("score"), F.lit(None).alias("num_comments"), F.lit("").alias("title")
    )
    return threads.manifest(posts, threads.thread_stats(items)).select(F.col("submission_id").alias("o_orderkey"), F.col("subreddit").alias("o_orderpriority"), F.col("comment_count_reconstructed").alias("items"), F.col("max_depth").alias("deepest"), F.col("orphaned_root_count").alias("first_lines"))


def orders_without_items(spark: SparkSession, d: str) -> DataFrame:
    """Orders of which no line item is left, as orphan threads whose post is missing."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("link_id"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("subreddit"), F.col("o_totalprice").alias("created_utc"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    return threads.orphan_threads(orders, items).select(F.col("thread_id"), F.col("subreddit").alias("o_orderpriority"), "comments")


def variant_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.count_if(k.isNull()).alias("k_missing"))


def quotes_by_forum(spark: SparkSession, d: str) -> DataFrame:
    rows = quotes.categorised(_sources(spark, d))
    return rows.groupBy(F.lower("subreddit").alias("forum")).agg(F.count("*").alias("passages"), F.sum(F.size("categories")).alias("quotes"))


QUERIES = {
    "q01_thread_manifest": thread_manifest, "q02_tree_nodes": tree_nodes, "q03_orphan_threads": orphan_threads, "q04_corpus_summary": corpus_summary, "q05_orphaned_roots": orphaned_roots,
    "q06_dedupe_submissions": dedupe_submissions, "q07_normalize_ids": normalize_ids, "q08_collapse_whitespace": collapse_whitespace, "q09_passages": passages_of_documents, "q10_sentences": sentences,
    "q11_quote_categories": quote_categories, "q13_quote_candidates": quote_candidates, "q14_category_counts": category_counts, "q15_state_scores": state_scores, "q16_slice_matched": slice_matched,
    "q17_priority": priority_threads, "q18_near_miss": near_miss, "q19_state_counts": state_counts, "q20_cooccurrence": cooccurrence, "q21_quotes_by_forum": quotes_by_forum, "q22_matched_terms": matched_terms,
    "q23_sample_filter": sample_threads, "q24_sample_events": sample_events, "q25_evidence_status": evidence_status, "q27_evidence_walk": evidence_walk, "q28_packs": packs, "q28_pack_manifest": pack_manifest,
    "q29_thread_text": thread_text, "q30_comment_lines": comment_lines, "q31_next_batch": next_batch, "q33_registry_changes": registry_changes, "q34_orders_as_threads": orders_as_threads,
    "q35_orders_without_items": orders_without_items, "q36_variant_props": variant_props, "q37_dedupe_comments": dedupe_comments, "q38_thread_stats": thread_stats,
    "q39_full_manifest": full_manifest, "q40_slice_manifest": slice_manifest, "q41_slice_report": slice_report, "q42_top_threads": top_threads, "q43_top_priority": top_priority,
    "q44_rendered_threads": rendered_threads, "q45_pack_texts": pack_texts, "q46_processed_ids": processed_ids,
}


# --- SQL ---------------------------------------------------------------------------------------

def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BLANKS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _flat(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_BLANKS}', ' ', 'g'))"


def _bare(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '(?s)^t\\d_.+$') THEN substr({x}, 4) ELSE {x} END"


_BASE = f"""
ns AS (SELECT {_bare("nullif(id, '')")} AS id, coalesce(nullif(subreddit, ''), 'unknown') AS subreddit, {_flat('title')} AS title, {_flat('selftext')} AS selftext, nullif(author, '') AS author,
  created_utc, score, num_comments, nullif(permalink, '') AS permalink, nullif(url, '') AS url, over_18, rec_no FROM submissions),
s AS (SELECT * FROM ns WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY
  (title <> '')::INT + (selftext <> '')::INT + (author IS NOT NULL)::INT + coalesce(created_utc <> 0, false)::INT + coalesce(score <> 0, false)::INT + coalesce(num_comments <> 0, false)::INT
  + (permalink IS NOT NULL)::INT + (url IS NOT NULL)::INT + coalesce(over_18, false)::INT DESC, length(selftext) DESC, length(title) DESC, rec_no DESC) = 1),
nc0 AS (SELECT {_bare("nullif(id, '')")} AS id, coalesce(nullif(subreddit, ''), 'unknown') AS subreddit, {_bare("nullif(link_id, '')")} AS link_id, nullif(parent_id, '') AS parent_id,
  CASE WHEN regexp_matches(parent_id, '(?s)^t\\d_.+$') THEN substr(parent_id, 1, 2) END AS kind, {_bare("nullif(parent_id, '')")} AS bare, {_flat('body')} AS body, nullif(author, '') AS author,
  created_utc, score, nullif(permalink, '') AS permalink, rec_no FROM comments),
nc AS (SELECT *, coalesce(kind = 't3', false) OR (coalesce(kind, '') <> 't1' AND coalesce(bare = link_id, false)) AS post FROM nc0 WHERE id IS NOT NULL AND link_id IS NOT NULL),
pc AS (SELECT *, CASE WHEN post THEN 't3' ELSE kind END AS parent_kind, CASE WHEN parent_id IS NOT NULL AND NOT post THEN bare END AS parent_comment_id, CASE WHEN post THEN bare END AS parent_submission_id FROM nc),
c AS (SELECT * FROM pc QUALIFY row_number() OVER (PARTITION BY id ORDER BY
  (parent_id IS NOT NULL)::INT + coalesce(parent_kind <> '', false)::INT + coalesce(parent_comment_id <> '', false)::INT + coalesce(parent_submission_id <> '', false)::INT + (body <> '')::INT + (author IS NOT NULL)::INT
  + coalesce(created_utc <> 0, false)::INT + coalesce(score <> 0, false)::INT + (permalink IS NOT NULL)::INT DESC, length(body) DESC, rec_no DESC) = 1)"""

#: Replies in the tree with their path in reading order; those on or below loops are never reached.
_KEPT = f"""{_BASE},
e0 AS (SELECT c.id, p.id AS pid, coalesce(c.created_utc, 0) AS t FROM c LEFT JOIN c p ON p.link_id = c.link_id AND p.id = c.parent_comment_id),
tr(id, sp, depth) AS (SELECT id, [{{'t': t, 'i': id}}], 0 FROM e0 WHERE pid IS NULL UNION ALL SELECT e0.id, list_append(tr.sp, {{'t': e0.t, 'i': e0.id}}), depth + 1 FROM e0 JOIN tr ON e0.pid = tr.id),
k AS (SELECT c.*, tr.sp, tr.depth FROM c JOIN tr USING (id)),
gh AS (SELECT link_id AS id, arg_min(subreddit, id) AS subreddit, arg_min({{'v': created_utc}}, id).v AS ghost FROM c WHERE link_id NOT IN (SELECT id FROM s) GROUP BY 1),
th AS (SELECT id, subreddit, title, selftext, author, created_utc, score, num_comments, permalink, false AS missing, NULL::DOUBLE AS ghost FROM s
  UNION ALL SELECT id, subreddit, '', '', NULL, NULL, NULL, NULL, NULL, true, ghost FROM gh),
o AS (SELECT 't3_' || th.id AS thread_id, th.id AS submission_id, missing, coalesce(th.created_utc, ghost, 0) AS ot, CASE WHEN missing THEN 'orphan' ELSE 'thread' END AS source_kind, subreddit,
  coalesce(th.created_utc, m.t) AS created_utc, title, subreddit || CASE WHEN missing THEN '__orphan__' ELSE '__' END || th.id || '.md' AS markdown_path
  FROM th LEFT JOIN (SELECT link_id, min(created_utc) AS t FROM k GROUP BY 1) m ON m.link_id = th.id)"""

_TREE = f"""WITH RECURSIVE {_BASE},
e AS (SELECT c.*, p.id AS pid FROM c LEFT JOIN c p ON p.link_id = c.link_id AND p.id = c.parent_comment_id),
t(id, depth, ancestry) AS (SELECT id, 0, '' FROM e WHERE pid IS NULL
  UNION ALL SELECT e.id, t.depth + 1, CASE WHEN t.ancestry = '' THEN t.id ELSE t.ancestry || '>' || t.id END FROM e JOIN t ON e.pid = t.id),
ch AS (SELECT pid AS id, count(*) AS n FROM e WHERE pid IS NOT NULL GROUP BY 1),
nodes AS (SELECT e.*, t.depth, t.ancestry, coalesce(ch.n, 0) AS children, CASE WHEN e.pid IS NULL THEN e.parent_comment_id END AS orphaned FROM e JOIN t USING (id) LEFT JOIN ch USING (id)),
st AS (SELECT link_id, count(*) AS comment_count, count(*) FILTER (depth = 0) AS top_level_comment_count, max(depth) AS max_depth, count(orphaned) AS orphaned_root_count FROM nodes GROUP BY 1)"""

_SOURCES = """
src AS (SELECT 't3_' || id AS thread_id, NULL::VARCHAR AS comment_id, subreddit, 0 AS n, 'submission_body' AS source_type, selftext AS text FROM s WHERE selftext <> ''
  UNION ALL SELECT 't3_' || id, NULL, subreddit, 1, 'submission_title', title FROM s WHERE title <> ''
  UNION ALL SELECT 't3_' || link_id, id, subreddit, 2, 'comment', body FROM k WHERE body <> ''),
pl AS (SELECT src.*, CASE WHEN n = 2 THEN 2 ELSE 1 - n END AS a, coalesce(k.sp, []) AS b FROM src LEFT JOIN k ON k.id = src.comment_id)"""


def _passages(source: str, key: str) -> str:
    """Greedy passages of ``source(key columns, text)`` as relation ``pas(key columns, spot, passage)``."""
    flat = _flat("p")
    return f"""
pr AS (SELECT {key}, generate_subscripts(l, 1) AS pno, unnest(l) AS p FROM (SELECT {key}, regexp_split_to_array(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n{{2,}}') AS l FROM {source} WHERE text IS NOT NULL)),
pa AS (SELECT {key}, pno, {flat} AS p FROM pr WHERE {flat} <> ''),
se AS (SELECT {key}, pno, row_number() OVER (PARTITION BY {key}, pno ORDER BY k) AS i, x FROM (SELECT {key}, pno, generate_subscripts(l, 1) AS k, trim(unnest(l)) AS x FROM
  (SELECT {key}, pno, string_split(regexp_replace(p, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS l FROM pa WHERE length(p) > 320)) WHERE x <> ''),
fo({key}, pno, i, o, size, done) AS (SELECT {key}, pno, i, x, length(x) + 1, NULL::VARCHAR FROM se WHERE i = 1
  UNION ALL SELECT {', '.join('fo.' + k.strip() for k in key.split(','))}, fo.pno, se.i, CASE WHEN fo.size + length(x) + 1 > 320 THEN x ELSE o || ' ' || x END,
    CASE WHEN fo.size + length(x) + 1 > 320 THEN length(x) ELSE fo.size + length(x) + 1 END, CASE WHEN fo.size + length(x) + 1 > 320 AND length(o) >= 24 THEN o END
  FROM fo JOIN se ON {' AND '.join(f'fo.{k.strip()} IS NOT DISTINCT FROM se.{k.strip()}' for k in key.split(','))} AND fo.pno = se.pno AND se.i = fo.i + 1),
la AS (SELECT * FROM fo QUALIFY row_number() OVER (PARTITION BY {key}, pno ORDER BY i DESC) = 1),
pas AS (SELECT {key}, pno * 1000000 AS spot, p AS passage FROM pa WHERE length(p) <= 320 UNION ALL SELECT {key}, pno * 1000000 + i, done FROM fo WHERE done IS NOT NULL
  UNION ALL SELECT {key}, pno * 1000000 + 999999, o FROM la WHERE length(o) >= 24)"""


def _has(words: str, x: str = "passage") -> str:
    return f"regexp_matches({x}, {_lit('(?i)' + chr(92) + 'b(' + words + ')' + chr(92) + 'b')})"


_CATS = "list_filter([" + ", ".join(f"CASE WHEN {' OR '.join('has_' + k for k in lists)} THEN '{name}' END" for name, lists in lexicon.CATEGORIES.items()) + "], lambda x: x IS NOT NULL)"
_QUOTES = f"""WITH RECURSIVE {_KEPT},{_SOURCES},
sk AS (SELECT thread_id, comment_id, n, text FROM src),{_passages('sk', 'thread_id, comment_id, n')},
fl AS (SELECT *, row_number() OVER (PARTITION BY thread_id, comment_id, n ORDER BY spot) - 1 AS passage_no, {', '.join(f'{_has(w)} AS has_{k}' for k, w in lexicon.WORDS.items())} FROM pas),
cat AS (SELECT *, {_CATS} AS categories FROM fl),
q AS (SELECT cat.*, CASE n WHEN 0 THEN 'submission_body' WHEN 1 THEN 'submission_title' ELSE 'comment' END AS source_type FROM cat WHERE len(categories) > 0)"""
_SIGNALS = "CASE category " + " ".join(
    f"WHEN '{name}' THEN flatten([{', '.join(f'regexp_extract_all(passage, {_lit(chr(40) + chr(63) + chr(105) + chr(41) + chr(92) + chr(98) + chr(40) + lexicon.WORDS[k] + chr(41) + chr(92) + chr(98))}, 1)' for k in lists)}])" for name, lists in lexicon.CATEGORIES.items()
) + " END"


def _state_sql(config: dict = lexicon.STATES) -> str:
    tiers = [("core", config["core_states"]), ("adjacent", config["adjacent_states"])]
    flags = ", ".join(f"bool_or({' OR '.join('regexp_matches(text, ' + _lit('(?i)' + p) + ')' for p in s['patterns'])}) AS {s['id']}" for _, ss in tiers for s in ss)
    ids = {t: "list_filter([" + ", ".join(f"CASE WHEN {s['id']} THEN '{s['id']}' END" for s in ss) + "], lambda x: x IS NOT NULL)" for t, ss in tiers}
    score = {t: " + ".join(f"CASE WHEN {s['id']} THEN {s['weight']:.4f} ELSE 0.0000 END" for s in ss) for t, ss in tiers}
    groups = " AND ".join(f"list_has_any(core_ids, [{', '.join(_lit(x) for x in g)}])" for g in config["priority_core_state_groups"])
    return f"""WITH RECURSIVE {_KEPT},{_SOURCES},
m AS (SELECT thread_id, {flags} FROM src GROUP BY 1),
i AS (SELECT thread_id, {ids['core']} AS core_ids, {ids['adjacent']} AS adjacent_ids, {score['core']} AS cs, {score['adjacent']} AS asc_ FROM m),
j AS (SELECT *, CAST(round(cs, 2) AS DECIMAL(12, 2)) AS core_score, CAST(round(asc_, 2) AS DECIMAL(12, 2)) AS adjacent_score FROM i),
z AS (SELECT *, CAST(round(core_score + 0.35 * adjacent_score, 2) AS DOUBLE) AS score, core_score >= {config['min_core_score']} AND len(core_ids) >= {config['min_core_states']} AS qualifies FROM j),
x AS (SELECT z.*, o.* EXCLUDE (thread_id), qualifies AND core_score >= {config['priority_min_core_score']} AND {groups} AS is_priority, NOT qualifies AND (len(core_ids) > 0 OR len(adjacent_ids) >= 2) AS is_near_miss FROM z JOIN o USING (thread_id))"""


_STATES = _state_sql()
_TERMS = ", ".join(
    f"{{'state_id': '{s['id']}', 'pattern': {n}, 'hits': regexp_extract_all(text, {_lit('(?i)' + p)})}}" for s in [*lexicon.STATES["core_states"], *lexicon.STATES["adjacent_states"]] for n, p in enumerate(s["patterns"])
)
_HITS = f"""
      h AS (SELECT thread_id, a, b, unnest([{_TERMS}]) AS f FROM pl),
      w AS (SELECT thread_id, a, b, f.state_id AS state_id, f.pattern AS pattern, generate_subscripts(f.hits, 1) AS nth, unnest(f.hits) AS term FROM h WHERE len(f.hits) > 0),
      d AS (SELECT *, row_number() OVER (PARTITION BY thread_id, state_id, lower(term) ORDER BY pattern, a, b, nth, term) AS r FROM w),
      kt AS (SELECT *, row_number() OVER (PARTITION BY thread_id, state_id ORDER BY pattern, a, b, nth) AS rank FROM d WHERE r = 1)"""
_VALUE = "coalesce(CAST({0} AS VARCHAR), 'None')"
_LINES = f"""
ln AS (SELECT link_id, row_number() OVER (PARTITION BY link_id ORDER BY sp) AS pos, repeat('  ', depth) || '- comment_id: `' || id || '` | author: `' || coalesce(author, 'unknown') || '` | score: `' || {_VALUE.format('score')} || '` | depth: `' || depth || '`'
  || chr(10) || repeat('  ', depth) || '  ' || CASE WHEN body = '' THEN '[deleted/empty]' ELSE body END AS line FROM k),
ls AS (SELECT link_id, count(*) AS n, string_agg(line || chr(10), chr(10) ORDER BY pos) FILTER (pos <= 80) AS l FROM ln GROUP BY 1),
rd AS (SELECT 't3_' || id AS thread_id, rtrim(concat_ws(chr(10), '# ' || CASE WHEN title <> '' THEN title WHEN missing THEN '[missing submission]' ELSE '[untitled submission]' END, '', '- thread_id: `t3_' || id || '`', '- submission_id: `' || id || '`',
  '- subreddit: `' || subreddit || '`', '- missing_submission: `' || CASE WHEN missing THEN 'True' ELSE 'False' END || '`', '- author: `' || coalesce(author, 'unknown') || '`', '- created_utc: `' || {_VALUE.format('created_utc')} || '`', '- score: `' || {_VALUE.format('score')} || '`',
  '- num_comments: `' || {_VALUE.format('num_comments')} || '`', '- permalink: `' || coalesce(permalink, '') || '`', '', '## Submission body', '',
  CASE WHEN selftext <> '' THEN selftext WHEN missing THEN '[submission missing from source export]' ELSE '[no selftext]' END, '', '## Comments', '', coalesce(l, '_No comments captured._'))
  || CASE WHEN n > 80 THEN chr(10) || '_Truncated after 80 comments; ' || (n - 80) || ' additional comments omitted._' ELSE '' END, ' ' || chr(10)) || chr(10) AS text FROM th LEFT JOIN ls ON ls.link_id = th.id)"""
_SIZES = f"""{_KEPT},{_LINES},
sz AS (SELECT o.thread_id, missing, ot AS created, submission_id, length(text) AS chars FROM o JOIN rd USING (thread_id))"""


def _packs_sql(most: int, chars: int) -> str:
    return f"""WITH RECURSIVE {_SIZES},
oo AS (SELECT *, row_number() OVER (ORDER BY missing, created, submission_id) AS i FROM sz),
p(i, thread_id, chars, no, held, used) AS (SELECT i, thread_id, chars, 1, 1, chars FROM oo WHERE i = 1
  UNION ALL SELECT o.i, o.thread_id, o.chars, CASE WHEN held >= {most} OR used + o.chars > {chars} THEN no + 1 ELSE no END, CASE WHEN held >= {most} OR used + o.chars > {chars} THEN 1 ELSE held + 1 END,
    CASE WHEN held >= {most} OR used + o.chars > {chars} THEN o.chars ELSE used + o.chars END FROM p JOIN oo o ON o.i = p.i + 1)"""


_PACK_PARTS = "lpad(no::VARCHAR, greatest(3, length(no::VARCHAR))::INT, '0')"
ORACLES = {
    "q01_thread_manifest": _TREE + " SELECT 't3_' || s.id AS thread_id, s.id AS submission_id, subreddit, created_utc, score, num_comments AS num_comments_submission, coalesce(comment_count, 0) AS comment_count_reconstructed, coalesce(max_depth, 0) AS max_depth, coalesce(orphaned_root_count, 0) AS orphaned_root_count, title FROM s LEFT JOIN st ON st.link_id = s.id",
    "q02_tree_nodes": _TREE + " SELECT id, link_id, depth, children AS children_count, ancestry, orphaned AS orphaned_parent_comment_id FROM nodes",
    "q03_orphan_threads": f"WITH {_BASE}, f AS (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY id) AS r, count(*) OVER (PARTITION BY link_id) AS n FROM c WHERE link_id NOT IN (SELECT id FROM s)) SELECT 't3_' || link_id AS thread_id, subreddit, created_utc, n AS comments FROM f WHERE r = 1",
    "q04_corpus_summary": f"WITH {_BASE} SELECT (SELECT count(*) FROM s) AS threads, count(*) AS comments, count(*) FILTER (link_id IN (SELECT id FROM s)) AS thread_comments, count(DISTINCT link_id) FILTER (link_id NOT IN (SELECT id FROM s)) AS orphan_threads, count(*) FILTER (link_id NOT IN (SELECT id FROM s)) AS orphan_comments FROM c",
    "q05_orphaned_roots": f"WITH {_BASE} SELECT c.id, c.link_id, c.parent_comment_id FROM c LEFT JOIN c p ON p.link_id = c.link_id AND p.id = c.parent_comment_id WHERE c.parent_comment_id IS NOT NULL AND p.id IS NULL",
    "q06_dedupe_submissions": f"WITH {_BASE} SELECT id, rec_no, subreddit, title, md5(selftext) AS text_md5, author, score, over_18 FROM s",
    "q07_normalize_ids": f"WITH {_BASE} SELECT rec_no, id, link_id, parent_kind, parent_comment_id, parent_submission_id FROM pc",
    "q08_collapse_whitespace": f"SELECT doc_id, md5({_flat('text')}) AS md5, length({_flat('text')}) AS chars FROM documents",
    "q09_passages": f"WITH RECURSIVE {_passages('documents', 'doc_id').lstrip()} SELECT doc_id, passage FROM pas",
    "q10_sentences": f"SELECT doc_id, len(list_filter(string_split(regexp_replace({_flat('text')}, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')) AS sentences FROM documents",
    "q11_quote_categories": _QUOTES + " SELECT thread_id, comment_id, source_type, passage_no, array_to_string(categories, '|') AS categories FROM q",
    "q13_quote_candidates": _QUOTES + f""", r AS (SELECT row_number() OVER () AS rid, * FROM (SELECT *, unnest(categories) AS category FROM q)),
      g AS (SELECT rid, generate_subscripts(l, 1) AS k, unnest(l) AS x FROM (SELECT rid, {_SIGNALS} AS l FROM r)),
      u AS (SELECT rid, string_agg(x, '|' ORDER BY k) AS signals FROM (SELECT rid, arg_min(x, k) AS x, min(k) AS k FROM g GROUP BY rid, lower(x)) GROUP BY rid)
      SELECT concat_ws(':', thread_id, coalesce(comment_id, 'submission'), category, substr(md5(passage || '‖' || category), 1, 12)) AS quote_id, source_type, category,
      CASE WHEN has_first_person THEN 1.0 ELSE 0 END + CASE WHEN len(categories) > 1 THEN 0.5 ELSE 0 END + CASE WHEN length(passage) >= 40 THEN 0.25 ELSE 0 END + CASE WHEN has_visual THEN 0.25 ELSE 0 END::DOUBLE AS quote_strength,
      signals, md5(passage) AS passage_md5 FROM r JOIN u USING (rid)""",
    "q14_category_counts": _QUOTES + " SELECT category, source_type, count(*) AS quotes, count(DISTINCT thread_id) AS threads FROM (SELECT *, unnest(categories) AS category FROM q) GROUP BY 1, 2",
    "q15_state_scores": _STATES + " SELECT thread_id, source_kind, created_utc, array_to_string(core_ids, '|') AS core_ids, array_to_string(adjacent_ids, '|') AS adjacent_ids, core_score::DOUBLE AS core_score, adjacent_score::DOUBLE AS adjacent_score, score, qualifies, is_priority, is_near_miss FROM x",
    "q16_slice_matched": _STATES + " SELECT thread_id, title, created_utc, score FROM x WHERE qualifies",
    "q17_priority": _STATES + " SELECT thread_id, score FROM x WHERE is_priority",
    "q18_near_miss": _STATES + " SELECT thread_id, len(core_ids)::INT AS core, len(adjacent_ids)::INT AS adjacent, score FROM x WHERE is_near_miss ORDER BY core DESC, adjacent DESC, score DESC, thread_id LIMIT 25",
    "q19_state_counts": _STATES + " SELECT 'core' AS tier, id, count(*) AS threads FROM (SELECT unnest(core_ids) AS id FROM x WHERE qualifies) GROUP BY ALL UNION ALL SELECT 'adjacent', id, count(*) FROM (SELECT unnest(adjacent_ids) AS id FROM x WHERE qualifies) GROUP BY ALL",
    "q20_cooccurrence": _STATES + ", y AS (SELECT thread_id, unnest(core_ids) AS id FROM x WHERE qualifies) SELECT a.id AS state_a, b.id AS state_b, count(*) AS threads FROM y a JOIN y b ON a.thread_id = b.thread_id AND a.id < b.id GROUP BY 1, 2",
    "q21_quotes_by_forum": _QUOTES + " SELECT lower(f.subreddit) AS forum, count(*) AS passages, sum(len(categories))::BIGINT AS quotes FROM q JOIN src f ON f.thread_id = q.thread_id AND f.comment_id IS NOT DISTINCT FROM q.comment_id AND f.n = q.n GROUP BY 1",
    "q22_matched_terms": f"WITH RECURSIVE {_KEPT},{_SOURCES},{_HITS} SELECT thread_id, state_id, string_agg(term, '|' ORDER BY rank) AS terms FROM kt WHERE rank <= 8 GROUP BY 1, 2",
    "q23_sample_filter": f"WITH RECURSIVE {_KEPT}, n AS (SELECT link_id AS id, count(*) AS comment_count, bool_or(regexp_matches(body, '(?i)\\bear\\b|sleep')) AS hit FROM k GROUP BY 1) SELECT 't3_' || s.id AS thread_id, subreddit, created_utc, score, comment_count FROM s JOIN n USING (id) WHERE lower(subreddit) IN ('jawclub', 'quietears', 'nightring') AND created_utc >= 1199923200 AND created_utc < 1893456000 AND comment_count >= 2 AND coalesce(score, 0) >= -1000000000 AND (hit OR regexp_matches(title || chr(10) || selftext, '(?i)\\bear\\b|sleep'))",
    "q24_sample_events": "SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1",
    "q25_evidence_status": f"""WITH RECURSIVE {_KEPT},{_SOURCES},
      tt AS (SELECT thread_id, string_agg(lower({_flat('text')}), ' ' ORDER BY a, b) AS t FROM pl WHERE {_flat('text')} <> '' GROUP BY 1)
      SELECT evidence_id, e.thread_id, CASE WHEN o.thread_id IS NULL THEN 'unknown_thread' WHEN {_flat('quote')} = '' OR contains(coalesce(t, ''), lower({_flat('quote')})) THEN 'valid' ELSE 'quote_mismatch' END AS status
      FROM evidence_refs e LEFT JOIN o ON o.thread_id = e.thread_id LEFT JOIN tt ON tt.thread_id = e.thread_id""",
    "q27_evidence_walk": "SELECT '$.report.items[0].ref' AS path, thread_id, submission_id, array_to_string(list_sort(list_filter([CASE WHEN submission_id IS NULL THEN 'submission_id' END, CASE WHEN comment_id IS NULL THEN 'comment_id' END, CASE WHEN subreddit IS NULL THEN 'subreddit' END, CASE WHEN quote IS NULL THEN 'quote' END], lambda x: x IS NOT NULL)), '|') AS missing_keys FROM evidence_refs WHERE thread_id IS NOT NULL",
    "q28_packs": _packs_sql(25, 120_000) + " SELECT thread_id, no AS pack_no FROM p",
    "q28_pack_manifest": _packs_sql(5, 45_000) + f""", g AS (SELECT no, count(*) AS n, sum(chars)::BIGINT AS c, string_agg(thread_id, ',' ORDER BY i) AS ids FROM p GROUP BY 1)
      SELECT no AS pack_no, 'pack_' || {_PACK_PARTS} AS pack_id, n AS thread_count, c AS text_chars, length({_PACK_PARTS}) + length(n::VARCHAR) + length(c::VARCHAR) + 36 + c + 4 + 7 * n AS char_count, ids AS thread_ids FROM g""",
    "q29_thread_text": f"WITH RECURSIVE {_KEPT}, bt AS (SELECT link_id, string_agg(body, chr(10) ORDER BY sp) AS t FROM k WHERE body <> '' GROUP BY 1), x AS (SELECT th.id, concat_ws(chr(10), nullif(title, ''), nullif(selftext, ''), t) AS text FROM th LEFT JOIN bt ON bt.link_id = th.id) SELECT id, md5(text) AS text_md5, length(text) AS chars FROM x",
    "q30_comment_lines": _TREE + f" SELECT link_id, id, md5(repeat('  ', depth) || '- comment_id: `' || id || '` | author: `' || coalesce(author, 'unknown') || '` | score: `' || {_VALUE.format('score')} || '` | depth: `' || depth || '`' || chr(10) || repeat('  ', depth) || '  ' || CASE WHEN body = '' THEN '[deleted/empty]' ELSE body END) AS line_md5 FROM nodes",
    "q31_next_batch": f"WITH RECURSIVE {_KEPT} SELECT thread_id FROM o WHERE thread_id NOT IN (SELECT thread_id FROM evidence_refs WHERE thread_id IS NOT NULL) ORDER BY missing, ot, submission_id LIMIT 5",
    "q33_registry_changes": "SELECT CASE WHEN o_orderkey % 10 = 3 THEN 'new' WHEN o_orderkey % 10 = 5 AND coalesce(o_orderstatus, '') <> 'X' THEN 'changed' ELSE 'unchanged' END AS status, count(*) AS orders, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1",
    "q34_orders_as_threads": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, count(l_orderkey) AS items, coalesce(max(l_linenumber) - 1, 0) AS deepest, count(*) FILTER (l_linenumber = 1) AS first_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2",
    "q35_orders_without_items": "SELECT 't3_' || o_orderkey AS thread_id, o_orderpriority, count(*) AS comments FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2",
    "q36_variant_props": "SELECT event_type, sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum, count(*) FILTER (TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS k_missing FROM events GROUP BY 1",
    "q37_dedupe_comments": f"WITH {_BASE} SELECT id, rec_no, link_id, author, md5(body) AS body_md5, score FROM c",
    "q39_full_manifest": _TREE.replace(_BASE, _KEPT) + " SELECT 't3_' || th.id AS thread_id, th.id AS submission_id, subreddit, created_utc, score, num_comments AS num_comments_submission, coalesce(comment_count, 0) AS comment_count_reconstructed, coalesce(max_depth, 0) AS max_depth, coalesce(orphaned_root_count, 0) AS orphaned_root_count, title, subreddit || CASE WHEN missing THEN '__orphan__' ELSE '__' END || th.id || '.md' AS markdown_path FROM th LEFT JOIN st ON st.link_id = th.id",
    "q40_slice_manifest": _STATES + f",{_HITS}, al AS (SELECT thread_id, string_agg(term, '|' ORDER BY lower(term), term) AS terms FROM (SELECT DISTINCT thread_id, term FROM kt WHERE rank <= 8) GROUP BY 1) SELECT thread_id, submission_id, source_kind, subreddit, created_utc, score, core_score::DOUBLE AS core_score, adjacent_score::DOUBLE AS adjacent_score, is_priority AS priority_qualifies, array_to_string(core_ids, '|') AS matched_core_states, array_to_string(adjacent_ids, '|') AS matched_adjacent_states, terms AS matched_terms, title, markdown_path FROM x LEFT JOIN al USING (thread_id) WHERE qualifies",
    "q41_slice_report": _STATES + """, y AS (SELECT *, row_number() OVER (ORDER BY missing, ot, submission_id) AS i FROM x WHERE qualifies),
      u AS (SELECT 'source_kind' AS section, source_kind AS key, i, 0 AS pos FROM y UNION ALL SELECT 'subreddit', subreddit, i, 0 FROM y WHERE subreddit <> ''
        UNION ALL SELECT 'core', unnest(core_ids), i, generate_subscripts(core_ids, 1) FROM y UNION ALL SELECT 'adjacent', unnest(adjacent_ids), i, generate_subscripts(adjacent_ids, 1) FROM y
        UNION ALL SELECT 'pair', least(a.id, b.id) || '|' || greatest(a.id, b.id), a.i, a.p * 100 + b.p FROM (SELECT i, unnest(core_ids) AS id, generate_subscripts(core_ids, 1) AS p FROM y) a JOIN (SELECT i, unnest(core_ids) AS id, generate_subscripts(core_ids, 1) AS p FROM y) b ON a.i = b.i AND a.p < b.p),
      g AS (SELECT section, key, count(*) AS threads, min(i * 10000 + pos) AS spot FROM u GROUP BY 1, 2)
      SELECT section, key, threads, row_number() OVER (PARTITION BY section ORDER BY threads DESC, spot)::INT AS rank FROM g
      UNION ALL SELECT 'total', 'scored', (SELECT count(*) FROM x), 1 UNION ALL SELECT 'total', 'matched', (SELECT count(*) FROM x WHERE qualifies), 2 UNION ALL SELECT 'total', 'priority', (SELECT count(*) FROM x WHERE is_priority), 3""",
    "q42_top_threads": _STATES + " SELECT thread_id, title, subreddit, score, array_to_string(core_ids, '|') AS core_ids, is_priority FROM x WHERE qualifies ORDER BY score DESC, coalesce(created_utc, 0) DESC, thread_id LIMIT 25",
    "q43_top_priority": _STATES + " SELECT thread_id, subreddit, score FROM x WHERE is_priority ORDER BY score DESC, coalesce(created_utc, 0) DESC, thread_id LIMIT 50",
    "q44_rendered_threads": f"WITH RECURSIVE {_KEPT},{_LINES} SELECT thread_id, md5(text) AS text_md5, length(text) AS chars FROM rd",
    "q45_pack_texts": _packs_sql(25, 120_000) + f""", g AS (SELECT no, '# Research Pack ' || {_PACK_PARTS} || chr(10) || chr(10) || '- threads: ' || count(*) || chr(10) || '- chars: ' || sum(p.chars)::BIGINT || chr(10) || chr(10) || rtrim(string_agg(text || chr(10) || chr(10) || '---' || chr(10), chr(10) ORDER BY i), chr(10)) || chr(10) AS text FROM p JOIN rd USING (thread_id) GROUP BY no)
      SELECT no AS pack_no, md5(text) AS text_md5, length(text) AS char_count FROM g""",
    "q46_processed_ids": f"WITH RECURSIVE {_KEPT} SELECT thread_id, min(evidence_id) AS place FROM evidence_refs JOIN o USING (thread_id) GROUP BY 1",
    "q38_thread_stats": _TREE + " SELECT link_id, comment_count, top_level_comment_count, max_depth, orphaned_root_count FROM st",
}
