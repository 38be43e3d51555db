"""Forum operators: readers, normalising, dedupe, threads, passages, states, packs, evidence."""

import json
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from threadloom.functions.text import collapse, distinct_ci, passages, to_long
from threadloom.operators import corpus, evidence, quotes, reports, states, threads
from threadloom.sources import records, sinks

POSTS = [{"id": "abc", "title": "A  b", "selftext": "x", "score": "12.5", "created_utc": 0, "created": 5, "over_18": "TRUE"}, {"name": "t3_def", "body": "from body", "score": ""}, {"title": "no id"}]
REPLIES = [
    {"id": "c1", "link_id": "t3_abc", "parent_id": "t3_abc", "body": "one", "created_utc": 10}, {"id": "c2", "link_id": "t3_abc", "parent_id": "t1_c1", "body": "two", "created_utc": 11},
    {"id": "c3", "link_id": "t3_abc", "parent_id": "t1_lost", "body": "three", "created_utc": 12}, {"id": "z1", "link_id": "t3_ghost", "parent_id": "t3_ghost", "body": "z"},
    {"id": "l1", "link_id": "abc", "parent_id": "t1_l2"}, {"id": "l2", "link_id": "abc", "parent_id": "t1_l1"}, {"id": "nolink"},
]


def write(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    return str(path)


def test_readers_agree(spark, tmp_path):
    lines = write(tmp_path / "p.jsonl", POSTS)
    (tmp_path / "a.json").write_text("\n " + json.dumps(POSTS))
    (tmp_path / "p.jsonl.zst").write_bytes(zstandard.compress(open(lines, "rb").read()))
    key = lambda path: sorted(map(str, corpus.submissions_from_raw(records.records(spark, path)).drop("ord").collect()))
    assert key(lines) == key(str(tmp_path / "a.json")) == key(str(tmp_path / "p.jsonl.zst"))
    rows = {r.id: r for r in corpus.submissions_from_raw(records.records(spark, lines)).collect()}
    assert (rows["abc"].title, rows["abc"].score, rows["abc"].created_utc, rows["abc"].over_18) == ("A b", 12, 5.0, True)
    assert (rows["def"].selftext, rows["def"].score, rows["def"].raw_keys, len(rows)) == ("from body", None, 3, 2)


def test_bad_json_fails(spark, tmp_path):
    for n, text in enumerate(("{bad\n", "3\n")):
        (tmp_path / f"b{n}.jsonl").write_text(text)
        with pytest.raises(Exception):
            records.json_records(spark, str(tmp_path / f"b{n}.jsonl")).collect()


def test_pairs_and_fingerprints(spark, tmp_path):
    names = ["d/x_posts.jsonl", "d/X_comments.zst", "d/x_comments.json", "d/y_submissions.ndjson", "d/readme.txt"]
    got = {(r.base, r.submissions_path, r.comments_path) for r in records.input_pairs(spark.createDataFrame([(n,) for n in names], "path string")).collect()}
    assert ("x", "d/x_posts.jsonl", "d/x_comments.json") in got and ("y", "d/y_submissions.ndjson", None) in got and len(got) == 3
    (tmp_path / "f").write_bytes(b"a\nb")
    row = records.file_fingerprints(spark, str(tmp_path / "f")).first()
    assert (row.bytes, row.lines) == (3, 1)


def test_threads_of_fixture(spark, tmp_path):
    posts = corpus.dedupe_submissions(corpus.submissions_from_raw(records.json_records(spark, write(tmp_path / "p", POSTS))))
    replies = corpus.dedupe_comments(corpus.comments_from_raw(records.json_records(spark, write(tmp_path / "c", REPLIES))))
    flat = threads.nodes(replies)
    got = {r.id: (r.depth, r.children_count, r.ancestry_comment_ids, r.orphaned_parent_comment_id) for r in flat.collect()}
    assert got == {"c1": (0, 1, [], None), "c2": (1, 0, ["c1"], None), "c3": (0, 0, [], "lost"), "z1": (0, 0, [], None)}
    stats = threads.thread_stats(flat)
    nested = {r.submission_id: r for r in threads.thread_records(posts, flat, stats).collect()}
    assert [c.id for c in nested["abc"].comments] == ["c1", "c2", "c3"] and nested["def"].comments is None
    summary = threads.corpus_summary(posts, replies).first().asDict()
    assert summary == {"comments": 6, "thread_comments": 5, "orphan_threads": 1, "orphan_comments": 1, "threads": 2}
    sinks.write_json_lines(threads.thread_records(posts, flat, stats), str(tmp_path / "out"))
    assert records.threads(spark, str(tmp_path / "out")).count() == 2


def test_dedupe_rules(spark):
    base = {"subreddit": "s", "title": "t", "selftext": "", "author": None, "created_utc": None, "score": None, "num_comments": None, "permalink": None, "url": None, "over_18": None, "raw_keys": 0}
    rows = [
        base | {"id": "a", "ord": 1, "author": "x"}, base | {"id": "a", "ord": 2, "score": 0},  # zero counts as empty
        base | {"id": "b", "ord": 1}, base | {"id": "b", "ord": 2},  # tie: last
        base | {"id": "c", "ord": 1, "selftext": "longer"}, base | {"id": "c", "ord": 2, "selftext": "long"},
    ]
    schema = "id string, subreddit string, title string, selftext string, author string, created_utc double, score bigint, num_comments bigint, permalink string, url string, over_18 boolean, raw_keys int, ord bigint"
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    assert {r.id: r.ord for r in corpus.dedupe_submissions(df).collect()} == {"a": 1, "b": 2, "c": 1}


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a b\x1c c\n",), (None,)], "v string")
    assert [r[0] for r in df.select(collapse(F.col("v"))).collect()] == ["a b c", ""]
    nums = spark.createDataFrame([("12.9",), (" 7 ",), ("",), ("x",), ("inf",), (None,)], "v string")
    assert [r[0] for r in nums.select(to_long(F.col("v"))).collect()] == [12, 7, None, None, None, None]
    arr = spark.createDataFrame([(["I", "i ", "", "Me", "ME"],)], "v array<string>")
    assert arr.select(distinct_ci(F.col("v"))).first()[0] == ["I", "Me"]


def fold(text):
    out = []
    for p in re.split(r"\n{2,}", text.replace("\r\n", "\n").replace("\r", "\n")):
        p = " ".join(p.split())
        if not p:
            continue
        if len(p) <= 320:
            out.append(p)
            continue
        held, size = [], 0
        for s in re.split(r"(?<=[.!?])\s+", p):
            if size + len(s) + 1 > 320 and held:
                out += [" ".join(held)] if len(" ".join(held)) >= 24 else []
                held, size = [s], len(s)
            else:
                held, size = held + [s], size + len(s) + 1
        out += [" ".join(held)] if len(" ".join(held)) >= 24 else []
    return out


def test_passages_against_fold(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
    texts = ["", "x" * 320, "x" * 321, "y" * 400 + ". Short."] + [
        "\n\n".join(" ".join(" ".join(word() for _ in range(rng.randint(1, 40))) + rng.choice(".!?") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(1, 3))) for _ in range(60)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = {r.n: r.p for r in df.select("n", passages(F.col("t")).alias("p")).collect()}
    assert all(got[n] == fold(t) for n, t in enumerate(texts))
    assert spark.createDataFrame([(None,)], "t string").select(passages(F.col("t"))).first()[0] == []


def test_quotes(spark):
    rows = [("t3_a", "a", None, "s", "u", 1, "t", 0, "submission_body", "I tried everything; nothing works and the ringing is like a whistle."), ("t3_a", "a", "c", "s", "u", 1, "", 2, "comment", "zzz")]
    df = spark.createDataFrame(rows, "thread_id string, submission_id string, comment_id string, subreddit string, author string, score int, title string, n int, source_type string, text string")
    got = {r.category: r for r in quotes.candidates(df).collect()}
    assert set(got) == {"pain_points", "failures", "real_customer_language", "visual_cues"}
    assert got["failures"].signals == ["tried", "nothing works"] and got["real_customer_language"].signals[0] == "I"
    assert got["failures"].quote_strength == 2.0


def test_states(spark):
    config = {"min_core_score": 2.0, "min_core_states": 1, "priority_core_state_groups": [["a"], ["b"]], "core_states": [{"id": "a", "weight": 3.0, "patterns": ["foo.*bar"]}, {"id": "b", "weight": 2.0, "patterns": ["baz"]}], "adjacent_states": [{"id": "c", "weight": 1.5, "patterns": ["qux"]}, {"id": "d", "patterns": ["nix"]}]}
    rows = [("t1", "a1", "Foo and bar"), ("t1", "a2", "BAZ qux"), ("t2", "a1", "foo"), ("t2", "a2", "bar baz"), ("t3", "a1", "qux nix"), ("t4", "a1", "none"), ("t5", "a1", None)]
    texts = spark.createDataFrame(rows, "thread_id string, place string, text string")
    got = {r.thread_id: r for r in states.scored(texts, config).collect()}
    assert (float(got["t1"].score), got["t1"].is_priority) == (5.53, True)  # half up
    assert (got["t2"].core_ids, got["t2"].is_priority) == (["b"], False)
    assert [k for k, r in got.items() if r.is_near_miss] == ["t3"]
    pairs = states.cooccurrence(states.scored(texts, config)).collect()
    assert [tuple(r) for r in pairs] == [("a", "b", 1)]
    terms = states.matched_terms(spark.createDataFrame([("t", "1", "Foo x bar foo y bar BAZ baz")], "thread_id string, place string, text string"), config)
    assert {r.state_id: r.terms for r in terms.collect()} == {"a": ["Foo x bar foo y bar"], "b": ["BAZ"]}


def test_sequential_packs(spark):
    df = spark.createDataFrame([(n, f"t{n}", c) for n, c in enumerate([5, 5, 20, 1, 1, 1, 10])], "thread_ord int, thread_id string, chars bigint")
    got = [r.pack_no for r in reports.sequential_packs(df, max_threads=3, max_chars=10).orderBy("thread_id").collect()]
    assert got == [1, 1, 2, 3, 3, 3, 4]


def test_changes_and_batches(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    old = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (9, "q")], "k int, v string")
    assert {r.k: r.status for r in reports.changes(now, old, ["k"], ["v"]).collect()} == {1: "unchanged", 2: "changed", 3: "unchanged", 4: "new"}
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("", 3), ("c", 4)], "thread_id string, row_ord int")
    assert [r.thread_id for r in reports.next_batch(rows, spark.createDataFrame([("a",)], "thread_id string"), 2).collect()] == ["b", "c"]


def test_sampling_ties(spark):
    df = spark.createDataFrame([("a", "S", 1.0, 5, 3, "ear"), ("b", "s", 2.0, 5, 3, "ear"), ("c", "s", None, 9, 3, "ear"), ("d", "x", 3.0, 9, 3, "ear")], "thread_ord string, subreddit string, created_utc double, score int, comment_count int, text string")
    got = reports.sample(df, subreddits=["S"], keywords=["EAR"], after=0.5, sort_by="score", descending=True)
    assert [r.thread_ord for r in got.collect()] == ["a", "b"]


def test_evidence(spark):
    payload = spark.createDataFrame([(json.dumps({"a": [{"thread_id": "t3_x", "quote": None, "deep": {"thread_id": "t3_y", "submission_id": "y", "comment_id": None, "subreddit": "s", "quote": "q"}}]}),)], "j string").select(F.parse_json("j").alias("v"))
    got = {r.path: sorted(r.missing_keys) for r in evidence.from_nodes(evidence.walk(payload)).collect()}
    assert got == {"$.a[0]": ["comment_id", "submission_id", "subreddit"], "$.a[0].deep": []}
    ev = spark.createDataFrame([(1, "t3_x", "Hello  World"), (2, "t3_x", "nope"), (3, "t3_q", "x"), (4, "t3_x", "world next"), (5, None, "x")], "evidence_id int, thread_id string, quote string")
    texts = spark.createDataFrame([("t3_x", 1, "hello world"), ("t3_x", 2, "next one")], "thread_id string, place int, text string")
    got = {r.evidence_id: r.status for r in evidence.validate(ev, spark.createDataFrame([("t3_x",)], "thread_id string"), texts).collect()}
    assert got == {1: "valid", 2: "quote_mismatch", 3: "unknown_thread", 4: "valid", 5: "unknown_thread"}


def test_quote_over_many_texts_and_windows(spark):
    words = [f"word{n}" for n in range(400)]
    texts = spark.createDataFrame([("t", n, w.upper() + "  ") for n, w in enumerate(words)], "thread_id string, place int, text string")
    ev = spark.createDataFrame([(1, "t", "Word7 word8 word9 WORD10"), (2, "t", "word7 word9"), (3, "t", " ".join(words[100:200])), (4, "t", " ".join(words))], "evidence_id int, thread_id string, quote string")
    got = {r.evidence_id: r.status for r in evidence.validate(ev, spark.createDataFrame([("t",)], "thread_id string"), texts, window=64).collect()}
    assert got == {1: "valid", 2: "quote_mismatch", 3: "valid", 4: "valid"}


def test_evidence_at_any_depth(spark):
    node = {"thread_id": "t3_z"}
    for _ in range(60):
        node = {"a": [node]}
    got = evidence.walk(spark.createDataFrame([(json.dumps(node),), (None,)], "j string").select(F.parse_json("j").alias("v"))).collect()
    assert [r.path for r in got] == ["$" + ".a[0]" * 60]


def test_sibling_keys_sort_like_times(spark):
    times = [-1e12, -5.5, -0.25, 0.0, 0.1, 3.0, 1.3e9, 1e14, 5e18]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(times)], "n int, t double").select("n", threads.sibling_key(F.col("t"), F.lit("i")).alias("k"))
    rows = df.orderBy("k").collect()
    assert [r.n for r in rows] == list(range(len(times))) and {len(r.k) for r in rows} == {threads.KEY_SIGNS + 1}


def test_rendered_threads(spark):
    posts = spark.createDataFrame([("a", "s", "Title", "", None, 5.0, 1, 2, None, None, None)], "id string, subreddit string, title string, selftext string, author string, created_utc double, score bigint, num_comments bigint, permalink string, url string, over_18 boolean")
    replies = spark.createDataFrame([("c1", "a", None, 1.0, "u", 3, "one", "s"), ("c2", "a", "c1", 2.0, None, None, "", "s"), ("z1", "ghost", None, 1.5, "u", 3, "x", "g")], "id string, link_id string, parent_comment_id string, created_utc double, author string, score bigint, body string, subreddit string")
    all_ = threads.with_orphans(posts, replies)
    got = {r.id: r.text for r in threads.rendered(all_, threads.nodes(replies)).collect()}
    assert got["a"].startswith("# Title\n\n- thread_id: `t3_a`\n") and "- created_utc: `5.0`\n" in got["a"]
    assert got["a"].endswith("## Comments\n\n- comment_id: `c1` | author: `u` | score: `3` | depth: `0`\n  one\n\n  - comment_id: `c2` | author: `unknown` | score: `None` | depth: `1`\n    [deleted/empty]\n")
    assert got["ghost"].startswith("# [missing submission]") and "- missing_submission: `True`" in got["ghost"]
    short = {r.id: r.text for r in threads.rendered(all_, threads.nodes(replies), 1).collect()}
    assert short["a"].endswith("  one\n\n_Truncated after 1 comments; 1 additional comments omitted._\n")


def test_registry_rules(spark):
    status = lambda *s: spark.createDataFrame([(x,) for x in s], "status string")
    assert reports.registry_plan(status("new", "unchanged")) and not reports.registry_plan(status("unchanged"))
    assert reports.registry_plan(status("unchanged"), complete=False) and reports.registry_plan(status("changed"), allow_changed=True)
    with pytest.raises(ValueError):
        reports.registry_plan(status("changed"))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, v string")
    assert reports.signature(rows, ["n", "v"]) == reports.signature(rows.orderBy(F.desc("n")), ["n", "v"]) != reports.signature(rows.limit(1), ["n", "v"])


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, "k")
    sinks.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), path, "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_command_line(spark, tmp_path):
    from threadloom.__main__ import main

    root = tmp_path / "in"
    root.mkdir()
    write(root / "x_posts.jsonl", POSTS)
    write(root / "x_comments.jsonl", REPLIES)
    out = str(tmp_path / "out")
    assert main(["update", "--input-root", str(root), "--out", out], spark) == 0
    assert main(["update", "--input-root", str(root), "--out", out], spark) == 0
    assert main(["extract-quotes", "--corpus", out, "--out", str(tmp_path / "quotes")], spark) == 0
    assert main(["build-packs", "--corpus", out, "--out", str(tmp_path / "packs")], spark) == 0
    assert main(["sample", "--corpus", out, "--out", str(tmp_path / "sample"), "--keyword", "one", "--min-comments", "1"], spark) == 0
    assert main(["build-slice", "--corpus", out, "--out", str(tmp_path / "slice")], spark) == 0
    assert spark.read.json(str(tmp_path / "sample")).select("thread_id").first()[0] == "t3_abc"
    assert spark.read.csv(out + "/manifest", header=True).count() == 3
    proof = {"thread_id": "t3_abc", "submission_id": "abc", "comment_id": "c1", "subreddit": "s", "quote": "ONE two"}
    (tmp_path / "e.json").write_text(json.dumps({"x": [proof]}))
    assert main(["validate", "--json", str(tmp_path / "e.json"), "--corpus", out, "--out", str(tmp_path / "report"), "--strict"], spark) == 0
