"""Orphan references, hierarchies, id rules."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions.ids import contributor, first_rows, normal_id
from threadloom.operators import hierarchy, orphans

COMMENTS = "rec_no bigint, id string, link_id string, parent_id string, parent_comment_id string, batch_no int, received_at timestamp, field string, target string"


def comments(spark, rows):
    import datetime

    day = datetime.datetime(2012, 1, 5)
    return spark.createDataFrame([(n, *r, day, "x", "y") for n, r in enumerate(rows)], COMMENTS)


def test_normal_ids(spark):
    df = spark.createDataFrame([(" T1_AbC ",), ("t3_x",), ("",), (None,), ("plain",)], "v string")
    assert [r[0] for r in df.select(normal_id("v")).collect()] == ["abc", "x", None, None, "plain"]


def test_contributors(spark):
    df = spark.createDataFrame([("/u/Ann ",), ("u/ann",), ("[Deleted]",), ("",), (None,), ("ulf",)], "v string")
    assert [r[0] for r in df.select(contributor("v")).collect()] == ["ann", "ann", None, None, None, "ulf"]


def test_first_rows_ignore_null_keys(spark):
    df = spark.createDataFrame([(2, "a", 9), (1, "a", 8), (3, None, 7)], "rec_no int, id string, x int")
    assert [tuple(r) for r in first_rows(df, "id", "rec_no", ["x"]).collect()] == [("a", 8)]


def found(spark, comment_rows, posts, removals):
    c = comments(spark, comment_rows)
    s = spark.createDataFrame(posts, "rec_no bigint, id string, batch_no int, status string")
    r = spark.createDataFrame(removals, "fullname string")
    return {(x.owner, x.field, x.status) for x in orphans.comment_references(c, s, r).collect()}


def test_orphan_kinds(spark):
    rows = [
        ("c1", "t3_p1", "t3_p1", None, 0),  # fine
        ("c2", "p9", "t1_c1", None, 0),  # missing post
        ("c3", "P2 ", "t1_zz", None, 0),  # late post, missing parent
        ("c4", "p1", None, "t1_C5", 0),  # parent comes later
        ("c5", "p3", "p3", None, 2),  # removed post
        ("c1", "p9", None, "gone", 5),  # a later row of c1 does not count
        (None, "p9", None, None, 1),
        ("c6", None, None, None, 1),
    ]
    got = found(spark, rows, [(1, "p1", 0, "s"), (2, "t3_p2", 3, "s"), (3, "p3", 0, "s"), (4, "p1", 9, "s")], [("T3_p3",), ("t1_p1",), (None,), ("odd",)])
    assert got == {("c2", "link_id", "missing"), ("c3", "link_id", "late"), ("c3", "parent_comment_id", "missing"), ("c4", "parent_comment_id", "late"), ("c5", "link_id", "removed")}


def test_orphans_of_empty_tables(spark):
    assert found(spark, [], [], []) == set()
    assert found(spark, [("a", "b", None, None, 0)], [], []) == {("a", "link_id", "missing")}


def test_full_filter_changes_nothing(spark):
    refs = spark.createDataFrame([(f"o{i}", "f", f"k{i}", 0, "d") for i in range(300)], "owner string, field string, target string, batch_no int, period string")
    parents = spark.createDataFrame([("f", f"k{i}", 0) for i in range(0, 300, 2)], "field string, target string, first_batch int")
    none = spark.createDataFrame([], "field string, target string")
    small = {r.owner for r in orphans.orphan_references(refs, parents, none, filter_bits=64).collect()}
    assert small == {r.owner for r in orphans.orphan_references(refs, parents, none).collect()} == {f"o{i}" for i in range(1, 300, 2)}


def brute(parent):
    out = {}
    for v in parent:
        seen, x = [], v
        while x is not None and x not in seen:
            seen.append(x)
            x = parent[x]
        out[v] = (len(seen) - 1, seen[-1], seen[::-1]) if x is None else (-1, min(seen[seen.index(x):]), None)
    return out


@pytest.mark.parametrize("kind", ["chain", "cycles", "forest"])
def test_hierarchy_against_brute_force(spark, kind):
    rng, n = random.Random(4), 150
    make = {"chain": lambda i: i - 1 if i else None, "cycles": lambda i: rng.randrange(n), "forest": lambda i: rng.choice([None, rng.randrange(i)]) if i else None}[kind]
    parent = {f"n{i}": (None if (p := make(i)) is None else f"n{p}") for i in range(n)}
    df = spark.createDataFrame([(*x, 1) for x in parent.items()], "node string, parent string, depth int")
    got = {r.node: (r.depth, r.root, r.path) for r in hierarchy.resolve(df, with_paths=True, spacing=16).collect()}
    assert got == brute(parent)


def test_hierarchy_edge_cases(spark):
    empty = spark.createDataFrame([], "node string, parent string")
    assert hierarchy.resolve(empty).count() == 0
    rows = [("a", "a"), ("b", "a"), ("c", "nowhere"), ("d", "c"), ("d", "c"), (None, "c"), ("", "d")]
    got = {r.node: (r.depth, r.root) for r in hierarchy.resolve(spark.createDataFrame(rows, "node string, parent string")).collect()}
    assert got == {"a": (-1, "a"), "b": (-1, "a"), "c": (0, "c"), "d": (1, "c"), "": (2, "c")}


def test_descendants_on_and_below_loops(spark):
    rng = random.Random(5)
    parent = {f"n{i}": f"n{rng.randrange(40)}" for i in range(40)} | {f"c{i}": f"c{(i + 1) % 11}" for i in range(11)} | {"self": "self", "below": "self", "root": None, "leaf": "root"}
    rows = [(v, "t3_p", None, None if p is None else f"t1_{p}", 0) for v, p in parent.items()]
    want = set()
    for v in parent:
        x, seen = parent[v], [v]
        while x is not None and x not in seen:
            want.add((x, v, len(seen)))
            seen.append(x)
            x = parent[x]
    got = [tuple(r) for r in hierarchy.comment_descendants(comments(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {x for x in want if "below" in x} == {("self", "below", 1)}


def test_descendants(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "node string, parent string")
    paths = hierarchy.resolve(df, with_paths=True)
    assert {tuple(r) for r in hierarchy.descendants(paths).collect()} == {("a", "b", 1), ("b", "c", 1), ("a", "c", 2)}
