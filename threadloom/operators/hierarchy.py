"""Parent-child links to full hierarchies, by splitters.

A hash of the id makes about one node in ``spacing`` a *splitter*; roots are
splitters too.  Every node walks to its next splitter (pointer doubling that
stops there, so it takes about log2 of the largest gap in rounds), the much
smaller graph of splitters is solved by doubling, and both parts are put
together.  Walks that meet no splitter run into a cycle without any; they are
few and solved on their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import first_rows, normal_id, parent_comment
from ..session import Scratch

SPACING = 8


def _double(walk: DataFrame, scratch: Scratch, name: str, with_paths: bool, stop_early: bool) -> tuple[DataFrame, int]:
    """Pointer doubling over ``node, ptr, steps, least, done[, seg]``.

    Rows that are done keep their pointer.  Ends when a round finishes no more
    walks: then each unfinished one is bound to a cycle, because the nodes of a
    longer finite walk would have had to finish in that round.  Without
    ``stop_early`` the unfinished walks go on until they have surely gone
    round their cycle.  Returns the table and the number of unfinished rows.
    """
    walk = scratch.save(walk, name)
    counts = walk.groupBy("done").count().collect()
    todo = sum(r["count"] for r in counts if not r["done"])
    length, settled = 1, False
    while todo:
        if settled and (stop_early or length >= 2 * todo):
            break
        ahead = [F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("steps").alias("steps2"), F.col("least").alias("least2"), F.col("done").alias("done2")]
        ahead += [F.col("seg").alias("seg2")] if with_paths else []
        source = walk if not settled else walk.where("not done")
        moved = (
            walk.where("not done")
            .join(source.select(*ahead), "ptr")
            .select(
                "node",
                F.col("ptr2").alias("ptr"),
                (F.col("steps") + F.col("steps2")).alias("steps"),
                F.least("least", "least2").alias("least"),
                F.col("done2").alias("done"),
                *([F.concat("seg", "seg2").alias("seg")] if with_paths and not settled else [F.col("seg")] if with_paths else []),
            )
        )
        walk = scratch.save(walk.where("done").unionByName(moved), name)
        left = walk.where("not done").count()
        settled = settled or left == todo
        length, todo = length * 2, left
    return walk, todo


def resolve(edges: DataFrame, *, spacing: int = SPACING, with_paths: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Depth and root of every node; with ``with_paths`` also the ids from root to node.

    ``edges``: ``node, parent`` strings, one row per node (repeated nodes keep
    the smallest parent; null nodes are left out).  A parent that is null or
    itself no node makes the node a root.  Nodes on or below a loop get depth
    -1, the smallest id on the loop as root and a null path.  An empty table
    gives an empty result; other columns are ignored.
    """
    scratch = scratch or Scratch(edges.sparkSession, "hierarchy")
    nodes = edges.where("node is not null").groupBy("node").agg(F.min("parent").alias("parent"))
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    # nodes without a parent stay out of the join: they would all meet in one task
    linked = nodes.where("parent is not null").join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent"))
    nodes = scratch.save(linked.unionByName(nodes.where("parent is null").select("node", "parent")), "nodes")
    return resolve_known(nodes, spacing=spacing, with_paths=with_paths, scratch=scratch)


def resolve_known(nodes: DataFrame, *, spacing: int, with_paths: bool, scratch: Scratch) -> DataFrame:
    """As ``resolve``, for nodes whose parent is null or a node."""
    is_splitter = lambda c: F.pmod(F.xxhash64(F.lit("splitter"), F.col(c)), F.lit(spacing)) == 0
    seg = [F.array("node").alias("seg")] if with_paths else []
    # 1. every node one step up; a walk ends at a splitter or a root
    roots = nodes.where("parent is null").select(F.col("node").alias("ptr"), F.lit(True).alias("top"))
    step = (
        nodes.where("parent is not null")
        .select("node", F.col("parent").alias("ptr"), F.lit(1).cast("long").alias("steps"), F.col("node").alias("least"), *seg)
        .join(roots, "ptr", "left")
        .select("node", "ptr", "steps", "least", (F.coalesce("top", F.lit(False)) | is_splitter("ptr")).alias("done"), *(["seg"] if with_paths else []))
    )
    walk, stuck = _double(step, scratch, "walk", with_paths, stop_early=True)

    path = lambda c: [c] if with_paths else []
    no_path = F.lit(None).cast("array<string>").alias("path")
    up = lambda c: F.reverse(F.col(c))

    # 2. where walks end for good: roots, and nodes bound to loops without a splitter
    out = nodes.where("parent is null").select(
        "node", F.lit(0).cast("long").alias("depth"), F.col("node").alias("root"), *path(F.array("node").alias("path"))
    )
    if stuck:
        rest, _ = _double(walk.where("not done").drop("seg"), scratch, "stuck", False, stop_early=False)
        out = scratch.save(out.unionByName(_looped(rest).select("*", *path(no_path))), "ends")
    ends = out.select(F.col("node").alias("ptr"), F.col("depth").alias("depth2"), F.col("root").alias("root2"), *path(F.col("path").alias("path2")))

    # 3. the reduced graph: splitters, each pointing to its next splitter
    reduced = (
        walk.where("done").where(is_splitter("node")).drop("done")
        .join(ends.select("ptr", F.lit(True).alias("end")), "ptr", "left")
        .select("node", "ptr", "steps", "least", F.coalesce("end", F.lit(False)).alias("done"), *(["seg"] if with_paths else []))
    )
    solved, looping = _double(reduced, scratch, "reduced", with_paths, stop_early=False)
    joined = lambda left: left.join(ends, "ptr").select(
        "node",
        F.when(F.col("depth2") < 0, F.lit(-1)).otherwise(F.col("depth2") + F.col("steps")).cast("long").alias("depth"),
        F.col("root2").alias("root"),
        *path(F.concat("path2", up("seg")).alias("path")),
    )
    anchors = joined(solved.where("done"))
    if looping:
        anchors = anchors.unionByName(_looped(solved.where("not done")).select("*", *path(no_path)))
    anchors = scratch.save(anchors, "anchors")

    # 4. all other nodes hang on a splitter or an end
    ends = ends.unionByName(
        anchors.select(F.col("node").alias("ptr"), F.col("depth").alias("depth2"), F.col("root").alias("root2"), *path(F.col("path").alias("path2")))
    )
    return joined(walk.where("done").where(~is_splitter("node"))).unionByName(anchors).unionByName(out)


def _looped(walk: DataFrame) -> DataFrame:
    """Loop of each walk that has surely gone round one: it stands on the loop, whose nodes know its least id."""
    on_loop = walk.select(F.col("node").alias("ptr"), F.col("least").alias("root"))
    return walk.select("node", "ptr").join(on_loop, "ptr").select("node", F.lit(-1).cast("long").alias("depth"), "root")


def descendants(paths: DataFrame) -> DataFrame:
    """All (ancestor, descendant, distance) pairs of nodes with a path.

    The output is as large as the sum of the depths; it is made by exploding
    each node's own path, so no join is needed and no task gathers a subtree.
    """
    return (
        paths.where("path is not null and depth > 0")
        .select(F.col("node").alias("descendant"), "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth").cast("int"))).alias("pos", "ancestor"))
        .select("ancestor", "descendant", (F.col("depth") - F.col("pos")).alias("distance"))
    )


def loop_descendants(looped: DataFrame, scratch: Scratch) -> DataFrame:
    """As ``descendants``, for the nodes on or below a loop (``node, parent``), which have no path.

    All nodes of a loop are descendants of each other, by the steps from one
    to the other; no node is its own.  Each round doubles the steps looked up;
    it ends with the round that meets nobody new.
    """
    jump = looped.select("node", F.col("parent").alias("ptr"))
    pairs = jump.select(F.col("ptr").alias("ancestor"), F.col("node").alias("descendant"), F.lit(1).cast("long").alias("distance")).where("ancestor <> descendant")
    pairs, steps = scratch.save(pairs, "loop-pairs"), 1
    known, found = 0, pairs.count()
    while found > known:
        ahead = pairs.select(F.col("descendant").alias("ptr"), "ancestor", (F.col("distance") + steps).alias("distance"))
        more = jump.join(ahead, "ptr").select("ancestor", F.col("node").alias("descendant"), "distance").where("ancestor <> descendant")
        pairs = scratch.save(pairs.unionByName(more).groupBy("ancestor", "descendant").agg(F.min("distance").alias("distance")), "loop-pairs")
        known, found = found, pairs.count()
        jump = scratch.save(jump.join(jump.select(F.col("node").alias("ptr"), F.col("ptr").alias("ptr2")), "ptr").select("node", F.col("ptr2").alias("ptr")), "loop-jumps")
        steps *= 2
    return pairs


def comment_edges(comments: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, parent`` of the forum's comments; a parent counts only with the same ``link_id``."""
    rows = comments.select(
        normal_id("id").alias("node"),
        "rec_no",
        normal_id("link_id").alias("link"),
        parent_comment(F.col("link_id"), F.col("parent_id"), F.col("parent_comment_id")).alias("parent"),
    )
    firsts = scratch.save(first_rows(rows, "node", "rec_no", ["link", "parent"]), "firsts")
    known = firsts.select(F.col("node").alias("parent"), F.col("link").alias("parent_link"))
    joined = firsts.where("parent is not null").join(known, "parent", "left").select(
        "node", F.when(F.col("parent_link") == F.col("link"), F.col("parent")).alias("parent")
    )
    return scratch.save(joined.unionByName(firsts.where("parent is null").select("node", "parent")), "nodes")


def comment_hierarchy(comments: DataFrame, *, with_paths: bool = False, spacing: int = SPACING) -> DataFrame:
    """``resolve`` over the forum's comments: ``node, depth, root[, path]``."""
    scratch = Scratch(comments.sparkSession, "hierarchy")
    return resolve_known(comment_edges(comments, scratch), spacing=spacing, with_paths=with_paths, scratch=scratch)


def comment_descendants(comments: DataFrame, *, spacing: int = SPACING) -> DataFrame:
    """Every ``ancestor, descendant, distance`` of the forum's comments, those on and below loops included."""
    scratch = Scratch(comments.sparkSession, "hierarchy")
    edges = comment_edges(comments, scratch)
    nodes = resolve_known(edges, spacing=spacing, with_paths=True, scratch=scratch)
    looped = scratch.save(nodes.where("depth < 0").select("node").join(edges, "node"), "looped")
    return descendants(nodes).unionByName(loop_descendants(looped, scratch))
