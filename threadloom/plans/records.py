"""Queries of the core's record operators (problems 2 and 7) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy, orphans
from ..session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = orphans.comment_references(table(spark, sf_dir, "comments"), table(spark, sf_dir, "submissions"), table(spark, sf_dir, "removals"))
    return found.select(F.col("owner").alias("comment_id"), F.col("field").alias("ref_field"), "status", "period")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = orphans.comment_references(table(spark, sf_dir, "comments"), table(spark, sf_dir, "submissions"), table(spark, sf_dir, "removals"))
    return orphans.orphan_report(found).withColumnRenamed("field", "ref_field")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = hierarchy.comment_hierarchy(table(spark, sf_dir, "comments"))
    return nodes.where("depth <> 0").select(F.col("node").alias("comment_id"), F.col("root").alias("root_id"), F.col("depth").cast("int").alias("depth"))


def p7_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = hierarchy.comment_hierarchy(table(spark, sf_dir, "comments"), with_paths=True)
    return nodes.select(F.col("node").alias("comment_id"), F.col("root").alias("root_id"), F.col("depth").cast("int").alias("depth"), F.array_join("path", ">").alias("path"))


def p7_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = hierarchy.comment_hierarchy(table(spark, sf_dir, "comments"), with_paths=True)
    return hierarchy.descendants(nodes).groupBy("ancestor").agg(F.count("*").alias("descendants"), F.max("distance").cast("int").alias("height"))


def p7_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The descendants themselves, of nodes in trees and on or below loops; ``p7_descendants`` counts those in trees."""
    return hierarchy.comment_descendants(table(spark, sf_dir, "comments")).select("ancestor", "descendant", F.col("distance").cast("int").alias("distance"))


#: Normal form of ids and first rows, shared by the SQL below.
_NORM = "regexp_replace(lower(trim({0}, chr(32)||chr(9)||chr(10)||chr(13)||chr(160))), '^t[13]_', '')"
_FIRSTS = f"""
raw_c AS (SELECT nullif({_NORM.format('id')}, '') AS id, rec_no, batch_no, strftime(received_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS period,
    {_NORM.format('link_id')} AS link,
    coalesce(nullif({_NORM.format('parent_comment_id')}, ''),
      CASE WHEN lower(trim(parent_id)) LIKE 't3\\_%' ESCAPE '\\' OR {_NORM.format('parent_id')} = {_NORM.format('link_id')} THEN NULL
      ELSE nullif({_NORM.format('parent_id')}, '') END) AS parent FROM comments),
c AS (SELECT * FROM raw_c WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rec_no) = 1)"""
_ORPHANS = f"""WITH {_FIRSTS},
s AS (SELECT {_NORM.format('id')} AS id, arg_min(batch_no, rec_no) AS b FROM submissions GROUP BY 1),
gone AS (SELECT DISTINCT CASE WHEN lower(trim(fullname)) LIKE 't3%' THEN 'link_id' ELSE 'parent_comment_id' END AS field, {_NORM.format('fullname')} AS id
  FROM removals WHERE regexp_matches(lower(trim(fullname)), '^t[13]_')),
refs AS (SELECT id AS owner, batch_no, period, 'link_id' AS field, nullif(link, '') AS target FROM c
  UNION ALL SELECT id, batch_no, period, 'parent_comment_id', parent FROM c),
parents AS (SELECT 'link_id' AS field, id, b FROM s UNION ALL SELECT 'parent_comment_id', id, batch_no FROM c),
found AS (SELECT owner, r.field, target, period,
  CASE WHEN g.id IS NOT NULL THEN 'removed' WHEN p.id IS NULL THEN 'missing' WHEN p.b > r.batch_no THEN 'late' END AS status
  FROM refs r LEFT JOIN parents p ON p.field = r.field AND p.id = r.target LEFT JOIN gone g ON g.field = r.field AND g.id = r.target
  WHERE target IS NOT NULL)"""
_TREE = f"""WITH RECURSIVE {_FIRSTS},
e AS (SELECT c.id, p.id AS parent FROM c LEFT JOIN c p ON p.id = c.parent AND p.link = c.link),
t(id, root, depth, path) AS (SELECT id, id, 0, id FROM e WHERE parent IS NULL
  UNION ALL SELECT e.id, t.root, t.depth + 1, t.path || '>' || e.id FROM e JOIN t ON e.parent = t.id)"""
#: Loops: from each unreached node walk up while counting; the least id met after as many steps as there are such nodes.
_LOOPS = """,
u AS (SELECT e.id, e.parent FROM e WHERE e.id NOT IN (SELECT id FROM t)),
w(id, here, seen) AS (SELECT id, parent, [id] FROM u UNION ALL SELECT w.id, u.parent, list_append(w.seen, w.here) FROM w JOIN u ON u.id = w.here WHERE NOT list_contains(w.seen, w.here)),
l AS (SELECT id, list_min(seen[list_position(seen, here):]) AS root FROM w WHERE list_contains(seen, here))"""

QUERIES = {"p2_found": p2_found, "p2_report": p2_report, "p7_found": p7_found, "p7_paths": p7_paths, "p7_descendants": p7_descendants, "p7_members": p7_members}

ORACLES = {
    "p2_found": _ORPHANS + " SELECT owner AS comment_id, field AS ref_field, status, period FROM found WHERE status IS NOT NULL",
    "p2_report": _ORPHANS + " SELECT field AS ref_field, status, period, count(*) AS \"references\", count(DISTINCT target) AS targets FROM found WHERE status IS NOT NULL GROUP BY 1, 2, 3",
    "p7_found": _TREE + _LOOPS + " SELECT id AS comment_id, root AS root_id, CAST(depth AS INTEGER) AS depth FROM t WHERE depth > 0 UNION ALL SELECT id, root, -1 FROM l",
    "p7_paths": _TREE + _LOOPS + " SELECT id AS comment_id, root AS root_id, CAST(depth AS INTEGER) AS depth, path FROM t UNION ALL SELECT id, root, -1, NULL FROM l",
    "p7_descendants": _TREE + ", x AS (SELECT unnest(string_split(path, '>')) AS ancestor, unnest(range(depth, -1, -1)) AS distance FROM t) SELECT ancestor, count(*) AS descendants, CAST(max(distance) AS INTEGER) AS height FROM x WHERE distance > 0 GROUP BY 1",
    "p7_members": _TREE + _LOOPS + """,
x AS (SELECT unnest(string_split(path, '>')) AS ancestor, id AS descendant, unnest(range(depth, -1, -1)) AS distance FROM t
  UNION ALL SELECT unnest(seen[2:]), id, unnest(range(1, len(seen))) FROM w WHERE list_contains(seen, here))
SELECT ancestor, descendant, CAST(distance AS INTEGER) AS distance FROM x WHERE distance > 0""",
}
