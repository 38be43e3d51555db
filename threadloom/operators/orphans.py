"""References to records that do not exist (missing, removed or late).

A Bloom filter over all parent keys, of bounded size, is built once by a
distributed aggregate, broadcast as a subquery's result and evaluated inside
the scan of the references: what it rejects is absent for certain and is
settled there.  Only references it lets through are gathered by target and
verified by an exact join.  The filter's size is capped (``FILTERS`` parts by
key hash, each of at most ``FILTER_BITS``); with more keys than it is made for
it only lets more references through to the exact join, so the result never
depends on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import first_rows, kind_of, normal_id, parent_comment
from ..session import Scratch

#: Keys of one filter part, its bits for each key and at most, and the number of parts: 80 MB and 64 million keys in all.
PART_KEYS, KEY_BITS, FILTER_BITS, FILTERS = 4_000_000, 10, 8 * 5 * 1024 * 1024, 16


def bloom_member(df: DataFrame, key: str, expected: int, bits: int = FILTER_BITS) -> Callable[[Column], Column]:
    """A test that is false only for values that ``key`` has in no row (and null where there is no key).

    The filter is aggregated on the executors when the query that uses the
    test runs; up to ``FILTERS`` filters by key hash keep it sharp for more
    than ``PART_KEYS`` expected keys.
    """
    jvm = df.sparkSession._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    cat = jvm.org.apache.spark.sql.catalyst.expressions
    parts = max(1, min(FILTERS, -(-expected // PART_KEYS)))
    each = max(1, min(PART_KEYS, -(-expected // parts)))
    column = lambda e: Column(utils.column(e))
    number = lambda n: utils.expression(F.lit(int(n)).cast("bigint")._jc)
    part_of = lambda h: F.pmod(F.shiftright(h, 40), F.lit(parts))
    hashed = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_h"))
    wanted = max(64, min(bits, KEY_BITS * each))
    filters = []
    for k in range(parts):
        own = hashed if parts == 1 else hashed.where(part_of(F.col("_h")) == k)
        agg = cat.aggregate.BloomFilterAggregate(utils.expression(F.xxhash64("_h")._jc), number(each), number(wanted))
        filters.append(own.agg(column(agg.toAggregateExpression()).alias("f")).scalar())

    def test(value: Column) -> Column:
        h = F.xxhash64(value)
        held = [column(cat.BloomFilterMightContain(utils.expression(f._jc), utils.expression(F.xxhash64(h)._jc))) for f in filters]
        if parts == 1:
            return held[0]
        out = F.when(part_of(h) == 0, held[0])
        for k in range(1, parts):
            out = out.when(part_of(h) == k, held[k])
        return out

    return test


def orphan_references(references: DataFrame, parents: DataFrame, removed: DataFrame, *, expected: int | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """References that lead nowhere useful, with their status.

    ``references``: ``owner, field, target, batch_no, period`` (a null target
    is no reference).  ``parents``: ``field, target, first_batch``, one row per
    key; ``expected`` is their number, counted where it is not given.
    ``removed``: ``field, target``.  Returns ``owner, field, target, status,
    period`` where status is ``removed``, else ``missing``, else ``late`` (the
    target came in a later batch).  Empty tables give an empty result, or
    ``missing`` for every reference where no parents exist; repeated rows in
    ``references`` come out as often as they go in.
    """
    keyed = parents.select(F.concat_ws("|", "field", "target").alias("k"))
    held = bloom_member(keyed, "k", parents.count() if expected is None else expected, filter_bits)
    refs = references.where(F.col("target").isNotNull()).withColumn("maybe", F.coalesce(held(F.concat_ws("|", "field", "target")), F.lit(False)))
    gone = removed.where(F.col("target").isNotNull()).select("field", "target").distinct().withColumn("gone", F.lit(True))
    columns = ["owner", "field", "target", "batch_no", "period"]

    # absent for certain: no shuffle by target, only the list of removals to look at
    absent = refs.where(~F.col("maybe")).select(*columns).join(gone, ["field", "target"], "left")
    absent = absent.withColumn("status", F.when(F.col("gone"), "removed").otherwise("missing"))

    # a row per target: the map side combines, so hot targets arrive as few rows
    maybe = refs.where("maybe").select(*columns)
    targets = maybe.groupBy("field", "target").agg(F.min("batch_no").alias("asked"))
    verified = (
        targets.join(parents, ["field", "target"], "left").join(gone, ["field", "target"], "left")
        .where("gone or first_batch is null or first_batch > asked")
        .select("field", "target", "first_batch", F.coalesce("gone", F.lit(False)).alias("gone"))
    )
    # back to the referring rows: these targets are few; a hot one is split by the adaptive skew join
    status = F.when(F.col("gone"), "removed").when(F.col("first_batch").isNull(), "missing").when(F.col("first_batch") > F.col("batch_no"), "late")
    found = maybe.join(verified, ["field", "target"]).withColumn("status", status).where("status is not null")
    out = ["owner", "field", "target", "status", "period"]
    return absent.select(*out).unionByName(found.select(*out))


def comment_references(comments: DataFrame, submissions: DataFrame, removals: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``orphan_references`` over the forum tables (see TESTDATA.md, p2_found)."""
    scratch = scratch or Scratch(comments.sparkSession, "orphans")
    rows = comments.select(
        normal_id("id").alias("id"),
        "rec_no",
        "batch_no",
        F.date_format("received_at", "yyyy-MM-dd").alias("period"),
        normal_id("link_id").alias("link"),
        parent_comment(F.col("link_id"), F.col("parent_id"), F.col("parent_comment_id")).alias("parent"),
    )
    firsts = scratch.save(first_rows(rows, "id", "rec_no", ["rec_no", "batch_no", "period", "link", "parent"]), "firsts")
    posts = submissions.select(normal_id("id").alias("id"), "rec_no", "batch_no")
    posts = scratch.save(first_rows(posts, "id", "rec_no", ["batch_no"]), "posts")
    expected = firsts.count() + submissions.count()
    parents = posts.select(F.lit("link_id").alias("field"), F.col("id").alias("target"), F.col("batch_no").alias("first_batch")).unionByName(
        firsts.select(F.lit("parent_comment_id").alias("field"), F.col("id").alias("target"), F.col("batch_no").alias("first_batch"))
    )
    pair = F.explode(
        F.array(
            F.struct(F.lit("link_id").alias("field"), F.col("link").alias("target")),
            F.struct(F.lit("parent_comment_id").alias("field"), F.col("parent").alias("target")),
        )
    )
    refs = firsts.select(F.col("id").alias("owner"), "batch_no", "period", pair.alias("p")).select("owner", "batch_no", "period", "p.field", "p.target")
    gone = removals.select(
        F.when(kind_of("fullname") == "t3", "link_id").when(kind_of("fullname") == "t1", "parent_comment_id").alias("field"),
        normal_id("fullname").alias("target"),
    ).where("field is not null")
    return orphan_references(refs, parents, gone, expected=expected)


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per field, status and period."""
    return found.groupBy("field", "status", "period").agg(F.count("*").alias("references"), F.count_distinct("target").alias("targets"))
