"""Capping records per dominant contributor.

Limits come from contributor counts alone: a fixed count, or a share.  A share
of the output is solved by water-filling over the sorted counts until the
output's shares are consistent.  Then only contributors above the limit are
ranked by quality, over range-partitioned rows, so that a contributor with a
third of all rows is spread over many tasks and never gathered in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import contributor, first_rows, normal_id
from ..session import Scratch


def water_level(histogram: list[tuple[int, int]], share: float, floor: int = 0, free: int = 0) -> int:
    """Largest limit L with L <= max(floor, share * (free + sum of min(count, L))), no larger than the largest count.

    ``histogram``: (count, number of contributors with that count), ``free``:
    records without a contributor, which are never capped.  This is the fill of
    one group as a plain function; ``limits_per_group`` fills all at once.
    """
    level = filled = 0
    above = sum(n for _, n in histogram)
    for count, n in [*sorted(histogram), (None, 0)]:
        # between two counts the output is what lies below plus the level for each contributor above
        reach = count if share * above >= 1 or count is None else int(share * (free + filled) / (1 - share * above) + 1e-9)
        if count is None or reach < count:
            return max(floor, level if count is None else max(level, reach))
        level, above, filled = count, above - n, filled + count * n
    return max(floor, level)


def limits_per_group(counts: DataFrame, group: str, *, share: float, floor: int, of_output: bool) -> DataFrame:
    """``group, cap`` from ``group, who, n`` (``who`` null: records without a contributor).

    Water is filled over the sorted distinct counts of each group: below a
    level L the output has what smaller contributors give (a running sum) plus
    L for each larger one, and the level rises while it stays within its share
    of that.  With a share of the input the size filled against is that of the
    input at every level.  A group's distinct counts are at most about the
    square root of twice its rows, so its window is small.
    """
    histogram = counts.where("who is not null").groupBy(group, F.col("n").alias("c")).agg(F.count("*").alias("m"))
    sizes = counts.groupBy(group).agg(F.sum("n").alias("all"), F.sum(F.when(F.col("who").isNull(), F.col("n")).otherwise(0)).alias("free"), F.count("who").alias("many"))
    # a row at level 0 begins each group's levels
    levels = histogram.unionByName(sizes.select(group, F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("m")))
    levels = levels.alias("a").join(sizes.alias("b"), F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}"))).select(f"a.{group}", "c", "m", "all", "free", "many")
    upto = Window.partitionBy(group).orderBy("c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below, above = F.col("free") + F.sum(F.col("c") * F.col("m")).over(upto), F.col("many") - F.sum("m").over(upto)
    if not of_output:
        below, above = F.col("all"), F.lit(0)
    levels = levels.withColumn("below", below).withColumn("above", above).withColumn("next", F.lead("c").over(Window.partitionBy(group).orderBy("c")))
    within = F.col("c") <= F.lit(share) * (F.col("below") + F.col("c") * F.col("above")) + F.lit(1e-9)
    # where larger contributors fill up as fast as the level, the next count is within as well
    reach = F.floor(F.try_divide(F.lit(share) * F.col("below"), F.greatest(F.lit(0.0), 1 - F.lit(share) * F.col("above"))) + F.lit(1e-9))
    level = F.when(F.col("next").isNull(), F.col("c")).otherwise(F.least("next", F.greatest(F.col("c"), reach)))
    reached = levels.where(within).groupBy(group).agg(F.max_by(level, "c").alias("level"))
    return reached.select(group, F.greatest(F.lit(floor).cast("bigint"), F.col("level").cast("bigint")).alias("cap"))


def beyond_limit(rows: DataFrame, *, share: float, floor: int, of_output: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Rows above their contributor's limit in their group.

    ``rows``: ``id`` (unique), ``grp``, ``who``, ``quality``.  Each contributor
    keeps its best rows: higher quality first, null quality last, ties by
    smaller id.  Null ``who`` is never capped, null ``grp`` is a group of its
    own; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(rows.sparkSession, "capping")
    rows = rows.select("id", "grp", "who", "quality")
    counts = scratch.save(rows.groupBy("grp", "who").agg(F.count("*").alias("n")), "counts")
    caps = limits_per_group(counts, "grp", share=share, floor=floor, of_output=of_output)
    # contributors above the limit: with a share s at most 1/s of them in a group
    over = (
        counts.where("who is not null").alias("c")
        .join(caps.alias("l"), F.col("c.grp").eqNullSafe(F.col("l.grp")))
        .where("n > cap")
        .select(F.col("c.grp").alias("grp"), "who", "cap")
    )
    over = scratch.save(over, "over")
    ranked = rows.where("who is not null").alias("r").join(over.alias("o"), F.col("r.grp").eqNullSafe(F.col("o.grp")) & (F.col("r.who") == F.col("o.who")))
    ranked = ranked.select("r.*", "cap")
    order = [F.col("quality").desc_nulls_last(), F.col("id").asc()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a range key of all columns also splits a hot contributor; written, so that partition numbers stay put
    spread = ranked.repartitionByRange(parts, F.col("grp"), F.col("who"), *order).withColumn("part", F.spark_partition_id())
    spread = scratch.save(spread, "spread")
    sizes = spread.groupBy("grp", "who", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("grp", "who").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each part of a contributor: at most contributors above the limit plus parts
    offsets = sizes.withColumn("skip", F.coalesce(F.sum("size").over(before), F.lit(0))).select("grp", "who", "part", "skip").where("skip > 0")
    local = Window.partitionBy("grp", "who", "part").orderBy(*order)
    numbered = spread.withColumn("nth", F.row_number().over(local))
    joined = numbered.alias("n").join(
        offsets.alias("o"), F.col("n.grp").eqNullSafe(F.col("o.grp")) & (F.col("n.who") == F.col("o.who")) & (F.col("n.part") == F.col("o.part")), "left"
    )
    return joined.where(F.col("nth") + F.coalesce("skip", F.lit(0)) > F.col("cap")).select("n.id", "n.grp", "n.who", "n.quality")


def comment_rows(comments: DataFrame) -> DataFrame:
    """First rows of the forum's comments as ``id, grp, who, quality``."""
    narrow = comments.select(normal_id("id").alias("id"), "rec_no", F.col("batch_no").alias("grp"), contributor("author").alias("who"), F.col("score").alias("quality"))
    return first_rows(narrow, "id", "rec_no", ["grp", "who", "quality"])


def dropped_comments(comments: DataFrame, *, share: float = 0.02, floor: int = 2, of_output: bool = False) -> DataFrame:
    """Comments beyond their contributor's limit in their batch."""
    scratch = Scratch(comments.sparkSession, "capping")
    rows = scratch.save(comment_rows(comments), "rows")
    return beyond_limit(rows, share=share, floor=floor, of_output=of_output, scratch=scratch)
