"""Normal forms of ids and contributors, and first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks that delivered ids may carry at their ends.
BLANKS = " \t\r\n "


def normal_id(col: Column | str) -> Column:
    """Blanks trimmed, lower-cased, a leading ``t1_`` or ``t3_`` dropped; '' is null."""
    col = F.col(col) if isinstance(col, str) else col
    bare = F.lower(F.btrim(col, F.lit(BLANKS)))
    bare = F.when(F.substring(bare, 1, 3).isin("t1_", "t3_"), F.substring(bare, 4, 1 << 30)).otherwise(bare)
    return F.nullif(bare, F.lit(""))


def kind_of(col: Column | str) -> Column:
    """``t1``, ``t3`` or null, by the id's prefix."""
    col = F.col(col) if isinstance(col, str) else col
    head = F.lower(F.substring(F.btrim(col, F.lit(BLANKS)), 1, 3))
    return F.when(head == "t1_", F.lit("t1")).when(head == "t3_", F.lit("t3"))


def contributor(col: Column | str) -> Column:
    """Trimmed, lower-cased, without ``/u/`` or ``u/``; null, '' and [deleted] are none."""
    col = F.col(col) if isinstance(col, str) else col
    bare = F.lower(F.btrim(col, F.lit(BLANKS)))
    bare = (
        F.when(F.substring(bare, 1, 3) == "/u/", F.substring(bare, 4, 1 << 30))
        .when(F.substring(bare, 1, 2) == "u/", F.substring(bare, 3, 1 << 30))
        .otherwise(bare)
    )
    return F.when(~bare.isin("", "[deleted]"), bare)


def parent_comment(link: Column, parent_id: Column, parent_comment_id: Column) -> Column:
    """Normal id of the parent comment, or null where the parent is the submission.

    ``parent_comment_id`` counts first; else the comment that ``parent_id``
    names, unless that starts with ``t3_`` or equals the row's ``link_id``.
    """
    named = normal_id(parent_id)
    from_parent = F.when(
        ~F.coalesce(kind_of(parent_id) == "t3", F.lit(False)) & ~F.coalesce(named == normal_id(link), F.lit(False)), named
    )
    return F.coalesce(normal_id(parent_comment_id), from_parent)


def first_rows(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Of each ``key`` the row with the smallest ``order``; null keys have none.

    One hash aggregate with map-side combine, so a hot key costs one partial
    row per task.
    """
    packed = F.min(F.struct(order, *[c for c in columns if c != order])).alias("_first")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(packed).select(key, *[F.col(f"_first.{c}") for c in columns])
