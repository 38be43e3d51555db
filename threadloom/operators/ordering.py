"""Running totals within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch


def running_total(rows: DataFrame, key: str, order: list[str], weight: Column, name: str = "before") -> DataFrame:
    """``rows`` with the sum of ``weight`` over the earlier rows of their ``key``.

    Rows are range-partitioned by key and order, so a hot key is spread over
    many tasks; only a sum for each key and partition is added up across them.
    ``order`` should be unique within a key; columns of that name are replaced.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.withColumn("_w", weight.cast("bigint")).repartitionByRange(parts, key, *order).withColumn("_part", F.spark_partition_id())
    spread = Scratch(rows.sparkSession, "ordering").save(spread, "spread")  # written, so that partition numbers stay put
    sums = spread.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.sum("_w").alias("_s"))
    earlier = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    skipped = sums.withColumn("_skip", F.coalesce(F.sum("_s").over(earlier), F.lit(0))).where("_skip > 0").drop("_s")
    local = F.sum("_w").over(Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    joined = spread.withColumn(name, F.coalesce(local, F.lit(0))).join(skipped, (F.col(key) == F.col("_k")) & (F.col("_part") == F.col("_p")), "left")
    return joined.withColumn(name, F.col(name) + F.coalesce("_skip", F.lit(0))).drop("_w", "_part", "_k", "_p", "_skip")
