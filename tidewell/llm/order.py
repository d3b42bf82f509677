"""Places and running sums over all rows of a group, however large the group is.

A window over a whole group would put the group into one task. Here rows are cut into ranges
of the order, each range is summed, the sums of earlier ranges are added up, and a window runs
inside each range only. DataFrame functions throughout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def running(rows: DataFrame, group: list[str], order: list[Column], value: str | None = None) -> DataFrame:
    """`rows` with _at, the place within the group from 0, _all, the rows of the group, and,
    with `value`, _before, the sum of `value` over the rows ahead, in `order`.

    `rows` should be a stored table: it is read twice. Nulls in `group` are a group. Rows equal
    in `order` get places one after another. Columns that begin with an underscore are taken.
    """
    part, none = Window.partitionBy("_part", *group), F.lit(0).cast("long")
    ranged = (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*group, *order, "_tie")
        .withColumn("_part", F.spark_partition_id())
    )
    ranged = stored(ranged, "ranges")
    sums = [F.count("*").alias("_n"), (F.sum(value) if value else none).alias("_s")]
    totals = ranged.groupBy("_part", *group).agg(*sums)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_of"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.coalesce(F.sum("_n").over(earlier), none).alias("_ahead"),
        F.coalesce(F.sum("_s").over(earlier), none).alias("_sum"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("_all"),
    )
    own = part.orderBy(*order, "_tie")
    placed = ranged.withColumn("_at", F.row_number().over(own).cast("long") - 1)
    if value:
        ahead = own.rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("_before", F.coalesce(F.sum(value).over(ahead), none))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    met = placed.join(offsets, reduce(Column.__and__, same, F.col("_part") == F.col("_of")))
    moved = met.withColumn("_at", F.col("_at") + F.col("_ahead"))
    if value:
        moved = moved.withColumn("_before", F.col("_before") + F.col("_sum"))
    return moved.select(*rows.columns, "_at", "_all", *(["_before"] if value else []))
