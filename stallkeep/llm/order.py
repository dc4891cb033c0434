"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.operators.keys import place_in_order


def numbered_within(df: DataFrame, group: str, by: Sequence[str], name: str) -> DataFrame:
    """df with ``name``, each row's number from 0 in its group, in the order of ``by``.

    ``group`` is a column without nulls. Rows are sorted across partitions, so a
    group of any size is spread; what a group has in earlier partitions is added
    from one row for each group that goes on in another partition, at most as
    many rows as there are partitions.
    """
    placed = place_in_order(df, [group, *by])
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_rows"))
    earlier = F.sum("_rows").over(Window.partitionBy(group).orderBy("_part")) - F.col("_rows")
    carried = counts.withColumn("_before", earlier).filter("_before > 0").select(group, "_part", "_before")
    here = F.col("_position") - F.min("_position").over(Window.partitionBy("_part", group))
    joined = placed.withColumn("_here", here).join(F.broadcast(carried), [group, "_part"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_here") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))
