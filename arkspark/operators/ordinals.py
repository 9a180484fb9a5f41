"""Places in a total order, of all rows or of those of a key, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arkspark.sources.files import written

_IN_PART = (1 << 33) - 1


def ordinals(df: DataFrame, *order: str | Column, by: tuple[str, ...] = (), name: str = "place") -> DataFrame:
    """``df`` with ``name``: each row's place from 1 on by ``order``, among all rows or, with ``by``, among those of equal ones (nulls are equal).
    ``order`` has columns' names or expressions, without a direction.

    Rows are dealt by ranges of (by, order) and sorted within them, and that is written, since ranges are drawn anew in every
    run. What is counted of each range, and of each key in it, and summed up over the ranges before, is added to the places within it. So a key with half of all
    rows takes many ranges. Rows that tie in everything are placed in any order.
    """
    # Expressions become columns first: in a sort's order they would be worked out again at every comparison.
    made = {f"_o{i}": c for i, c in enumerate(order) if not isinstance(c, str)}
    keys = [F.col(c).asc_nulls_first() for c in by] + [F.col(c if isinstance(c, str) else f"_o{i}") for i, c in enumerate(order)]
    ordered = df.withColumns(made).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*made).withColumn("_at", F.monotonically_increasing_id())
    ordered = written(ordered, "ordered").withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(_IN_PART)})
    held = ordered.groupBy("_part", *by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # One row for each range; with keys, one for each key and range that holds it.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1) if by else Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_add"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return ordered.join(held, same).withColumn(name, F.col("_at") + F.col("_add")).drop("_at", "_part", "_p", "_add", *(f"_k{i}" for i in range(len(by))))
