"""Places of rows in an order over the whole table, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

TASK_BITS = 33  # monotonically_increasing_id: the number of the partition above these bits, that of the row below


def with_places(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``df`` with the place of each row, from 1, in an order that leaves no ties (tied rows get some order among them).

    A distributed sort deals the rows by range; they are written once with their numbers, so places do not change when a task
    is run again. A partition begins where those before it end: that window and its broadcast have one row per partition.
    """
    ordered = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = written_table(df.sparkSession, derive(ordered, {
        "_task": f"shiftright(_at, {TASK_BITS})", "_at": f"_at & {(1 << TASK_BITS) - 1}L"}), "ordered")
    counted = rows.groupBy("_task").agg(F.count("*").alias("_rows"))
    begins = counted.selectExpr(
        "_task", "coalesce(sum(_rows) OVER (ORDER BY _task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    placed = derive(rows.join(F.broadcast(begins), "_task"), {name: "_before + _at + 1"})
    return placed.drop("_task", "_at", "_before")
