"""Exact quantiles of many columns without gathering a column in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigil.session import written_table

# Buckets per doubling of (1 + |value| * OFFSET): the widest step inside a
# bucket is 0.07 % of the value, and a column spans a few ten thousand buckets.
STEPS = 1024
OFFSET = 1024.0
PARTS = 4096         # parts that a bucket is cut into when it holds too many values
MAX_CELL = 1_000_000  # rows of one cell from which it is cut further


def bucket(value: Column) -> Column:
    """Monotone bucket number: fine near zero, proportional further out."""
    size = F.floor(F.log2(F.lit(1.0) + F.abs(value) * OFFSET) * STEPS)
    return F.when(value < 0, -size - 1).otherwise(size)


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: list[str] | None = None,
    interpolate: bool = True,
    max_cell: int = MAX_CELL,
) -> DataFrame:
    """Long table (by.., feature, probability, value).

    Interpolating (position p * (n - 1)) or, otherwise, the smallest value
    whose cumulative share reaches p. First a histogram with combinable counts
    finds the bucket of each wanted rank. While a wanted one holds more than
    ``max_cell`` rows of different values, it is cut into equal parts and counted
    again (one that holds a single value has its answer), so the last window, over the distinct values of one cell, is bounded
    however many rows there are. ``by`` must be few groups (months): the broadcast
    holds at most groups x columns x 2 * probabilities rows.
    """
    by = by or []
    group = [*by, "feature"]
    long = df.unpivot(by, list(columns), "feature", "value").where("value IS NOT NULL").withColumn(
        "bucket", bucket(F.col("value")))

    per_bucket = W.partitionBy(*group).orderBy("bucket")
    histogram = (
        long.groupBy(*group, "bucket").agg(
            F.count("*").alias("count"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumns({
            "upto": F.sum("count").over(per_bucket.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "n": F.sum("count").over(W.partitionBy(*group)),
        })
        .withColumn("before", F.col("upto") - F.col("count"))
    )
    p = F.col("probability")
    if interpolate:
        position = p * (F.col("n") - 1)
        ranks = {"low": F.floor(position), "high": F.ceil(position)}
    else:
        position = F.lit(0.0)
        ranks = {"low": F.greatest(F.ceil(p * F.col("n")) - 1, F.lit(0))}
    wanted = (
        histogram
        .withColumn("probability", F.explode(F.array(*[F.lit(float(q)) for q in probabilities])))
        .withColumn("share", position - F.floor(position))
        .withColumn("pick", F.explode(F.array(*[
            F.struct(F.lit(name).alias("end"), rank.cast("long").alias("rank")) for name, rank in ranks.items()])))
        .where("pick.rank >= before AND pick.rank < upto")
        .select(*group, "bucket", "probability", "share", "pick.end", "pick.rank", "before", "count", "lo", "hi")
    )
    wanted, cells, widest = written_table(df.sparkSession, wanted, "wanted-ranks"), ["bucket"], None
    while True:
        last, widest = widest, wanted.where("lo < hi").agg(F.max("count")).first()[0] or 0
        if widest <= max_cell or widest == last:
            break
        long, wanted = _cut(long, wanted, group, cells)
        cells = [*cells, f"part{len(cells)}"]
    # a cell of one value has its answer; its rows, often most of a column, are not looked at again
    settled = wanted.where(" AND ".join(["NOT lo < hi", *[f"{c} IS NOT NULL" for c in by]])).select(*group, "probability", "share", "end", F.expr(
        "CASE WHEN lo = 0 THEN abs(lo) ELSE lo END").alias("value"))
    wanted = wanted.where("lo < hi").drop("count", "lo", "hi")
    targets = wanted.select(*group, *cells, "before").distinct()
    per_value = W.partitionBy(*group, *cells).orderBy("value")
    values = (
        long.join(F.broadcast(targets), [*group, *cells])
        .groupBy(*group, *cells, "before", "value").count()
        .withColumn("upto", F.col("before") + F.sum("count").over(
            per_value.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .withColumn("first", F.col("upto") - F.col("count"))
        .drop("before", "count")
    )
    found = (
        values.join(F.broadcast(wanted.drop("before")), [*group, *cells])
        .where("rank >= first AND rank < upto").select(*settled.columns).unionByName(settled)
        .groupBy(*group, "probability", "share")
        .agg(F.max(F.when(F.col("end") == "low", F.col("value"))).alias("low"),
             F.max(F.when(F.col("end") == "high", F.col("value"))).alias("high"))
    )
    between = F.col("low") + (F.coalesce("high", "low") - F.col("low")) * F.col("share")
    return found.select(*group, "probability", between.alias("value"))


def _cut(long: DataFrame, wanted: DataFrame, group: list[str], cells: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of the wanted cells with the number of their part, and the wanted ranks by part."""
    part = f"part{len(cells)}"
    targets = wanted.select(*group, *cells, "before", "lo", "hi").distinct()
    inside = long.join(F.broadcast(targets), [*group, *cells]).withColumn(part, F.expr(
        f"CASE WHEN lo < hi THEN CAST(floor((value - lo) / (hi - lo) * {PARTS}) AS BIGINT) ELSE 0L END"))
    running = W.partitionBy(*group, *cells).orderBy(part).rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = (
        inside.groupBy(*group, *cells, "before", part).agg(
            F.count("*").alias("count"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("upto", F.col("before") + F.sum("count").over(running))
        .withColumn("before", F.col("upto") - F.col("count"))
    )
    found = (
        parts.join(F.broadcast(wanted.drop("before", "count", "lo", "hi")), [*group, *cells])
        .where("rank >= before AND rank < upto")
        .select(*group, *cells, part, "probability", "share", "end", "rank", "before", "count", "lo", "hi")
    )
    return inside.drop("before", "lo", "hi"), written_table(long.sparkSession, found, "wanted-ranks")
