"""Scored reviews as a stream: partial sums per micro-batch, merged when read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.rollup import DESCRIPTION, KEY, MEANS, behavioral_drift, merged_months, partial_sums
from vigil.session import scratch_path


def replay_business_months(
    scored: DataFrame, folder: str | None = None, score: Callable[[DataFrame], DataFrame] | None = None, **trigger,
) -> DataFrame:
    """Run the stream of reviews to its end and return the product-month table.

    ``scored`` is a streaming frame with the columns of a scored review; with
    ``score`` it has the features only, and that function scores each micro-batch. A batch is
    summed up and written under its number, so a repeated batch replaces its first attempt. Nothing is
    kept as state and no review is too late: months are put together when they are read.
    """
    spark = scored.sparkSession
    folder = folder or scratch_path(spark, "replay")

    def keep(batch: DataFrame, number: int) -> None:
        rows = score(batch) if score else batch
        month = F.trunc(F.col("review_timestamp").cast("timestamp"), "month")
        partial_sums(rows.withColumn("review_month", month)).write.mode("overwrite").parquet(f"{folder}/months/batch={number}")

    query = (
        scored.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(keep)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()
    return current_months(spark, folder)


def current_months(spark: SparkSession, folder: str) -> DataFrame:
    """Every product-month the stream has seen so far, from the sums of all batches."""
    return merged_months(spark.read.parquet(f"{folder}/months"))


def current_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Month-over-month drift of everything the stream has seen so far."""
    return behavioral_drift(current_months(spark, folder))


def compact(spark: SparkSession, folder: str, to: str) -> None:
    """The sums of all batches as one table of the same form, in the folder of another replay.

    For a stream that is stopped meanwhile; it goes on in ``to`` with its checkpoint copied there.
    """
    sums = spark.read.parquet(f"{folder}/months")
    merged = sums.groupBy(*KEY, *DESCRIPTION).agg(
        F.max("max_anomaly_score").alias("max_anomaly_score"),
        *[F.sum(c).alias(c) for c in ("review_count", *[f"{k}_{c}" for c in MEANS.values() for k in ("sum", "count")])])
    merged.write.parquet(f"{to}/months/batch=-1")
