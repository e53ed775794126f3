"""Product-month signals and their month-over-month drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.sql import at_least_one, at_most_one, capped, derive, weighted_sum

KEY = ("business_id", "review_month")
DESCRIPTION = ("business_name", "product_title", "city", "state")
# signal -> column it is the mean of
MEANS = {
    "avg_rating": "stars",
    "extreme_rating_share": "is_extreme_rating",
    "avg_review_length": "review_length",
    "avg_anomaly_score": "anomaly_score",
    "suspicious_review_density": "is_suspicious_review",
}
# drift column -> (signal it follows, whether the change is relative to the previous value)
FOLLOWED = {
    "review_volume_change": ("review_count", True),
    "rating_shift": ("avg_rating", False),
    "extreme_rating_share_shift": ("extreme_rating_share", False),
    "review_length_shift": ("avg_review_length", True),
}


def partial_sums(scored: DataFrame) -> DataFrame:
    """What some scored reviews add to each product-month, a row for each description of the product among them.

    Descriptions are group keys here, which keeps the aggregation hashed; largest texts would sort the reviews.
    """
    return scored.groupBy(*KEY, *DESCRIPTION).agg(
        F.count("*").alias("review_count"), F.max("anomaly_score").alias("max_anomaly_score"),
        *[F.sum(c).alias(f"sum_{c}") for c in MEANS.values()], *[F.count(c).alias(f"count_{c}") for c in MEANS.values()])


def merged_months(sums: DataFrame) -> DataFrame:
    """One row per product and month, however many descriptions the product had; of each column of these the largest is shown."""
    return sums.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in DESCRIPTION],
        F.sum("review_count").alias("review_count"), F.max("max_anomaly_score").alias("max_anomaly_score"),
        *[F.expr(f"sum(sum_{c}) / nullif(sum(count_{c}), 0)").alias(name) for name, c in MEANS.items()])


def business_month_signals(scored: DataFrame) -> DataFrame:
    """Counts, means and largest score of each product and month."""
    return merged_months(partial_sums(scored))


def change(signal: str, relative: bool) -> str:
    before = f"prev_{signal}"
    step = f"({signal} - {before})" + (f" / {at_least_one(before)}" if relative else "")
    return f"CASE WHEN {before} IS NULL THEN 0.0D ELSE {step} END"


def behavioral_drift(business_month: DataFrame) -> DataFrame:
    """Compares with the previous month seen for the product.

    The window holds one product's months, a few hundred rows at most, however many reviews it has.
    """
    with_previous = derive(business_month, {
        f"prev_{signal}": f"lag({signal}) OVER (PARTITION BY business_id ORDER BY review_month)"
        for signal, _ in FOLLOWED.values()})
    shifted = derive(with_previous, {name: change(*how) for name, how in FOLLOWED.items()})
    return derive(shifted, {"behavioral_drift_score": at_most_one(weighted_sum(
        [(name, weight) for name, _, weight in fv.BEHAVIOUR_WEIGHTS],
        {name: capped(f"abs({name})", full) for name, full, _ in fv.BEHAVIOUR_WEIGHTS}))})
