"""Full-history statistics per product and per reviewer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import flag

# reviewer statistic -> what it is the mean of
REVIEWER_MEANS = {
    "reviewer_average_rating": "stars",
    "reviewer_extreme_rating_share": flag("stars IN (1.0D, 5.0D)"),
    "reviewer_five_star_share": flag("stars = 5"),
    "reviewer_one_star_share": flag("stars = 1"),
}


def business_average(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("business_id").agg(
        F.avg("stars").alias("business_average_stars"), F.count("*").alias("business_rows"))


def reviewer_profile(reviews: DataFrame) -> DataFrame:
    """Rows without a reviewer form a group of their own here; joins by reviewer never match it."""
    return reviews.groupBy("user_id").agg(
        F.expr("CAST(count(*) AS DOUBLE) AS reviewer_review_count"),
        *[F.expr(f"avg({measure})").alias(name) for name, measure in REVIEWER_MEANS.items()],
    )
