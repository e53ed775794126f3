"""Review features: text, rating and reviewer columns of every review."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigil import fixed_values as fv
from vigil.functions.sql import derive, flag, zero_if_missing
from vigil.functions.text import with_text_features
from vigil.operators.as_of import attach_history
from vigil.operators.joins import attach_by_key, packed, unpacked
from vigil.operators.profiles import REVIEWER_MEANS, business_average, reviewer_profile
from vigil.session import written_table


# what the joins and formulas after the first join by key and time need, whatever is wanted in the end
AS_OF_COLUMNS = ("_id", "business_id", "user_id", "review_timestamp", "stars", "review_length", "business_average_stars", "business_rows")


def build_review_features(
    reviews: DataFrame, products: DataFrame | None = None, same_history: bool = False, as_of: bool = False,
    history: DataFrame | None = None, kept: tuple[str, ...] | None = None,
) -> DataFrame:
    """All feature columns, one output row per review.

    Text features come first, in the scan stage: when no text column is wanted
    downstream, only numbers go through the two joins. Reviewers come first: they are the many, and
    what is said of the product need not pass their shuffle. Product description and product average share one join. ``same_history`` says that the products were
    built from these very reviews, so their average need not be taken again. ``history`` is a narrower table of the same
    reviews (product, reviewer, stars; with ``as_of`` their time), if there is one: averages are then taken over it.
    With ``as_of`` the averages of products and reviewers are taken over earlier reviews alone, and what the product table
    says of all history is left out; the first review of a product or reviewer has zeros there. ``kept`` names the columns that
    are wanted; the rows are then written between the two joins, so that shuffles of one are gone before those of the other.
    """
    description = None if products is None else products.drop("product_id", "category")
    if as_of:
        return _finished(_dated(unpacked(_as_of(packed(with_text_features(reviews)), description, history, kept))))
    if description is not None and same_history:
        per_business = derive(description, {
            "business_average_stars": "listed_business_stars", "business_rows": "listed_review_count"})
    else:
        per_business = business_average(reviews if history is None else history)
        if description is not None:
            per_business = per_business.join(description, "business_id", "left")

    own, of_reviewer = _own_features(reviews), reviewer_profile(reviews if history is None else history)
    rows = attach_by_key(packed(own), of_reviewer, ["user_id"], "reviewer_review_count",
                         spread_by=["business_id", "review_timestamp", "stars", "review_length"])
    rows = attach_by_key(rows, per_business, ["business_id"], "business_rows",
                         spread_by=["user_id", "review_timestamp", "stars", "review_length"])
    said = [c for c in per_business.columns if c not in ("business_id", "business_rows")]
    return _finished(unpacked(rows).select(*own.columns, *said, *[c for c in of_reviewer.columns if c != "user_id"]))


def _own_features(reviews: DataFrame) -> DataFrame:
    """What a review says of itself."""
    return _dated(with_text_features(reviews))


def _dated(rows: DataFrame) -> DataFrame:
    return derive(rows, {
        "review_date": "to_date(review_timestamp)",
        "review_month": "trunc(review_timestamp, 'month')",
        "is_extreme_rating": flag("stars IN (1.0D, 5.0D)"),
    })


def _as_of(
    rows: DataFrame, description: DataFrame | None, history: DataFrame | None, kept: tuple[str, ...] | None,
) -> DataFrame:
    """Averages over earlier reviews; of the product table only what does not sum up its reviews."""
    rows = attach_history(rows, "business_id", "review_timestamp", {"business_average_stars": "stars"}, "business_rows",
                          spread_by=["user_id", "stars", "review_length"], told_by=history)
    if kept is not None:
        used = {*kept, *AS_OF_COLUMNS}
        rows = written_table(rows.sparkSession, rows.select(*[c for c in rows.columns if c in used]), "as-of", compression="zstd")
    rows = attach_history(rows, "user_id", "review_timestamp", REVIEWER_MEANS, "reviewer_review_count",
                          spread_by=["business_id", "stars", "review_length"], told_by=history)
    rows = derive(rows.drop("business_rows"), {"reviewer_review_count": "CAST(reviewer_review_count AS DOUBLE)"})
    if description is None:
        return rows
    described = description.drop("listed_business_stars", "average_rating")
    return attach_by_key(rows, described, ["business_id"], "listed_review_count",
                         spread_by=["user_id", "review_timestamp", "stars", "review_length"]).drop("listed_review_count")


def _finished(rows: DataFrame) -> DataFrame:
    """Deviations from the product's average, and zeros for what is missing."""
    signed = "CAST(stars - business_average_stars AS DOUBLE)"
    rows = derive(rows, {
        "rating_deviation_from_product_average": signed,
        "rating_deviation_from_business_average": f"abs({signed})",
    })
    return derive(rows, {c: zero_if_missing(c) for c in fv.ZERO_FILLED_FEATURES if c in rows.columns})


def model_vector(features: DataFrame, *others: str) -> DataFrame:
    return features.selectExpr(*others, *[f"CAST({c} AS DOUBLE) AS {c}" for c in fv.MODEL_FEATURES])
