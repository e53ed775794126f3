"""Decision score, routing and the moderation queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.sql import at_most_one, derive, num, weighted_sum, zero_if_missing


def decide(behavioral: DataFrame, model_drift: DataFrame, threshold: float = fv.DECISION_THRESHOLD) -> DataFrame:
    """Blend behaviour and model drift per product-month and mark what goes to moderators."""
    # one row per month: some hundreds at most, so broadcasting is safe at any data size
    monthly = model_drift.select("review_month", "feature_drift_score", "prediction_drift_score",
                                 "model_drift_score", "retraining_alert")
    joined = behavioral.join(F.broadcast(monthly), "review_month", "left")
    filled = derive(joined, {c: zero_if_missing(c) for c in fv.ZERO_FILLED_DECISION_INPUTS})
    scored = derive(filled, {"decision_score": at_most_one(weighted_sum(fv.DECISION_WEIGHTS))})
    return derive(scored, {"route_to_moderation":
        f"decision_score >= {num(threshold)} "
        f"OR (suspicious_review_density >= {num(0.25)} AND review_count >= 3) "
        f"OR (max_anomaly_score >= {num(0.90)} AND behavioral_drift_score >= {num(0.35)})"})


def most_urgent() -> list[Column]:
    """The order of cases. Ties are broken by case, which also keeps equal scores from landing in one range partition."""
    return [F.desc("decision_score"), F.desc("review_count"), F.asc("business_id"), F.asc("review_month")]


def most_urgent_first(cases: DataFrame) -> DataFrame:
    return cases.orderBy(*most_urgent())


def moderation_queue(decisions: DataFrame) -> DataFrame:
    return decisions.where("route_to_moderation").select(*fv.QUEUE_COLUMNS)
