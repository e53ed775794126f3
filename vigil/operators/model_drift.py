"""Drift of the scored population against the training baseline, per month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.sql import at_most_one, derive, num, weighted_sum
from vigil.operators.quantiles import exact_quantiles

SCORE = "anomaly_score"


def monthly_population(scored: DataFrame, exact: bool = True) -> DataFrame:
    """Count, mean and 95th percentile of the score, and the mean of every feature, per month.

    ``exact=False`` takes the percentile from a sketch in the same pass, which saves a second
    reading of the scores and is accurate to 1/10,000 of the ranks.
    """
    p95 = [] if exact else [F.percentile_approx(SCORE, 0.95).alias("anomaly_score_p95")]
    monthly = scored.groupBy("review_month").agg(
        F.expr("count(*) AS scored_review_count"),
        F.expr(f"avg({SCORE}) AS anomaly_score_mean"),
        *p95,
        *[F.expr(f"avg({c}) AS {c}_mean") for c in fv.MODEL_FEATURES],
    )
    if not exact:
        return monthly
    ranks = exact_quantiles(scored.select("review_month", SCORE), [SCORE], [0.95], by=["review_month"],
                            interpolate=False)
    # one row per month on both sides
    return monthly.join(F.broadcast(ranks.select("review_month", F.col("value").alias("anomaly_score_p95"))),
                        "review_month", "left")


def model_drift(scored: DataFrame, baseline: DataFrame, exact: bool = True) -> DataFrame:
    """Feature, prediction and combined drift scores per month, with the retraining alert."""
    monthly = monthly_population(scored, exact)
    measures = [f"struct('{c}' AS feature, {c}_mean AS now, CAST(NULL AS DOUBLE) AS now_p95)" for c in fv.MODEL_FEATURES]
    measures.append(f"struct('{SCORE}' AS feature, anomaly_score_mean AS now, anomaly_score_p95 AS now_p95)")
    unit = f"greatest(std, {num(fv.TINY)})"
    away, away_p95 = f"abs(now - mean) / {unit}", f"abs(now_p95 - p95) / {unit}"
    compared = (
        monthly.selectExpr("review_month", f"inline(array({', '.join(measures)}))")
        .join(F.broadcast(baseline.select("feature", "mean", "std", "p95")), "feature")
        .groupBy("review_month")
        .agg(
            F.expr(f"sum(CASE WHEN feature != '{SCORE}' THEN least({away}, 5.0D) / 5.0D END) / {len(fv.MODEL_FEATURES)} "
                   "AS feature_drift_score"),
            F.expr(f"least(max(CASE WHEN feature = '{SCORE}' THEN {away} + {away_p95} END) / 6.0D, 1.0D) "
                   "AS prediction_drift_score"),
        )
    )
    combined = derive(monthly.join(F.broadcast(compared), "review_month"),
                      {"model_drift_score": at_most_one(weighted_sum(fv.MODEL_DRIFT_WEIGHTS))})
    return derive(combined, {"retraining_alert": f"model_drift_score >= {num(fv.RETRAINING_ALERT)}"})
