"""What moderators see, their labels, and what the labels say about thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.display import with_case_keys
from vigil.functions.sql import derive, hash_uniform, text

CASE_KEYS = ["product_key", "month_key"]
NO_TIME = -(1 << 60)  # microseconds, before any timestamp; times the number of labels it fits 64 bits


def review_backed_cases(queue: DataFrame, reviews: DataFrame) -> DataFrame:
    """Queue rows with at least one surfaced review."""
    keys = with_case_keys(reviews).select(*CASE_KEYS)
    return with_case_keys(queue).join(keys, CASE_KEYS, "left_semi")


def case_reviews(reviews: DataFrame, queue: DataFrame) -> DataFrame:
    """Surfaced reviews with the decision score of their case, strongest first.

    Surfaced reviews are at most a fixed number per case, so no case is a hot key here.
    """
    cases = with_case_keys(queue).select(*CASE_KEYS, "decision_score")
    return with_case_keys(reviews).join(cases, CASE_KEYS).orderBy(
        *CASE_KEYS, F.desc("fraud_like_score"), F.desc("fraud_signal_count"), F.desc("anomaly_score"), "review_id")


def most_templated(reviews: DataFrame, limit: int = fv.SYNTHETIC_BROWSE_LIMIT, ties=("review_id",)) -> DataFrame:
    score = "synthetic_templated_language_score"
    return reviews.where(F.col(score).isNotNull()).orderBy(F.desc(score), *ties).limit(limit)


def latest_labels(labels: DataFrame) -> DataFrame:
    """The last label given to each review; of labels given at one moment the last by name, and one without a time is the first. Times may be texts.

    Moment and label are one number, so the log is combined by hash before the shuffle. A label outside the vocabulary raises.
    """
    names = sorted(fv.LABELS)
    known = ", ".join(text(name) for name in names)
    place = f"array_position(array({known}), label)"
    code = f"CASE WHEN {place} > 0 THEN {place} - 1 ELSE CAST(raise_error(concat('unknown label: ', label)) AS BIGINT) END"
    coded = labels.where("review_id IS NOT NULL AND label IS NOT NULL").selectExpr(
        "review_id", f"coalesce(unix_micros(CAST(saved_at AS TIMESTAMP)), {NO_TIME}L) * {len(names)} + {code} AS stamp")
    last = coded.groupBy("review_id").agg(F.max("stamp").alias("stamp"))
    parted = derive(last, {"_place": f"pmod(stamp, {len(names)}L)"})
    return derive(parted, {"_moment": f"(stamp - _place) div {len(names)}L"}).selectExpr(
        "review_id", f"array({known})[CAST(_place AS INT)] AS label",
        f"CASE WHEN _moment <> {NO_TIME}L THEN timestamp_micros(_moment) END AS saved_at")


def with_labels(surfaced: DataFrame, labels: DataFrame) -> DataFrame:
    """Surfaced reviews with their latest label, NULL where there is none; copies share one.

    Copies of a review are in the same case, so the rows per review are bounded by the rows per case.
    """
    last = latest_labels(labels).select("review_id", F.col("label").alias("moderator_label"))
    return surfaced.join(last, "review_id", "left")


def precision_by_threshold(
    scored: DataFrame, labels: DataFrame, thresholds=fv.ARM_THRESHOLDS, score: str = "anomaly_score",
) -> DataFrame:
    """Of the labelled reviews at or above each threshold: how many moderators found suspicious.

    "unsure" counts as neither. Copies of a review are counted into one row before the join; after
    it, every threshold is three sums of one pass.
    """
    c = F.col
    weighted = scored.groupBy("review_id", score).agg(F.count("*").alias("reviews"))
    judged = weighted.join(latest_labels(labels).select("review_id", "label"), "review_id")
    hit, miss = c("label") == "suspicious", c("label") == "not suspicious"
    counted = lambda condition: F.sum(F.when(condition, c("reviews")).otherwise(0))
    sums = judged.agg(*[
        F.struct(
            F.lit(float(t)).alias("threshold"),
            counted(hit & (c(score) >= t)).alias("true_positives"),
            counted(miss & (c(score) >= t)).alias("false_positives"),
            counted(hit & (c(score) < t)).alias("missed"),
        ).alias(f"t{i}") for i, t in enumerate(thresholds)])
    return sums.select(F.inline(F.array(*[f"t{i}" for i in range(len(thresholds))]))).withColumn(
        "precision", F.try_divide(c("true_positives"), c("true_positives") + c("false_positives")))


def arm_stats(spark: SparkSession, outcomes: DataFrame, thresholds=fv.ARM_THRESHOLDS) -> DataFrame:
    """Trials and rewards per threshold from (threshold, label) outcomes; every arm has a row."""
    arms = spark.createDataFrame([(i, float(t)) for i, t in enumerate(thresholds)], "arm int, threshold double")
    seen = outcomes.groupBy("threshold").agg(
        F.count("*").alias("trials"), F.expr("CAST(count_if(label = 'suspicious') AS DOUBLE) AS reward"))
    stats = seen.join(arms, "threshold", "full")
    return stats.select(
        F.coalesce("arm", F.lit(len(thresholds))).alias("arm"), "threshold",
        F.coalesce("trials", F.lit(0).cast("long")).alias("trials"),
        F.coalesce("reward", F.lit(0.0)).alias("reward"),
    ).withColumn("mean_reward", F.col("reward") / F.greatest(F.col("trials"), F.lit(1)))


def choose_threshold(
    stats: DataFrame, explore: float = fv.EXPLORE_SHARE, seed: int = 0, batch: str = "0", arms: int = len(fv.ARM_THRESHOLDS),
) -> DataFrame:
    """One row: the best arm (the first of equals), or by chance ``explore`` an arm drawn by hash."""
    best = stats.where(F.col("arm") < arms).agg(
        F.expr("max_by(threshold, struct(mean_reward, -arm)) AS best"),
        F.expr("sort_array(collect_list(struct(arm, threshold))).threshold AS arms"),
    )
    drawn = f"arms[CAST(floor({hash_uniform(seed, 'arm', repr(batch))} * {arms}) AS INT)]"
    exploring = f"{hash_uniform(seed, 'explore', repr(batch))} < {float(explore)!r}D"
    return best.selectExpr(f"CASE WHEN {exploring} THEN {drawn} ELSE best END AS threshold", f"{exploring} AS explored")
