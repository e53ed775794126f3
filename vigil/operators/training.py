"""Training window, baseline statistics, model fit and scoring."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.sql import derive, flag, num
from vigil.operators.features import model_vector
from vigil.operators.forest import fit_forest, normalise_score, raw_score
from vigil.operators.quantiles import exact_quantiles
from vigil.operators.sampling import hash_sample
from vigil.session import scratch_path, written_table

BASELINE_QUANTILES = {"p05": 0.05, "p50": 0.50, "p95": 0.95, "p99": 0.99}


def monthly_counts(features: DataFrame) -> DataFrame:
    return features.where("review_month IS NOT NULL").groupBy("review_month").count()


def training_cutoff(
    features: DataFrame,
    training_months: int = fv.TRAINING_MONTHS,
    min_rows: int = fv.MIN_TRAINING_ROWS,
) -> DataFrame:
    """One row: cutoff_date (NULL when the data is too small), training_rows, total_rows, by_months.

    The cutoff follows the N-th month seen, or, where that leaves too few rows, the month that
    brings the running total to ``min_rows``. The unpartitioned window runs over one row per month.
    """
    wanted = max(training_months, fv.MIN_TRAINING_MONTHS)
    in_order = W.orderBy("review_month")
    months = monthly_counts(features).withColumns({
        "place": F.row_number().over(in_order),
        "running": F.sum("count").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)),
    })
    early, enough = F.col("place") <= wanted, F.col("running") >= min_rows
    found = months.agg(
        F.max(F.when(early, F.col("review_month"))).alias("nth_month"),
        F.max(F.when(early, F.col("running"))).alias("nth_rows"),
        F.min(F.when(enough, F.col("review_month"))).alias("filled_month"),
        F.min(F.when(enough, F.col("running"))).alias("filled_rows"),
        F.max("running").alias("total_rows"),
    ).withColumn("by_months", F.col("nth_rows") >= min_rows)
    choose = lambda a, b: F.when(F.col("by_months"), F.col(a)).otherwise(F.col(b))
    return found.select(
        F.add_months(choose("nth_month", "filled_month"), 1).alias("cutoff_date"),
        choose("nth_rows", "filled_rows").alias("training_rows"),
        "total_rows",
        "by_months",
    )


def find_cutoff(features: DataFrame, training_months: int, min_rows: int) -> tuple[date, int]:
    found = training_cutoff(features, training_months, min_rows).first()
    if found["total_rows"] is None:
        raise ValueError("no review has a month")
    if found["cutoff_date"] is None:
        raise ValueError(f"{found['total_rows']} reviews are too few to train on, at least {min_rows} are needed")
    return found["cutoff_date"], found["training_rows"]


def before(cutoff: date) -> str:
    return f"review_month < DATE'{cutoff}'"


def from_cutoff_on(cutoff: date) -> str:
    return f"review_month >= DATE'{cutoff}'"


def training_frame(
    features: DataFrame, key: str, cutoff: date, rows: int, max_rows: int | None, seed: int,
) -> DataFrame:
    """Key and model features of the training window, sampled down to about ``max_rows``."""
    vector = model_vector(features.where(before(cutoff)), key)
    if max_rows is None or rows <= max_rows:
        return vector
    return hash_sample(vector, key, max_rows, rows, seed, bound=True).drop("copy")


def baseline_stats(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Long table: feature, mean, std (population; 1 for a constant), p05, p50, p95, p99.

    Not-a-number and NULL count as 0.
    """
    clean = frame.selectExpr(*[f"coalesce(nanvl(CAST({c} AS DOUBLE), NULL), 0.0D) AS {c}" for c in columns])
    moments = clean.agg(*[F.expr(
        f"struct('{c}' AS feature, avg({c}) AS mean, coalesce(nullif(stddev_pop({c}), 0.0D), 1.0D) AS std) AS {c}")
        for c in columns]).selectExpr(f"inline(array({', '.join(columns)}))")
    quantiles = (
        exact_quantiles(clean, columns, list(BASELINE_QUANTILES.values()))
        .groupBy("feature")
        .agg(*[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
               for name, p in BASELINE_QUANTILES.items()])
    )
    # one row per feature on both sides
    return moments.join(F.broadcast(quantiles), "feature", "left")


def impute_and_scale(features: DataFrame, baseline: DataFrame) -> DataFrame:
    """Missing values become the median, then every feature gets mean 0 and deviation 1.

    The forest itself does not need the scaling: its cuts are uniform in the range of each feature.
    """
    stats = {r["feature"]: r for r in baseline.select("feature", "mean", "std", "p50").collect()}
    return derive(features, {
        name: f"(coalesce(nanvl({name}, NULL), {num(s['p50'])}) - {num(s['mean'])}) / {num(s['std'])}"
        for name, s in stats.items() if name in features.columns})


@dataclass
class Model:
    """Three small tables: forest nodes, baseline statistics, and one row of facts about the fit."""

    nodes: DataFrame
    baseline: DataFrame
    meta: DataFrame

    def save(self, path: str) -> None:
        for name in ("nodes", "baseline", "meta"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Model":
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ("nodes", "baseline", "meta")])


def train(
    features: DataFrame,
    model_path: str | None = None,
    key: str = "review_id",
    training_months: int = fv.TRAINING_MONTHS,
    contamination: float = fv.CONTAMINATION,
    max_train_rows: int | None = None,
    seed: int = fv.FOREST_SEED,
    min_rows: int = fv.MIN_TRAINING_ROWS,
    trees: int = fv.FOREST_TREES,
    subsample: int = fv.FOREST_SUBSAMPLE,
) -> Model:
    """Fit on the early window and store the model tables.

    ``contamination`` is recorded only; scores do not depend on it.
    """
    spark = features.sparkSession
    cutoff, rows = find_cutoff(features, training_months, min_rows)
    frame = written_table(
        spark, training_frame(features, key, cutoff, rows, max_train_rows, seed), "training", compression="zstd")
    used = frame.count()
    if used < min_rows:
        raise ValueError(f"{used} training reviews are left after sampling, at least {min_rows} are needed")
    columns = list(fv.MODEL_FEATURES)
    nodes = written_table(spark, fit_forest(frame, key, used, trees, subsample, seed), "nodes")
    scored = written_table(
        spark, frame.select(*columns, raw_score(nodes, columns, min(subsample, used)).alias("raw")), "training-scores", compression="zstd")
    low, high = [r["value"] for r in exact_quantiles(scored, ["raw"], [0.01, 0.99]).orderBy("probability").collect()]
    scored = derive(scored, {"anomaly_score": normalise_score("raw", low, high)})
    meta = spark.createDataFrame(
        [(cutoff, training_months, contamination, low, high, max_train_rows, used, min(subsample, used), trees, seed)],
        "training_cutoff_date date, training_months int, contamination double, raw_score_p01 double, "
        "raw_score_p99 double, max_train_rows long, training_rows long, subsample int, trees int, seed int")
    model = Model(nodes, baseline_stats(scored, [*columns, "anomaly_score"]), meta)
    path = model_path or scratch_path(spark, "model")
    model.save(path)
    return Model.load(spark, path)


def mark_suspicious(scored: DataFrame, threshold: float = fv.SUSPICIOUS_SCORE) -> DataFrame:
    return derive(scored, {"is_suspicious_review": flag(f"anomaly_score >= {num(threshold)}")})


def scorer(model: Model) -> Callable[[DataFrame], DataFrame]:
    """A function that scores reviews from the cutoff on, those the model has not seen; its tables are read and broadcast once."""
    facts = model.meta.first()
    raw = raw_score(model.nodes, list(fv.MODEL_FEATURES), facts["subsample"])
    score = normalise_score("anomaly_score", facts["raw_score_p01"], facts["raw_score_p99"])

    def scored(features: DataFrame) -> DataFrame:
        new = features.where(from_cutoff_on(facts["training_cutoff_date"])).withColumn("anomaly_score", raw)
        return mark_suspicious(derive(new, {"anomaly_score": score}))
    return scored


def score_reviews(features: DataFrame, model: Model) -> DataFrame:
    """Score the reviews from the cutoff on: those the model has not seen."""
    return scorer(model)(features)
