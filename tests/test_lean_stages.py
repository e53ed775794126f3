"""Stages hold what a query asks for, and values that are known already are not counted again."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.operators.quantiles import exact_quantiles
from vigil.plans.queries import QUERIES


@pytest.mark.parametrize("name", ["baseline_stats", "model_drift", "decisions", "moderation_queue", "queue_places", "queue_explained",
                                  "display_names"])
def test_queries_over_cases_store_no_ids_of_reviews(spark, name):
    texts = ("review_id", "business_id", "business_name", "product_title", "city", "state")
    rows = spark.range(4).selectExpr("DATE'2020-01-01' AS review_month", *[f"CAST(id AS STRING) AS {c}" for c in texts],
                                     *[f"1.0D AS {c}" for c in fv.MODEL_FEATURES])
    inputs = QUERIES[name][0](spark, "")
    inputs.__dict__["features"] = rows
    assert inputs.with_score.count() == 4
    assert "review_id" not in inputs.with_score.columns


def test_quantiles_of_settled_cells_are_not_counted_again(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def noted(n):
        seen.add(1)
        return -0.0 if n % 2 else 0.0
    found = exact_quantiles(spark.range(40).select(noted("id").alias("x")), ["x"], [0.0, 0.3, 1.0]).collect()
    assert sorted((r["probability"], str(r["value"])) for r in found) == [(0.0, "0.0"), (0.3, "0.0"), (1.0, "0.0")]
    assert seen.value == 40


def test_quantiles_beside_settled_cells(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 5.0), ("a", 5.0001), ("b", float("nan")), ("b", float("nan")), (None, 2.0), ("c", None)]
    frame = spark.createDataFrame(rows, "g string, x double")
    found = {(r["g"], r["probability"]): r["value"] for r in exact_quantiles(frame, ["x"], [0.0, 0.5, 1.0], by=["g"]).collect()}
    assert {k: v for k, v in found.items() if k[0] == "a"} == {("a", 0.0): 1.0, ("a", 0.5): 3.0, ("a", 1.0): 5.0001}
    assert np.isnan(found["b", 0.5]) and {g for g, _ in found} == {"a", "b"}
