import os
import pathlib
import random
import statistics
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions import display
from vigil.functions.display import month_key
from vigil.functions.sql import hash_uniform, weighted_sum
from vigil.operators.decisions import decide
from vigil.operators.features import build_review_features
from vigil.operators.forest import expected_path, fit_forest, raw_score
from vigil.operators.fraud import with_copy_counts
from vigil.operators.joins import attach_by_key
from vigil.operators.moderation import arm_stats, choose_threshold, latest_labels
from vigil.operators.quantiles import exact_quantiles
from vigil.operators.rollup import behavioral_drift
from vigil.operators.sampling import hash_sample
from vigil.operators.training import baseline_stats, find_cutoff, training_cutoff
from vigil.sources.reviews import parse_metadata


def test_attach_matches_a_plain_left_join_with_a_hot_and_a_null_key(spark):
    rows = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 50) END AS k")
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    expected = rows.join(per_key, "k", "left").select("id", "k", "n", "first").collect()
    for least, broadcast in ((2000, 9), (500, 9), (20, 9), (1, 99), (20, 3), (1, 0)):
        got = attach_by_key(rows, per_key, ["k"], "n", ["id"], rows_per_task=least, broadcast_keys=broadcast).select(
            "id", "k", "n", "first").collect()
        assert sorted(map(str, got)) == sorted(map(str, expected))
    inner = attach_by_key(rows, per_key.where("k = 'hot'"), ["k"], "n", ["id"], inner=True, rows_per_task=500)
    assert inner.count() == 1000


def test_hot_and_null_keys_are_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(8000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'hot' END AS k")
        per_key = rows.groupBy("k").agg(F.count("*").alias("n"))
        joined = attach_by_key(rows, per_key, ["k"], "n", ["id"], rows_per_task=1000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_quantiles(spark, parts):
    rng = random.Random(3)
    data = [(i % 2, rng.gauss(0, 50), float(rng.randint(0, 3)), rng.random() ** 6) for i in range(4001)]
    df = spark.createDataFrame(data, "g int, a double, b double, c double").repartition(parts)
    probs = [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]
    got = {(r["feature"], r["probability"]): r["value"] for r in exact_quantiles(df, ["a", "b", "c"], probs).collect()}
    for j, name in enumerate("abc", start=1):
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.quantile([d[j] for d in data], p), abs=1e-12)
    lower = exact_quantiles(df, ["a"], [0.95], by=["g"], interpolate=False).collect()
    for r in lower:
        values = sorted(d[1] for d in data if d[0] == r["g"])
        assert r["value"] == values[int(np.ceil(0.95 * len(values))) - 1]


def test_sample_counts_copies_in_proportion(spark):
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'copy' ELSE concat('r', id) END AS key", "1.0D AS x")
    sample = hash_sample(rows, "key", 900, 9000, seed=1)
    size, copies = sample.count(), sample.where("key = 'copy'").count()
    assert 800 < size < 1000 and copies in (300, 301)
    again = hash_sample(rows.repartition(13), "key", 900, 9000, seed=1)
    assert sorted(map(str, again.collect())) == sorted(map(str, sample.collect()))
    assert hash_sample(rows, "key", 10_000, 9000, seed=1).count() == 9000


def planted(spark, n=2000):
    rng = random.Random(5)
    rows = [(f"r{i}", rng.gauss(0, 1), rng.gauss(0, 1), 1.0) for i in range(n)] + [(f"odd{i}", 9.0 + i, -9.0 - i, 1.0) for i in range(5)]
    return spark.createDataFrame(rows, "key string, a double, b double, constant double")


def test_forest_ranks_outliers_first_and_ignores_partitioning(spark):
    data, names = planted(spark), ["a", "b", "constant"]
    nodes = fit_forest(data, "key", 2005, trees=50, subsample=128)
    other = fit_forest(data.repartition(11), "key", 2005, trees=50, subsample=128)
    assert sorted(map(str, nodes.collect())) == sorted(map(str, other.collect()))
    scored = data.select("key", raw_score(nodes, names, 128).alias("s")).orderBy(F.desc("s")).collect()
    assert all(0 < r["s"] <= 1 for r in scored)
    assert {r["key"] for r in scored[:5]} == {f"odd{i}" for i in range(5)}


def test_forest_against_walking_the_node_table(spark):
    data, names = planted(spark, 300), ["a", "b", "constant"]
    nodes = fit_forest(data, "key", 305, trees=7, subsample=64)
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}
    assert {t for t, _ in table} == set(range(7))
    assert all(r["feature"] != 2 for r in table.values())
    for t in range(7):
        leaves = [r for (tree, _), r in table.items() if tree == t and r["feature"] < 0]
        assert sum(r["size"] for r in leaves) == table[(t, 1)]["size"] == 64
    for row in data.select("*", raw_score(nodes, names, 64).alias("s")).collect():
        paths = []
        for t in range(7):
            node = 1
            while table[(t, node)]["feature"] >= 0:
                r = table[(t, node)]
                node = 2 * node + (row[names[r["feature"]]] > r["threshold"])
            paths.append(table[(t, node)]["path_length"])
        assert row["s"] == pytest.approx(2 ** (-statistics.mean(paths) / expected_path(64)))


def months(spark, counts):
    rows = [(m,) for m, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "m string").selectExpr("CAST(m AS DATE) AS review_month")


def test_cutoff_by_months_by_rows_and_too_small(spark):
    many = {f"{2000 + i // 12}-{i % 12 + 1:02d}-01": 2 for i in range(30)}
    assert str(find_cutoff(months(spark, many), 12, 40)[0]) == "2002-01-01"
    row = training_cutoff(months(spark, {**many, "2002-03-01": 500}), 12, 100).first()
    assert (str(row["cutoff_date"]), row["by_months"]) == ("2002-04-01", False)
    with pytest.raises(ValueError):
        find_cutoff(months(spark, many), 12, 1000)
    with pytest.raises(ValueError):
        find_cutoff(months(spark, {"2000-01-01": 1}).where("false"), 12, 1)


def test_baseline_of_a_constant_and_missing_values(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, None), (2.0, float("nan"))], "k double, x double")
    stats = {r["feature"]: r for r in baseline_stats(df, ["k", "x"]).collect()}
    assert stats["k"]["std"] == 1.0 and stats["k"]["mean"] == 2.0
    assert stats["x"]["mean"] == pytest.approx(1 / 3) and stats["x"]["p50"] == 0


def business_months(spark, rows):
    return spark.createDataFrame(rows, "business_id string, m string, review_count long, avg_rating double, "
                                 "extreme_rating_share double, avg_review_length double").selectExpr(
        "*", "CAST(m AS DATE) AS review_month").drop("m")


def test_drift_compares_with_the_last_month_seen(spark):
    drift = {str(r["review_month"]): r for r in behavioral_drift(business_months(spark, [
        ("a", "2020-01-01", 2, 4.0, 0.5, 10.0), ("a", "2020-03-01", 8, 1.0, 1.0, 30.0)])).collect()}
    first, later = drift["2020-01-01"], drift["2020-03-01"]
    assert first["review_volume_change"] == 0 and first["behavioral_drift_score"] == 0
    assert later["review_volume_change"] == 3 and later["rating_shift"] == -3 and later["review_length_shift"] == 2
    assert later["behavioral_drift_score"] == pytest.approx(1.0)


def test_decision_weights_and_month_without_drift(spark):
    assert 0.605 == pytest.approx(spark.createDataFrame([(1.0, 0.5, 0.4, 0.2)], [n for n, _ in fv.DECISION_WEIGHTS])
                                  .selectExpr(f"{weighted_sum(fv.DECISION_WEIGHTS)} AS s").first()["s"])
    behaviour = spark.sql("SELECT 'a' business_id, DATE'2020-01-01' review_month, 5L review_count, 0.3D suspicious_review_density, "
                          "0.0D behavioral_drift_score, 0.1D avg_anomaly_score, 0.2D max_anomaly_score")
    drift = spark.sql("SELECT DATE'2021-01-01' review_month, 1.0D feature_drift_score, 1.0D prediction_drift_score, "
                      "1.0D model_drift_score, true retraining_alert")
    row = decide(behaviour, drift).first()
    assert row["model_drift_score"] == 0 and row["retraining_alert"] is None and row["route_to_moderation"]


def reviews(spark, rows):
    return spark.createDataFrame(rows, "business_id string, user_id string, stars double, text string, t string").selectExpr(
        "*", "CAST(t AS TIMESTAMP) AS review_timestamp", "0.0D AS useful", "0.0D AS funny", "0.0D AS cool",
        "sha2(concat_ws('|', business_id, user_id, text, t), 256) AS review_id").drop("t")


def test_features_use_all_history_and_leave_unknown_reviewers_at_zero(spark):
    rows = [("a", "u", 5.0, "x", "2020-01-01"), ("a", None, 1.0, "y", "2021-01-01"), ("b", "u", 3.0, "z", "2022-01-01")]
    got = {r["text"]: r for r in build_review_features(reviews(spark, rows)).collect()}
    assert got["x"]["rating_deviation_from_product_average"] == 2 and got["y"]["rating_deviation_from_product_average"] == -2
    assert got["y"]["rating_deviation_from_business_average"] == 2
    assert got["x"]["reviewer_average_rating"] == 4 and got["x"]["reviewer_review_count"] == 2
    assert got["y"]["reviewer_average_rating"] == 0 and got["y"]["reviewer_review_count"] == 0


def test_copies_are_counted_within_a_product_month(spark):
    rows = [("a", "u1", 5.0, "Same  text here now", "2020-01-01"), ("a", "u2", 5.0, "same text HERE now", "2020-01-31"),
            ("a", "u3", 5.0, "same text here now", "2020-02-01"), ("b", "u1", 5.0, "same text here now", "2020-01-01")]
    df = reviews(spark, rows).selectExpr("*", "trunc(review_timestamp, 'month') AS review_month")
    counts = sorted(r["near_duplicate_review_count"] for r in with_copy_counts(df).collect())
    assert counts == [1, 1, 2, 2]


def test_explanations(spark):
    case = spark.sql("SELECT 'Test Cafe' business_name, '2022-01-01' review_month, 0.91D max_anomaly_score, 0.1D suspicious_review_density")
    told = case.selectExpr(f"{display.case_explanation(case)} AS e").first()["e"]
    assert told == ("Test Cafe was flagged for 2022-01-01 because " + fv.CASE_REASONS["max_anomaly_score"] + ".")
    review = spark.sql("SELECT 3.0D stars, 50.0D word_count, 'plain words here' review_text, 10.0D reviewer_review_count, 3.0D reviewer_average_rating")
    told = review.selectExpr(f"{display.review_explanation(review)} AS e").first()["e"]
    assert told == fv.REVIEW_REASONS["fallback"] + " " + fv.REVIEW_REASONS["closing"]


def test_display_helpers(spark):
    df = spark.createDataFrame([("B000123456789XYZ", "nan", "2020-05-01", "a<br>\n\n\n\nb "), ("X", " Soap ", "soon", None)],
                               "business_id string, product_title string, review_month string, text string")
    a, b = df.selectExpr(
        f"{display.product_display_name(df)} AS name", f"{display.month_label('review_month')} AS month",
        f"{display.display_text('text')} AS shown", f"{display.anomaly_band('0.9D')} AS band").collect()
    assert (a["name"], a["month"], a["shown"]) == ("Unknown product (ASIN B00012345678)", "May 2020", "a\n\nb")
    assert (b["name"], b["month"], b["shown"], b["band"]) == ("Soap", "soon", "", "Highly unusual")


def test_later_label_wins_and_arms(spark):
    log = spark.createDataFrame([("2024-01-01", "r", "unsure"), ("2024-01-02", "r", "suspicious"), ("2024-01-01", "s", None)],
                                "saved_at string, review_id string, label string")
    assert [(r["review_id"], r["label"]) for r in latest_labels(log).collect()] == [("r", "suspicious")]
    outcome = spark.createDataFrame([(0.7, "suspicious")], "threshold double, label string")
    stats = arm_stats(spark, outcome)
    seen = stats.where("threshold = 0.7D").first()
    assert (seen["trials"], seen["reward"]) == (1, 1.0)
    assert choose_threshold(stats, explore=0.0).first()["threshold"] == 0.7
    nothing = arm_stats(spark, outcome.where("false"))
    assert choose_threshold(nothing, explore=0.0).first()["threshold"] == 0.6
    drawn = {choose_threshold(nothing, explore=1.0, batch=str(i)).first()["threshold"] for i in range(12)}
    assert drawn <= {0.6, 0.7, 0.8} and len(drawn) > 1


def test_sample_with_a_hot_row_and_a_bound(spark):
    """One row fills a third of the table; the sample equals counting every group, and a bound is never exceeded."""
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 1700) END AS k", "1.5D AS x")
    for seed in range(4):
        got = hash_sample(rows, "k", 60, 3000, seed).groupBy("k").count().collect()
        every = rows.groupBy("k", "x").count().selectExpr(
            "k", f"CAST(floor(count * {60 / 3000!r}D + {hash_uniform(seed, 'sample', 'k')}) AS BIGINT) AS count").where("count > 0")
        assert sorted(map(tuple, got)) == sorted(map(tuple, every.collect()))
        assert hash_sample(rows, "k", 60, 3000, seed, bound=True).count() <= 60
    plan = hash_sample(rows, "k", 60, 3000, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 0.84" in plan[plan.index("Aggregate"):]  # the cut stands below the count


def test_blank_titles_lose(spark):
    lines = ['{"asin": "a", "title": ""}', '{"asin": "a", "title": "Real Soap"}', '{"asin": "b", "title": " "}']
    found = parse_metadata(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(map(tuple, found)) == [("a", "Real Soap"), ("b", " ")]


def test_month_texts(spark):
    texts = ["May 2020", "05/01/2020", "2020-05-03", "2020/05", "someday", None]
    df = spark.createDataFrame([(t,) for t in texts], "m string").selectExpr(f"{month_key('m')} AS k")
    assert [r["k"] for r in df.collect()] == ["2020-05-01", "2020-05-01", "2020-05-03", "2020-05-01", "someday", None]


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """The entry imported by path from another folder, as on executors without this repository."""
    root = pathlib.Path(__file__).resolve().parent.parent
    code = ("import sys; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', 2).getOrCreate(); "
            "print('rows', e.queries()['forest_nodes'](s, '/root/testdata/sf0.001').count())")
    done = subprocess.run([sys.executable, "-c", code, str(root)], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "rows" in done.stdout, done.stderr[-1500:]


def test_quantiles_of_many_values_in_a_narrow_range(spark):
    """Cells are cut until few values are left in one, and the answer stays exact."""
    df = spark.range(40_000).selectExpr("1 + pmod(xxhash64(id), 1000003) / 1e12 AS x", "id % 3 AS g",
                                        "CASE WHEN id % 5 = 0 THEN 7D ELSE 1 + id / 1e13 END AS y")
    plain = df.toPandas()
    for by in (None, ["g"]):
        for r in exact_quantiles(df, ["x", "y"], [0.0, 0.01, 0.5, 0.99], by, max_cell=50).collect():
            own = plain if by is None else plain[plain.g == r["g"]]
            assert r["value"] == pytest.approx(np.quantile(own[r["feature"]], r["probability"]), rel=1e-15, abs=0)
