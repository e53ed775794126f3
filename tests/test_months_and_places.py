"""Product-months keyed by product and month alone, places in a whole order, and stages that clean up after themselves."""

import datetime
import pathlib

from pyspark.sql import functions as F

from vigil.operators.places import with_places
from vigil.operators.rollup import DESCRIPTION, behavioral_drift, business_month_signals

SCORED = ("business_id string, review_timestamp timestamp, review_month date, business_name string, product_title string, city string, "
          "state string, stars double, is_extreme_rating double, review_length double, anomaly_score double, is_suspicious_review double")
SMALL = "/root/testdata/sf0.001"


def review(product, month, title, stars, score=0.5):
    at = None if month is None else datetime.datetime(2021, month, 3)
    return (product, at, at and at.date().replace(day=1), "shop", title, None, "", stars, float(stars in (1.0, 5.0)), 10.0, score, float(score >= 0.7))


RENAMED = [review("b1", 1, "old", 5.0), review("b1", 1, "new", 3.0, 0.9), review("b1", 1, None, 4.0), review("b1", 2, "new", 1.0),
           review("b2", 1, "old", 2.0), review(None, 1, "old", 2.0), review("b2", None, "old", 3.0)]


def test_a_product_with_two_titles_has_one_row_a_month(spark):
    months = business_month_signals(spark.createDataFrame(RENAMED, SCORED))
    found = {(r["business_id"], r["review_month"] and r["review_month"].month): r for r in months.collect()}
    assert len(found) == months.count() == 5
    first = found["b1", 1]
    assert (first["review_count"], first["avg_rating"], first["max_anomaly_score"], first["product_title"]) == (3, 4.0, 0.9, "old")
    assert first["city"] is None and first["state"] == "" and abs(first["suspicious_review_density"] - 1 / 3) < 1e-12
    drift = {(r["business_id"], r["review_month"] and r["review_month"].month): r for r in behavioral_drift(months).collect()}
    assert drift["b1", 1]["prev_review_count"] is None and drift["b1", 2]["prev_review_count"] == 3
    assert drift["b1", 2]["rating_shift"] == -3.0
    assert business_month_signals(spark.createDataFrame([], SCORED)).count() == 0


def test_a_title_that_changes_between_two_replays_into_one_folder(spark, tmp_path):
    from vigil.streaming.replay import compact, current_months, replay_business_months
    source, folder = str(tmp_path / "source"), str(tmp_path / "run")
    for row in RENAMED[:5]:
        spark.createDataFrame([row], SCORED).write.mode("append").parquet(source)
        replay_business_months(spark.readStream.schema(spark.read.parquet(source).schema).parquet(source), folder)
    columns = ("business_id", "review_month", "review_count", "avg_rating", "max_anomaly_score", *DESCRIPTION)
    whole = sorted(map(str, business_month_signals(spark.createDataFrame(RENAMED[:5], SCORED)).select(*columns).collect()))
    assert sorted(map(str, current_months(spark, folder).select(*columns).collect())) == whole and len(whole) == 3
    compact(spark, folder, str(tmp_path / "compacted"))
    assert sorted(map(str, current_months(spark, str(tmp_path / "compacted")).select(*columns).collect())) == whole


def test_places_equal_a_sorted_list(spark):
    rows = [(i, (i * 7919) % 503 if i % 3 else 0) for i in range(5000)]  # one score in a third of the rows
    df = spark.createDataFrame(rows, "id long, score long").repartition(11)
    found = with_places(df, [F.desc("score"), F.asc("id")])
    assert found.columns == ["id", "score", "place"]
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r["id"], r["score"]) for r in found.orderBy("place").collect()] == expected
    assert sorted(r["place"] for r in found.collect()) == list(range(1, 5001))
    assert with_places(df.limit(0), [F.asc("id")]).count() == 0


def test_what_a_stage_writes_goes_with_the_stage(spark, tmp_path, monkeypatch):
    from vigil.plans import full_run
    from vigil.session import shared_folder
    from vigil.sources import fixtures as fx
    shared, seen = pathlib.Path(shared_folder(spark).removeprefix("file:")), {}
    others = set(shared.glob("run-*"))

    def watched(df, path, by_month=False):
        write_table(df, path, by_month)
        seen[pathlib.Path(path).name] = {str(p) for p in set(shared.glob("run-*")) - others}
    write_table = full_run.write_table
    monkeypatch.setattr(full_run, "write_table", watched)
    reviews = fx.reviews(spark, SMALL)
    done = full_run.run_on(reviews, fx.metadata(spark, SMALL), str(tmp_path), full_run.Options("catalogue", trees=5))
    assert done.tables["top_suspicious_reviews"].count() and len(seen) == 8
    held = list(seen.values())
    assert any(held) and all(len(h) <= 1 for h in held)
    assert not any(a & b for i, a in enumerate(held) for b in held[:i])
    assert not set(shared.glob("run-*")) - others
