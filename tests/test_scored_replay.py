"""The replay with a stored model: repeated, broken and late batches, a pinned model, and files that do not pile up."""

import datetime
import os

import pytest

from vigil import fixed_values as fv
from vigil.operators.training import score_reviews, train
from vigil.streaming import scored_replay
from vigil.streaming.scored_replay import _live, merge, pinned, replay_with_model, stored_months, version_of

SCORED = ("business_id string, review_timestamp timestamp, review_month date, stars double, is_extreme_rating double, review_length double, "
          "anomaly_score double, is_suspicious_review double")


def review(k, month, day=3, score=0.5):
    at = None if month is None else datetime.datetime(2020, month, day, k % 24)
    return (f"b{k % 3}", at, None, float(k % 5 + 1), float(k % 2), 10.0 + k, score, 0.0)


def frame(spark, reviews):
    return spark.createDataFrame(reviews, SCORED)


def known(spark, folder):
    return sorted((r["business_id"], str(r["review_month"]), r["review_count"], round(r["avg_rating"], 9), r["max_anomaly_score"])
                  for r in stored_months(spark, folder).collect())


def direct(reviews):
    groups = {}
    for r in reviews:
        groups.setdefault((r[0], str(r[1].date().replace(day=1)) if r[1] else "None"), []).append(r)
    return sorted((b, m, len(rows), round(sum(r[3] for r in rows) / len(rows), 9), max(r[6] for r in rows)) for (b, m), rows in groups.items())


def test_late_and_repeated_batches(spark, tmp_path):
    folder, seen = str(tmp_path), []
    batches = [[review(k, 1 + k % 3) for k in range(20)], [review(k, 4) for k in range(9)], [review(k, 1, 9, 0.9) for k in range(5)],
               [review(k, None) for k in range(4)], [], [review(1, 5)]]
    for number, reviews in enumerate(batches):
        seen += reviews
        for _ in range(2):  # a batch that is repeated after it was complete counts once
            merge(spark, folder, frame(spark, reviews), number)
        assert known(spark, folder) == direct(seen)
    assert len(_live(spark, folder)) == 6  # five months and the reviews without any
    for number in range(6, 14):
        merge(spark, folder, frame(spark, [review(number, 5)]), number)
    # One folder for each month that there is, not for each batch.
    assert sum(name.startswith("month=") for _, names, _ in os.walk(f"{folder}/months") for name in names) == 6


def test_a_batch_that_breaks_off_is_made_again(spark, tmp_path, monkeypatch):
    folder, first, second = str(tmp_path), [review(k, 1) for k in range(8)], [review(k, 1, 9) for k in range(6)]
    merge(spark, folder, frame(spark, first), 0)
    with monkeypatch.context() as broken:  # after the write, before the versions it replaces are gone
        broken.setattr(scored_replay, "_clean", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge(spark, folder, frame(spark, second), 1)
    assert known(spark, folder) == direct(first + second)
    merge(spark, folder, frame(spark, second), 1)
    assert known(spark, folder) == direct(first + second)
    os.remove(f"{folder}/months/batch=1/_SUCCESS")  # a write that did not end does not count
    assert known(spark, folder) == []


def test_closed_months(spark, tmp_path):
    folder = str(tmp_path)
    merge(spark, folder, frame(spark, [review(1, 6)]), 0, open_months=2)
    late = [review(1, 3), review(2, 3)]
    merge(spark, folder, frame(spark, [review(1, 4), *late, review(2, None)]), 1, open_months=2)
    assert known(spark, folder) == direct([review(1, 6), review(1, 4), review(2, None)])
    assert spark.read.parquet(f"{folder}/late/batch=1").count() == 2


def test_stream_stays_with_its_model_over_a_restart(spark, tmp_path):
    columns = [f"CAST(pmod(xxhash64(id, {k}), 1000) AS DOUBLE) / 100 AS {c}" for k, c in enumerate(fv.MODEL_FEATURES)]
    features = spark.range(4000).selectExpr(
        "CAST(id AS STRING) AS review_id", "concat('b', id % 40) AS business_id",
        "timestampadd(DAY, CAST(id % 900 AS INT), TIMESTAMP'2018-01-01 05:00:00') AS review_timestamp", *columns).selectExpr(
        "*", "CAST(trunc(review_timestamp, 'month') AS DATE) AS review_month")
    features = spark.createDataFrame(features.collect(), features.schema)
    first, other = (train(features, str(tmp_path / f"model{s}"), training_months=6, min_rows=100, trees=10, seed=s) for s in (1, 2))
    assert version_of(first) != version_of(other)
    source, folder = str(tmp_path / "source"), str(tmp_path / "run")
    halves = [features.where(f"CAST(review_id AS INT) % 2 = {k}") for k in (0, 1)]
    halves[0].repartition(2).write.parquet(source)
    arriving = spark.readStream.schema(features.schema).option("maxFilesPerTrigger", 1).parquet(source)
    replay_with_model(arriving, folder, first)
    halves[1].repartition(2).write.mode("append").parquet(source)
    # What breaks off in the middle goes on at the next run; another model that is offered then is not taken.
    calls = []

    def fails_once(batch):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return batch
    with pytest.raises(Exception):
        replay_with_model(arriving, folder, other, prepare=fails_once)
    replay_with_model(arriving, folder, other, prepare=fails_once)
    assert pinned(spark, folder)[0] == version_of(first)

    def months(scored):
        return sorted((r["business_id"], str(r["m"]), r["n"], round(r["a"], 9)) for r in scored.groupBy("business_id", "m").agg(
            {"*": "count", "anomaly_score": "avg"}).withColumnsRenamed({"count(1)": "n", "avg(anomaly_score)": "a"}).collect())
    whole = months(score_reviews(features, first).withColumnRenamed("review_month", "m"))
    assert whole == sorted((r["business_id"], str(r["review_month"]), r["review_count"], round(r["avg_anomaly_score"], 9))
                           for r in stored_months(spark, folder).collect())
    assert pinned(spark, folder, other, renew=True)[0] == version_of(other) == pinned(spark, folder)[0]
    with pytest.raises(ValueError):
        pinned(spark, str(tmp_path / "empty"))
