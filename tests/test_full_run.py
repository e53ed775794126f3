import pathlib

import pytest
from check import compare, in_duckdb

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    from vigil.plans.full_run import Options, run
    from vigil.sources import fixtures as fx
    folder = tmp_path_factory.mktemp("run")
    fx.raw_review_lines(spark, SMALL).write.text(str(folder / "reviews"))
    fx.metadata_lines(spark, SMALL).write.text(str(folder / "meta"))
    options = Options("catalogue", trees=20, max_train_rows=1500, top_reviews_per_case=3, csv_rows=7)
    return run(spark, str(folder / "reviews"), str(folder / "meta"), str(folder / "out"), options), folder


def test_stages_and_counts(done):
    result, _ = done
    assert result.counts["reviews"]["rows"] == 6000
    assert result.counts["products"] == {"rows": 10, "titled": 9}
    assert result.counts["scored_reviews"]["rows"] == result.tables["scored_reviews"].count() == 4234


def test_scores_queue_and_ranks(done):
    result, _ = done
    t = result.tables
    low, high = t["scored_reviews"].selectExpr("min(anomaly_score)", "max(anomaly_score)").first()
    assert 0 <= low <= high <= 1
    assert t["business_month_queue"].where("max_anomaly_score < 0.25").count() == 0
    assert t["business_month_queue"].where("explanation NOT LIKE '% was flagged for %'").count() == 0
    per_case = t["top_suspicious_reviews"].groupBy("business_id", "review_month").count()
    assert per_case.where("count > 3").count() == 0
    queued = t["business_month_queue"].select("business_id", "review_month")
    assert t["top_suspicious_reviews"].join(queued, ["business_id", "review_month"], "left_anti").count() == 0


def test_model_is_stored_and_scores_the_same(spark, done):
    from vigil.operators.training import Model, score_reviews
    result, folder = done
    model = Model.load(spark, str(folder / "out" / "model"))
    again = score_reviews(result.tables["review_features"], model)
    assert again.agg({"anomaly_score": "sum"}).first()[0] == pytest.approx(
        result.tables["scored_reviews"].agg({"anomaly_score": "sum"}).first()[0])
    facts = model.meta.first()
    assert 1350 < facts["training_rows"] <= 1500 and facts["trees"] == 20


def test_csv_extract_names_its_limit(spark, done):
    _, folder = done
    rows = spark.read.option("header", True).csv(str(folder / "out" / "csv" / "business_month_queue-first-7"))
    assert rows.count() == 7 and "decision_score" in rows.columns


def test_nothing_is_cut_or_left_behind(spark, done):
    from vigil.plans.full_run import Options
    from vigil.session import shared_folder
    assert Options("x").csv_rows is None and Options("x").max_train_rows is None
    _, folder = done
    assert not list(pathlib.Path(shared_folder(spark).removeprefix("file:")).glob("run-*"))
    assert not [p.name for p in (folder / "out").iterdir() if p.name.startswith("run-")]


@pytest.mark.parametrize("name", [
    "ingest_normalised", "text_flags", "review_features", "baseline_stats", "model_drift", "top_suspicious_reviews",
    "forest_nodes", "replay_behavioral_drift", "precision_by_threshold"])
def test_query_equals_its_sql(spark, name):
    import __spark_entry__ as entry
    ok, note = compare(entry.queries()[name](spark, SMALL), in_duckdb(SMALL), entry.oracle_sql()[name])
    assert ok, note


def test_every_query_has_sql():
    from vigil.plans.oracle import ORACLE_SQL
    from vigil.plans.queries import registered
    assert set(registered()) == set(ORACLE_SQL)


def test_stream_in_many_batches_equals_one_batch(spark, tmp_path):
    from vigil.operators.rollup import business_month_signals
    from vigil.plans.queries import Inputs
    from vigil.streaming.replay import current_months, replay_business_months
    x = Inputs(spark, SMALL)
    scored = x.scored.select("business_id", "review_timestamp", "review_month", "business_name", "product_title", "city", "state",
                             "stars", "is_extreme_rating", "review_length", "anomaly_score", "is_suspicious_review")
    source = str(tmp_path / "source")
    scored.repartition(4).write.parquet(source)
    arriving = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1).parquet(source)
    replayed = replay_business_months(arriving, folder=str(tmp_path / "run"))
    columns = ["business_id", "review_month", "review_count", "max_anomaly_score"]
    whole = sorted(map(tuple, business_month_signals(scored).select(*columns).collect()))
    assert sorted(map(tuple, replayed.select(*columns).collect())) == whole
    assert current_months(spark, str(tmp_path / "run")).count() == len(whole)


def test_signals_and_ranks_do_not_depend_on_partitions(spark):
    from vigil.operators.fraud import fraud_signals, top_suspicious_reviews
    from vigil.plans.queries import StagedTexts
    x = StagedTexts(spark, SMALL)
    queue, scored = x.kept_queue, x.scored
    seen = [sorted(map(str, top_suspicious_reviews(fraud_signals(scored.repartition(n), queue.repartition(n)), 3).collect()))
            for n in (1, 7, 64)]
    assert seen[0] and seen[0] == seen[1] == seen[2]


def test_no_text_is_shuffled_before_the_rank(spark):
    """What is joined and ranked has keys and numbers; texts come afterwards, for the rows that stay."""
    from vigil.operators import fraud
    from vigil.plans.queries import StagedTexts
    x = StagedTexts(spark, SMALL)
    plans = []

    def seen(few, reviews):
        plans.append(few._jdf.queryExecution().optimizedPlan().toString())
        return with_texts(few, reviews)
    with_texts, fraud.with_texts = fraud.with_texts, seen
    try:
        late = fraud.top_suspicious_reviews(x.signals, 3, texts=x.scored)
    finally:
        fraud.with_texts = with_texts
    above_scan = [line for line in plans[0].splitlines() if "Project" not in line and "Relation" not in line]
    assert any("Join" in line for line in above_scan) and not any("clean_review_text" in line for line in above_scan)
    joined = plans[0][:plans[0].rindex("Join")]
    assert "clean_review_text" not in joined
    early = fraud.top_suspicious_reviews(x.signals, 3)
    assert sorted(map(str, late.collect())) == sorted(map(str, early.collect())) and late.count()
