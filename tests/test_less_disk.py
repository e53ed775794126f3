"""What queries over many reviews leave on disks: shuffles of written stages, and tables that are read once."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

from vigil.functions import display
from vigil.functions.sql import derive
from vigil.operators import fraud
from vigil.operators.as_of import history
from vigil.operators.features import build_review_features
from vigil.plans.queries import AS_OF_COLUMNS, EXPLAINED, Inputs, StagedExplanations, stored_by_month
from vigil.session import DROPS_SHUFFLES, shared_folder, shuffles_dropped, written_table
from vigil.sources import fixtures as fx
from vigil.sources.reviews import ingest, read_raw_reviews

SMALL = "/root/testdata/sf0.001"
START = datetime(2020, 1, 1)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_a_written_table_are_gone(spark):
    """Before, they stayed until the driver collected its garbage."""
    before, setting = shuffle_files(spark), spark.conf.get(DROPS_SHUFFLES)
    table = written_table(spark, spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counted")
    left = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
    assert not left and table.count() == 7 and sum(r["count"] for r in table.collect()) == 1000
    assert spark.conf.get(DROPS_SHUFFLES) == setting
    spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(DROPS_SHUFFLES) == "true"
    finally:
        spark.conf.unset(DROPS_SHUFFLES)


def test_the_past_is_shuffled_by_second_once(spark):
    """Before, the days and the seconds of a day each combined the rows again."""
    rows = [(f"k{n % 3}", START + timedelta(hours=n), float(n % 5)) for n in range(50)]
    df = spark.createDataFrame(rows, "k string, at timestamp, x double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        past = history(df, "k", "at", {"mean": "x", "high": "CASE WHEN x > 2 THEN 1.0D ELSE 0.0D END"}, "earlier")
        plan = past._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("ReusedExchange") == 1 and "_c0" in plan and "_c1" not in plan


def test_averages_as_of_then_from_a_narrow_table(spark):
    """The past comes from four columns, rows are written between the joins, and nothing else changes."""
    x = Inputs(spark, SMALL)
    products = x.described(x.dated_history)
    plain = build_review_features(x.reviews, x.described(x.reviews), as_of=True).select(*AS_OF_COLUMNS)
    lean = build_review_features(x.reviews, products, as_of=True, history=x.dated_history, kept=AS_OF_COLUMNS).select(*AS_OF_COLUMNS)
    assert lean.count() == 6000 and lean.exceptAll(plain).count() == plain.exceptAll(lean).count() == 0
    files = {f.rsplit("/", 2)[-2].split("-")[0] for f in lean.inputFiles()}
    assert "lineitem.parquet" not in {f.rsplit("/", 1)[-1] for f in lean.inputFiles()} and {"as", "per"} <= files
    stage = next(f for f in lean.inputFiles() if "/as-of-" in f).rsplit("/", 1)[0]
    assert not {"text", "clean_review_text"} & set(spark.read.parquet(stage).columns)


def test_lines_with_documents_are_dealt_to_all_tasks(spark):
    """Before, adaptive execution gathered these few rows, whose texts are long, in one or two tasks."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = fx.raw_reviews(spark, SMALL).select("text")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_doc#" in plan and f", {tasks}" in plan.split("RepartitionByExpression [_doc#")[1].splitlines()[0]


def test_a_rejected_record_is_written_once(spark, tmp_path):
    """Before, its text stood in the record and in a column beside it, and files were twice as large for want of zstd."""
    review = {"asin": "A", "user_id": "u", "timestamp": "1600000000", "rating": "5", "text": "a text", "title": None}
    lines = [json.dumps(r) for r in (review, review, {**review, "rating": None}, {**review, "timestamp": "soon"})]
    (tmp_path / "r.jsonl").write_text("\n".join([*lines, lines[0][:-1]]))
    taken = ingest(read_raw_reviews(spark, str(tmp_path / "r.jsonl"), keep_broken=True), str(tmp_path / "out"), "beauty")
    assert taken.counts == {"accepted": 2, "malformed": 1, "no product": 0, "no rating": 1, "no time": 1}
    assert [r["text"] for r in taken.reviews.collect()] == ["a text"] * 2
    kept = {r["rejection"]: r["record"] for r in taken.rejected.collect()}
    assert kept["malformed"] == lines[0][:-1] and all(json.loads(kept[k])["text"] == "a text" for k in ("no rating", "no time"))
    rows = spark.read.parquet(str(tmp_path / "out")).where("rejection <> 'accepted'").drop("rejection", "record").collect()
    assert len(rows) == 3 and all(v is None for r in rows for v in r)
    files = [f for _, _, names in os.walk(tmp_path / "out") for f in names if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_features_by_month_leave_one_table(spark):
    """Before, what they were made of stayed, and shuffles of the joins stood beside the one by month."""
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    assert stored_by_month(Inputs(spark, SMALL)).count() > 1000
    assert [f.split("-")[0] for f in set(os.listdir(folder)) - before] == ["features"]


def test_reviews_before_the_cutoff_are_stored_without_names(spark):
    """Before, their ids and the digests of their texts were stored too, though nothing names or compares them."""
    x = StagedExplanations(spark, SMALL)
    early, late = (x.with_score.where(f"review_month {sign} DATE'{x.cutoff[0]}'") for sign in ("<", ">="))
    assert early.count() and early.where("coalesce(review_id, _copy_key, _text) IS NOT NULL").count() == 0
    assert late.count() and late.where("review_id IS NULL OR _copy_key IS NULL OR _text IS NULL").count() == 0
    assert set(EXPLAINED) <= set(x.with_score.columns) and "sentence_count" not in x.with_score.columns


def test_what_is_said_of_a_text_is_taken_once(spark, monkeypatch):
    """Explanations by marks are those by texts; the rows meet the marks, or few texts, by a broadcast."""
    texts = [None, "", "Great product", "x" * 30, "water, glycerin, " * 12, "plain words", "nan", "a<br>b"]
    odd = [float("nan"), None, 5.0, 1.0, -0.0, 0.6, 2.0, float("inf")]
    rows = [(f"r{n}", texts[n % 8], *[odd[(n * k + k) % 8] for k in (1, 2, 3, 5, 7)]) for n in range(64)]
    columns = "review_id string, clean_review_text string, stars double, word_count double, review_length double, reviewer_average_rating double, uppercase_share double"
    reviews = fraud.with_text_key(spark.createDataFrame(rows, columns))
    few, told = reviews.drop("clean_review_text"), derive(reviews, {"review_text": "clean_review_text"})
    expected = sorted(map(tuple, derive(told, {"said": display.review_explanation(told)}).select("review_id", "said").collect()))
    marked = fraud.with_texts(few, reviews, {"_marks": display.text_marks("clean_review_text")})
    assert "clean_review_text" not in marked.columns
    assert sorted(map(tuple, derive(marked, {"said": display.review_explanation(marked)}).select("review_id", "said").collect())) == expected
    number = derive(told, {"stars": display.number_or("stars")})
    assert sorted(map(tuple, derive(number, {"said": display.review_explanation(number)}).select("review_id", "said").collect())) == expected
    for characters in (1 << 25, -1):
        monkeypatch.setattr(fraud, "TEXT_CHARACTERS", characters)
        shown = fraud.with_texts(derive(few, {"review_length": "30.0D"}), reviews)
        assert sorted(map(str, shown.select("review_id", "clean_review_text").collect())) == sorted(
            map(str, reviews.select("review_id", "clean_review_text").collect()))
        assert ("_join__text" in shown._jdf.queryExecution().optimizedPlan().toString()) == (characters < 0)
