from pyspark.sql import functions as F

from vigil.operators.features import build_review_features
from vigil.operators.fraud import fraud_signals, top_suspicious_reviews, with_copy_counts
from vigil.operators.joins import attach_by_key
from vigil.plans.queries import QUERIES, COPY_COLUMNS, Staged, StagedCopies, StagedKeys, StagedRanks, StagedSignals, StagedTexts

SMALL = "/root/testdata/sf0.001"
SCHEMA = ("review_id string, user_id string, business_id string, stars double, useful double, funny double, cool double, "
          "text string, review_timestamp timestamp")


def rows(spark, ids):
    return spark.createDataFrame(
        [(i, f"u{n % 3}" if n % 4 else None, f"b{n % 2}", float(n % 5 + 1), 0.0, 0.0, 0.0, "so dry", None) for n, i in enumerate(ids)],
        SCHEMA).withColumn("review_timestamp", F.expr("TIMESTAMP'2020-01-01 00:00:00'"))


def test_few_keys_are_broadcast_and_rows_stay(spark):
    left = spark.range(600).selectExpr("id", "CASE WHEN id % 7 > 0 THEN concat('k', id % 5) END AS k")
    per_key = left.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    expected = sorted(map(str, left.join(per_key, "k", "left").select("id", "k", "n", "first").collect()))
    for inner in (False, True):
        seen = set()
        for limits in ({}, {"broadcast_table": 4}, {"broadcast_table": 0, "rows_per_task": 100},
                       {"broadcast_table": 0, "rows_per_task": 1, "broadcast_keys": 0}):
            got = attach_by_key(left, per_key, ["k"], "n", ["id"], inner=inner, **limits)
            assert got.columns == ["id", "k", "n", "first"]
            seen.add(tuple(sorted(map(str, got.collect()))))
        assert len(seen) == 1
        assert inner or list(seen.pop()) == expected
    plan = attach_by_key(left, per_key, ["k"], "n", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_ids_of_any_form_come_back(spark, monkeypatch):
    ids = ["ab" * 32, "AB" * 32, "abc", "", "0f", "0F", None, "x1", "ab" * 32, " 0f"]
    for limit in (500_000, 0):
        monkeypatch.setattr(attach_by_key, "__defaults__", (*attach_by_key.__defaults__[:-1], limit))
        for as_of in (False, True):
            got = build_review_features(rows(spark, ids), as_of=as_of)
            assert sorted(str(r["review_id"]) for r in got.collect()) == sorted(map(str, ids))
            assert "_id" not in got.columns


def test_texts_are_neither_joined_nor_stored(spark):
    keys, whole = StagedKeys(spark, SMALL), StagedTexts(spark, SMALL)
    assert not {"text", "clean_review_text"} & set(keys.with_score.columns)
    top = lambda x, texts: sorted(map(str, top_suspicious_reviews(fraud_signals(x.scored, x.kept_queue), 3, texts=texts).collect()))
    assert top(keys, keys.texts) == top(whole, whole.scored) == top(whole, None) != []


def test_stages_are_written_with_zstd(spark):
    files = Staged(spark, SMALL).with_score.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_stages_hold_what_their_query_asks_for(spark):
    """All columns of a review were stored for each of these queries, and texts fetched for those that show none."""
    keys, ranks = StagedKeys(spark, SMALL), StagedRanks(spark, SMALL)
    assert QUERIES["duplicate_reviews"][0] is StagedCopies and QUERIES["fraud_signals"][0] is StagedSignals
    copies = StagedCopies(spark, SMALL).with_score
    assert set(copies.columns) == set(COPY_COLUMNS)
    held = set(keys.with_score.columns)
    assert set(ranks.with_score.columns) < held and not {"asin", "parent_asin", "review_datetime", "categories"} & held
    shown = [c for c in ranks.top.columns if c in keys.top.columns]
    assert not {"review_text", "review_text_preview"} & set(shown) and {"review_id", "fraud_like_score", "near_duplicate_review_count"} < set(shown)
    assert sorted(map(str, ranks.top.select(shown).collect())) == sorted(map(str, keys.top.select(shown).collect())) != []
    assert "/few-" not in str(ranks.top.inputFiles()) and "/few-" in str(keys.top.inputFiles())


def test_copies_are_counted_over_packed_ids(spark, monkeypatch):
    ids = ["ab" * 32, "AB" * 32, "abc", None, "0f", "ab" * 32]
    df = rows(spark, ids).withColumn("review_month", F.expr("DATE'2020-01-01'"))
    for limit in (500_000, 0):
        monkeypatch.setattr(attach_by_key, "__defaults__", (*attach_by_key.__defaults__[:-1], limit))
        got = with_copy_counts(df)
        assert sorted(map(str, [r["review_id"] for r in got.collect()])) == sorted(map(str, ids)) and "_id" not in got.columns
        assert {r["near_duplicate_review_count"] for r in got.collect()} == {3}
