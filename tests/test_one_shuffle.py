"""Reviews are dealt once by their case, each different text is fetched once, and statistics share one narrow table."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from vigil.operators import fraud
from vigil.plans.queries import Inputs, StagedKeys
from vigil.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def reviews(spark):
    rows = [(f"r{n}", f"b{n % 3}" if n % 10 else None, "2020-01-01" if n % 2 else "2020-02-01",
             None if n % 7 == 0 else f"k{n % 4}", f"u{n}", float(n % 5)) for n in range(60)]
    return spark.createDataFrame(rows, "review_id string, business_id string, review_month string, _copy_key string, user_id string, stars double")


@pytest.mark.parametrize("limits", [{}, {"broadcast_table": 0}, {"rows_per_task": 1}, {"rows_per_task": 9, "broadcast_table": 0}])
def test_copies_in_cases_against_all_pairs(spark, limits):
    scored = reviews(spark)
    cases = scored.where("business_id IS NULL OR business_id <> 'b2'").groupBy("business_id", "review_month").agg(F.count("*").alias("n"))
    got = fraud.reviews_of_cases(scored, cases, "n", **limits)
    rows = scored.collect()
    expected = {r["review_id"]: 1 if r["_copy_key"] is None else sum(
        (o["business_id"], o["review_month"], o["_copy_key"]) == (r["business_id"], r["review_month"], r["_copy_key"]) for o in rows)
        for r in rows if r["business_id"] in ("b0", "b1")}
    assert {r["review_id"]: r["near_duplicate_review_count"] for r in got.collect()} == expected
    assert got.count() == len(expected) and "_copy_key" not in got.columns and set(got.columns) > {"n", "stars", "business_id"}


def test_signals_and_ranks_share_one_shuffle(spark):
    """Before, the join by case, the count of copies and the rank dealt the reviews anew each time."""
    x = StagedKeys(spark, SMALL)
    plan = fraud.surfaced(x.signals).selectExpr("row_number() OVER (PARTITION BY business_id, review_month ORDER BY stars) AS place", "review_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_each_different_text_is_fetched_once(spark, monkeypatch):
    texts = spark.createDataFrame([("a", "same"), ("b", "same"), ("c", "other"), ("d", ""), ("e", None), ("f", "nobody's")],
                                  "review_id string, clean_review_text string")
    few = fraud.with_text_key(texts).where("review_id <> 'f'").drop("clean_review_text")
    for limit in (1_000_000, 0):
        monkeypatch.setattr(fraud, "TEXT_KEYS", limit)
        got = fraud.with_texts(few, texts)
        assert sorted(map(tuple, got.collect()), key=str) == [("a", "same"), ("b", "same"), ("c", "other"), ("d", ""), ("e", None)]
    stored = next(f for f in got.inputFiles() if "/per-key-" in f).rsplit("/", 1)[0]
    assert spark.read.parquet(stored).count() == 4


def test_statistics_share_one_narrow_table(spark):
    """Before, products, reviewers and months each joined the tables that reviews are made of again."""
    x = Inputs(spark, SMALL)
    for frame in (x.products, x.months):
        files = [f for f in frame.inputFiles() if "supplier" not in f]
        assert files and all("/history-" in f for f in files)
    assert x.features.inputFiles() and set(x.history.columns) == {"business_id", "user_id", "stars", "review_month"}
    plain = sorted(map(str, x.described(x.reviews).collect()))
    assert sorted(map(str, x.products.collect())) == plain


def test_only_lines_with_a_document_meet_the_documents(spark, tmp_path):
    """Before, all lines were dealt out by a document; now the others, of odd keys too, keep their one row."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(300).selectExpr("*", "l_orderkey AS key")
    odd = lines.selectExpr(*[f"CASE WHEN key % 9 = 0 THEN NULL ELSE {c} END AS {c}" if c == "l_partkey" else c for c in lines.columns]).drop("key")
    odd.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{SMALL}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 3 > 0")
    documents.unionByName(documents.where("doc_id % 5 = 0")).write.parquet(f"{tmp_path}/documents.parquet")
    raw = fx.raw_reviews(spark, str(tmp_path))
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") == 1 and plan.index("Union") < plan.index("LeftOuter")
    texts = {}
    for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    n, expected = sum(map(len, texts.values())), []
    for r in odd.collect():
        style = None if r["l_partkey"] is None else (r["l_orderkey"] * 7 + r["l_partkey"] * 13 + r["l_linenumber"]) % len(fx.TEXT_STYLES)
        expected += [None] if style is None else texts.get(r["l_orderkey"] % n, [None]) if fx.TEXT_STYLES[style] is None else [fx.TEXT_STYLES[style]]
    assert sorted(map(str, (r["text"] for r in raw.collect()))) == sorted(map(str, expected))
