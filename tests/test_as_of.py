"""Statistics as of the time of a row, against a version that looks at every earlier row."""

import random
from datetime import datetime, timedelta

import pytest

from vigil.operators.as_of import attach_history
from vigil.operators.features import build_review_features
from vigil.session import prepare

SCHEMA = "n long, k string, at timestamp, x double, mean double"
START = datetime(2020, 1, 1)


def attached(df, **limits):
    return attach_history(df, "k", "at", {"before": "x", "high": "CASE WHEN x > 2 THEN 1.0D ELSE 0.0D END"}, "earlier", ["n"], **limits)


def expected(rows):
    out = {}
    for n, k, at, *_ in rows:
        past = [r for r in rows if k is not None and at is not None and r[1] == k and r[2] is not None
                and r[2].replace(microsecond=0) < at.replace(microsecond=0)]
        xs = [r[3] for r in past if r[3] is not None]
        out[n] = (len(past), sum(xs) / len(xs) if xs else None,
                  sum(r[3] is not None and r[3] > 2 for r in past) / len(past) if past else None)
    return out


def random_rows(n=400, hot=0.4):
    draw = random.Random(5)
    rows = []
    for i in range(n):
        key = "hot" if draw.random() < hot else draw.choice(["a", "b", "c", None])
        at = None if draw.random() < 0.05 else START + timedelta(
            days=draw.choice([-20000, 0, 1, 2, 40]), seconds=draw.choice([0, 1, 1, 86399, draw.randrange(86400)]), microseconds=draw.randrange(10**6))
        rows.append((i, key, at, draw.choice([None, 1.0, 2.0, 3.0, 4.5]), 9.0))
    return rows


@pytest.mark.parametrize("limits", [{}, {"rows_per_task": 2}, {"rows_per_task": 2, "broadcast_keys": 0}])
@pytest.mark.parametrize("partitions", [1, 7])
def test_against_every_earlier_row(spark, limits, partitions):
    rows = random_rows()
    df = attached(spark.createDataFrame(rows, SCHEMA).repartition(partitions), **limits)
    assert set(df.columns) == {"n", "k", "at", "x", "mean", "earlier", "before", "high"}
    got = {r["n"]: (r["earlier"], r["before"], r["high"]) for r in df.collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for n, (count, before, high) in want.items():
        assert got[n][0] == count
        assert got[n][1] == (None if before is None else pytest.approx(before))
        assert got[n][2] == (None if high is None else pytest.approx(high))


def test_empty_and_keyless(spark):
    assert attached(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(0, None, START, 1.0, 0.0), (1, "a", None, 1.0, 0.0), (1, "a", None, 1.0, 0.0)]
    got = attached(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["earlier"], r["before"], r["high"]) for r in got] == [(0, None, None)] * 3


def test_windows_are_bounded_by_the_clock(spark):
    """Rows are combined by key and second before any window, and no window is by key alone over seconds."""
    from vigil.operators.as_of import history
    plan = history(spark.createDataFrame(random_rows(), SCHEMA), "k", "at", {"before": "x"}, "earlier")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in f" {line}" or "+- Window" in line]
    assert len(windows) == 2
    assert sum("_day#" in line.split("], [")[-2] for line in windows) == 1


def test_features_do_not_see_the_future(spark):
    prepare(spark)
    columns = "review_id string, user_id string, business_id string, stars double, text string, useful double, funny double, cool double, review_timestamp timestamp"
    rows = [(f"r{i}", "u" if i % 2 else None, "b", float(s), "text", 0.0, 0.0, 0.0, START + timedelta(days=i)) for i, s in enumerate((5, 1, 3, 4))]
    df = spark.createDataFrame(rows, columns)
    products = spark.createDataFrame([("b", "b", "c", 3.25, 4, "T")],
                                     "business_id string, product_id string, category string, listed_business_stars double, listed_review_count long, product_title string")
    got = {r["review_id"]: r for r in build_review_features(df, products, as_of=True).collect()}
    assert [got[f"r{i}"]["business_average_stars"] for i in range(4)] == [None, 5.0, 3.0, 3.0]
    assert [got[f"r{i}"]["rating_deviation_from_product_average"] for i in range(4)] == [0.0, -4.0, 0.0, 1.0]
    assert [got[f"r{i}"]["reviewer_review_count"] for i in range(4)] == [0.0, 0.0, 0.0, 1.0]
    assert got["r3"]["reviewer_average_rating"] == 1.0 and got["r3"]["reviewer_one_star_share"] == 1.0
    assert {r["product_title"] for r in got.values()} == {"T"}
    assert not {"listed_business_stars", "listed_review_count"} & set(got["r0"].asDict())
    cut = build_review_features(df.where("review_timestamp < TIMESTAMP'2020-01-03'"), products, as_of=True).collect()
    assert {r["review_id"]: r for r in cut} == {k: v for k, v in got.items() if k in ("r0", "r1")}


def test_full_run_with_faulty_lines_and_earlier_reviews_alone(spark, tmp_path):
    from vigil.plans.full_run import Options, run
    from vigil.sources import fixtures as fx
    small = "/root/testdata/sf0.001"
    fx.faulty_review_lines(spark, small).write.text(str(tmp_path / "reviews"))
    fx.metadata_lines(spark, small).write.text(str(tmp_path / "meta"))
    options = Options("catalogue", trees=5, min_training_rows=200, keep_rejected=True, as_of=True)
    done = run(spark, str(tmp_path / "reviews"), str(tmp_path / "meta"), str(tmp_path / "out"), options)
    counts = done.counts["ingested"]
    assert sum(counts.values()) == 6000 and all(counts.values())
    assert done.counts["reviews"]["rows"] == counts["accepted"] == done.counts["review_features"]["rows"]
    assert {r["rejection"]: r["count"] for r in done.tables["rejected_records"].groupBy("rejection").count().collect()} == {
        kind: n for kind, n in counts.items() if kind != "accepted"}
    first = done.tables["review_features"].where("user_id IS NULL").selectExpr("max(reviewer_review_count)").first()[0]
    assert first == 0.0
