import gzip
import json

import pytest

from vigil.operators.moderation import latest_labels
from vigil.sources.reviews import (
    build_products, ingest, load_categories, load_metadata, load_reviews, normalise_reviews, parse_metadata, read_raw_reviews,
)
from vigil.sources.tables import (
    append_labels, counted, export_csv, read_categories, read_labels, read_table, require_columns, write_categories, write_table,
)


def write_lines(path, records):
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


BASE = {"parent_asin": "P1", "asin": "V1", "user_id": "u", "timestamp": 1588687728923, "rating": 4.0,
        "helpful_vote": 2, "title": "t", "text": "x", "verified_purchase": True}


def test_reviews_from_json_lines(spark, tmp_path):
    path = write_lines(tmp_path / "r.jsonl", [
        BASE, {**BASE, "timestamp": 1588687728}, {**BASE, "parent_asin": None}, {**BASE, "rating": None},
        {**BASE, "parent_asin": None, "asin": None}, {"asin": "V2", "timestamp": "1588687728", "rating": "5"}, {**BASE, "rating": "bad"}])
    rows = load_reviews(spark, path, "beauty").orderBy("review_id").collect()
    assert len(rows) == 4
    assert {str(r["review_timestamp"]) for r in rows} == {"2020-05-05 14:08:48"}
    assert sorted(r["business_id"] for r in rows) == ["P1", "P1", "V1", "V2"]
    bare = next(r for r in rows if r["business_id"] == "V2")
    assert (bare["text"], bare["review_title"], bare["useful"], bare["verified_purchase"], bare["user_id"]) == (
        "", "", 0.0, False, None)


def test_identity_is_a_hash_of_the_raw_record(spark, tmp_path):
    import hashlib
    path = write_lines(tmp_path / "r.jsonl", [BASE])
    row = load_reviews(spark, path, "beauty").first()
    assert row["review_id"] == hashlib.sha256(b"P1||u||1588687728923||x").hexdigest()


def test_reviews_are_required_and_category_checked(spark, tmp_path):
    with pytest.raises(Exception):
        load_reviews(spark, str(tmp_path / "none.jsonl"), "beauty").count()
    with pytest.raises(ValueError):
        normalise_reviews(spark.createDataFrame([("a",)], "asin string"), "")


def test_absent_columns_are_null(spark):
    raw = spark.createDataFrame([("A", 10, 3.0)], "asin string, timestamp long, rating double")
    row = normalise_reviews(raw, "c").first()
    assert row["parent_asin"] is None and row["business_id"] == "A" and row["stars"] == 3.0


def test_metadata_takes_one_title_per_key(spark):
    lines = spark.createDataFrame([(json.dumps(r),) for r in (
        {"parent_asin": "A", "item_name": "b"}, {"asin": "A", "title": "a"}, {"title": "no key"}, {"asin": "C"})], "value string")
    assert {r["asin"]: r["product_title"] for r in parse_metadata(lines).collect()} == {"A": "a", "C": None}


def test_missing_metadata_is_no_obstacle(spark, tmp_path):
    path = write_lines(tmp_path / "r.jsonl", [BASE])
    metadata = load_metadata(spark, str(tmp_path / "none.jsonl"))
    product = build_products(load_reviews(spark, path, "c"), "c", metadata).first()
    assert product["product_title"] is None and product["listed_review_count"] == 1


def test_tables_by_month_and_export(spark, tmp_path):
    df = spark.createDataFrame([("a", "2020-01-01", 1.0), ("b", "2020-02-01", 2.0)], "k string, m string, x double")
    df = df.selectExpr("k", "CAST(m AS DATE) AS review_month", "x")
    watched, seen = counted(df, "t")
    write_table(watched, str(tmp_path / "t"), by_month=True)
    assert seen.get["rows"] == 2
    back = read_table(spark, str(tmp_path / "t")).where("review_month >= DATE'2020-02-01'")
    assert [r["k"] for r in back.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(review_month" in back._jdf.queryExecution().executedPlan().toString()
    folder = export_csv(df, str(tmp_path / "csv"), 1, [df.x.desc()])
    assert folder.endswith("csv-first-1")
    assert [r["k"] for r in spark.read.option("header", True).csv(folder).collect()] == ["b"]
    with pytest.raises(RuntimeError):
        require_columns(df, "product_title")


def test_labels_append_and_vocabulary(spark, tmp_path):
    path = str(tmp_path / "labels")
    one = spark.createDataFrame([("r", "unsure", "")], "review_id string, label string, notes string")
    append_labels(one, path)
    append_labels(one, path)
    assert read_labels(spark, path).count() == 2
    with pytest.raises(Exception):
        append_labels(one.selectExpr("review_id", "'maybe' AS label", "notes"), path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folder_with_compressed_files(spark, tmp_path):
    """Rows of compressed files are dealt out after the scan, those of others stay; every row is read once."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for k in range(3):
        with gzip.open(folder / f"{k}.jsonl.gz", "wt") as f:
            f.write("\n".join(json.dumps({**BASE, "user_id": f"z{k}-{i}"}) for i in range(50)))
    assert "Exchange RoundRobin" in plan(read_raw_reviews(spark, str(folder)))
    write_lines(folder / "plain.jsonl", [{**BASE, "user_id": f"p{i}"} for i in range(20)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        raw = read_raw_reviews(spark, str(folder), keep_broken=True)
        users = [r["user_id"] for r in raw.collect()]
        shown, leaves = plan(raw), raw._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(users) == len(set(users)) == 170
    assert shown.count("Exchange RoundRobin") == 1 and "Union" in shown and shown.count("Scan json") == 2
    assert sorted(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())) == [1, 3]
    assert "Exchange" not in plan(read_raw_reviews(spark, str(folder / "plain.jsonl")))


def test_rejected_records_are_kept_with_their_reason(spark, tmp_path):
    cut = json.dumps(BASE)[:-1]
    lines = [json.dumps(r) for r in (
        BASE, BASE, {**BASE, "rating": None}, {**BASE, "rating": "bad", "timestamp": None}, {**BASE, "timestamp": "soon"},
        {**BASE, "asin": None, "parent_asin": None, "rating": None})] + [cut, "no json", "", "5"]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    taken = ingest(read_raw_reviews(spark, str(tmp_path / "r.jsonl"), keep_broken=True), str(tmp_path / "out"), "beauty")
    assert taken.counts == {"accepted": 2, "malformed": 3, "no product": 1, "no rating": 2, "no time": 1}
    assert taken.reviews.columns == load_reviews(spark, str(tmp_path / "r.jsonl"), "beauty").columns
    assert taken.reviews.exceptAll(load_reviews(spark, str(tmp_path / "r.jsonl"), "beauty")).count() == 0
    kept = [(r["rejection"], r["record"]) for r in taken.rejected.collect()]
    assert sorted(r for kind, r in kept if kind == "malformed") == sorted([cut, "no json", "5"])
    assert [json.loads(r)["timestamp"] for kind, r in kept if kind == "no time"] == ["soon"]
    assert "PartitionFilters: [isnotnull(rejection" in plan(taken.reviews)


def test_nothing_to_ingest(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text("")
    taken = ingest(read_raw_reviews(spark, str(tmp_path / "r.jsonl"), keep_broken=True), str(tmp_path / "out"), "beauty")
    assert taken.reviews.count() == taken.rejected.count() == sum(taken.counts.values()) == 0


def test_categories_replace_themselves_alone(spark, tmp_path):
    paths = {name: write_lines(tmp_path / f"{k}.jsonl", [{**BASE, "user_id": f"{name}{i}"} for i in range(3)])
             for k, name in enumerate(("hair/skin", "007", "7"))}
    table = str(tmp_path / "table")
    write_categories(load_categories(spark, paths), table)
    before = {f for f in read_categories(spark, table).inputFiles()}
    assert {(r["category"], r["count"]) for r in read_categories(spark, table).groupBy("category").count().collect()} == {
        ("hair/skin", 3), ("007", 3), ("7", 3)}
    write_categories(load_categories(spark, {"007": paths["007"]}).limit(1), table)
    assert {(r["category"], r["count"]) for r in read_categories(spark, table).groupBy("category").count().collect()} == {
        ("hair/skin", 3), ("007", 1), ("7", 3)}
    after = {f for f in read_categories(spark, table).inputFiles()}
    assert len(before & after) == len(before) - 1
    one = read_categories(spark, table, "007")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(category" in plan(one)
    with pytest.raises(ValueError):
        load_categories(spark, {})
    with pytest.raises(Exception):
        write_categories(one.selectExpr("review_id", "CAST(NULL AS STRING) AS category"), table)


def test_latest_label_is_combined_by_hash(spark):
    rows = [("a", "unsure", "2024-01-01 00:00:00.000001"), ("a", "suspicious", "2024-01-01 00:00:00"), ("b", "unsure", None),
            ("b", "suspicious", "1950-01-01 00:00:00"), ("c", "not suspicious", "2024-01-01 00:00:00"),
            ("c", "unsure", "2024-01-01 00:00:00"), ("d", "suspicious", None), ("e", None, "2024-01-01 00:00:00"), (None, "unsure", None)]
    log = spark.createDataFrame(rows, "review_id string, label string, saved_at string").selectExpr(
        "review_id", "label", "CAST(saved_at AS TIMESTAMP) AS saved_at")
    last = latest_labels(log)
    assert {r["review_id"]: (r["label"], str(r["saved_at"])) for r in last.collect()} == {
        "a": ("unsure", "2024-01-01 00:00:00.000001"), "b": ("suspicious", "1950-01-01 00:00:00"),
        "c": ("unsure", "2024-01-01 00:00:00"), "d": ("suspicious", "None")}
    assert "HashAggregate" in plan(last) and "SortAggregate" not in plan(last)
    with pytest.raises(Exception, match="unknown label"):
        latest_labels(log.selectExpr("review_id", "'maybe' AS label", "saved_at")).collect()
