"""Reviews, metadata and labels derived from the test tables.

Lineitems play the reviews: the supplier is the product, the customer the
reviewer, the ship date the review time. Twelve text styles are dealt by key;
one of them carries the whole text of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.sql import derive
from vigil.functions.sql import text as sql_text
from vigil.sources.reviews import normalise_reviews, parse_metadata, parse_raw_reviews

CATEGORY = "catalogue"

# The texts dealt to reviews by style number (None: a whole document).
TEXT_STYLES = (
    "Great product! Love it",
    "perfect",
    "Five stars. Highly recommend. Must buy!",
    "sooooo good!!!!! BUY IT",
    "I used this cream for two weeks and my skin is dry. However the smell is nice. It arrived late.",
    "Nice<br />color<br>but<BR/>small<br>size<br>package",
    "WORTH EVERY PENNY amazing product",
    "Bad. Broke after one week",
    "ok|fine. meh",
    None,
    "",
    "xAbcdefghijAbcdefghijAbcdefghijAbcdefghijAbcdefghijAbcdefghijAbcdefghij",
)


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The test tables are one split each. A session that sets vigil.fixture.partitions has their rows dealt to as
    many partitions before costly text work; without it nothing is dealt."""
    partitions = df.sparkSession.conf.get("vigil.fixture.partitions", None)
    return df.repartition(int(partitions)) if partitions else df


def raw_reviews(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Raw records as they would stand in a review file."""
    documents = table(spark, sf_dir, "documents")
    numbered = documents.selectExpr("doc_id AS _doc", "text AS _document")
    lines = spread(table(spark, sf_dir, "lineitem")) if lineitem is None else lineitem
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    whole = TEXT_STYLES.index(None)
    styled = derive(lines, {"_style": f"(l_orderkey * 7 + l_partkey * 13 + l_linenumber) % {len(TEXT_STYLES)}"})
    told = " ".join(f"WHEN {i} THEN {sql_text(t)}" for i, t in enumerate(TEXT_STYLES) if t is not None)
    key, seconds = "concat('B', l_suppkey)", "unix_timestamp(CAST(l_shipdate AS TIMESTAMP))"
    columns = (
        f"CASE WHEN l_linenumber != 1 THEN {key} END AS parent_asin",
        f"CASE WHEN l_linenumber = 1 THEN {key} ELSE concat('V', l_partkey) END AS asin",
        "CASE WHEN o_custkey % 50 != 0 THEN concat('U', o_custkey) END AS user_id",
        f"CASE WHEN l_linenumber % 2 = 0 THEN {seconds} * 1000 ELSE {seconds} END AS timestamp",
        "CASE WHEN l_quantity > 25 THEN 5.0D WHEN l_quantity < 6 THEN 1.0D "
        "ELSE CAST(ceil(l_quantity / 10) AS DOUBLE) END AS rating",
        "CASE WHEN l_tax > 0 THEN round(l_tax * 100) END AS helpful_vote",
        "o_orderpriority AS title",
    )
    # only the lines that carry a document meet the documents; the others, most of them, are not dealt out by one
    keyed = styled.where(f"_style = {whole}").withColumn("_documents", documents.agg(F.count("*")).scalar())
    carrying = derive(keyed.join(orders, F.expr("l_orderkey = o_orderkey")), {"_doc": "l_orderkey % _documents"})
    others = styled.where(f"NOT (_style <=> {whole})").join(orders, F.expr("l_orderkey = o_orderkey"))
    # few narrow rows with long texts to come: adaptive execution would gather them in one or two tasks by what they weigh before
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    carrying = carrying.repartition(tasks, "_doc")
    verified = "l_returnflag != 'R' AS verified_purchase"
    return carrying.join(numbered, "_doc", "left").selectExpr(*columns, "_document AS text", verified).union(
        others.selectExpr(*columns, f"CASE _style {told} END AS text", verified))


def raw_review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON texts."""
    raw = raw_reviews(spark, sf_dir)
    return raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))


def faulty_review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON texts with a fault by title: lines cut off, records without a rating, a time or a product."""
    raw = raw_reviews(spark, sf_dir)
    faulty = derive(raw, {
        "rating": "CASE WHEN title <> '2-HIGH' THEN rating END",
        "timestamp": "CASE WHEN title = '3-MEDIUM' THEN 'soon' ELSE CAST(timestamp AS STRING) END",
        **{c: f"CASE WHEN title <> '4-NOT SPECIFIED' THEN {c} END" for c in ("parent_asin", "asin")}})
    lines = faulty.select("title", F.to_json(F.struct(*raw.columns)).alias("line"))
    return lines.selectExpr("CASE WHEN title = '1-URGENT' THEN left(line, length(line) - 1) ELSE line END AS value")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_reviews(raw_reviews(spark, sf_dir), CATEGORY)


def reviews_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_reviews(parse_raw_reviews(raw_review_lines(spark, sf_dir)), CATEGORY)


def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata texts for nine suppliers of ten; key and title stand in varying fields, some keys twice."""
    supplier = table(spark, sf_dir, "supplier").where("s_suppkey % 10 != 0")
    key, holder = "concat('B', s_suppkey)", ("title", "name", "product_title", "item_name")
    titles = ", ".join(f"CASE WHEN s_suppkey % 4 = {i} THEN s_name END AS {h}" for i, h in enumerate(holder))
    first = supplier.selectExpr(
        f"to_json(struct(CASE WHEN s_suppkey % 3 != 0 THEN {key} END AS parent_asin, "
        f"CASE WHEN s_suppkey % 3 = 0 THEN {key} ELSE 'variant' END AS asin, {titles})) AS value")
    second = supplier.where("s_suppkey % 7 = 0").selectExpr(
        f"to_json(struct({key} AS asin, concat('Alternate ', s_name) AS title)) AS value")
    keyless = supplier.where("s_suppkey % 9 = 0").selectExpr("to_json(struct(s_name AS title)) AS value")
    return first.unionByName(second).unionByName(keyless)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_metadata(metadata_lines(spark, sf_dir))
