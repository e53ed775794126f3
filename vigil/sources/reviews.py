"""Raw review and metadata readers, and their normalised forms."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import fixed_values as fv
from vigil.functions.sql import derive, text
from vigil.session import shuffles_dropped

LOGGER = logging.getLogger(__name__)

# Scalars are read as text and cast afterwards: a number written as a string
# (or the other way round) is then no reason to lose a row, and no inference
# pass over the files is needed.
RAW_REVIEW = T.StructType([T.StructField(name, T.StringType()) for name in (
    "parent_asin", "asin", "user_id", "timestamp", "rating", "helpful_vote",
    "title", "text", "verified_purchase")])
BROKEN = "_corrupt_record"
METADATA = T.StructType([T.StructField("asin", T.StringType()), T.StructField("product_title", T.StringType())])


def check_category(category: str | None) -> str:
    if not category:
        raise ValueError("a category is needed")
    return category


UNSPLITTABLE = (".gz", ".gzip", ".deflate", ".snappy")


def read_raw_reviews(spark: SparkSession, path: str, partitions: int | None = None, keep_broken: bool = False) -> DataFrame:
    """JSON lines of a file or of a folder. Rows of files that cannot be split, by their names, are dealt to all tasks of a
    shuffle after the scan, or to ``partitions``; rows of other files stay where they are read unless ``partitions`` is given.

    With ``keep_broken`` the text of a line that is no JSON record stands in the column BROKEN, else all its fields are NULL.
    """
    schema = T.StructType([*RAW_REVIEW.fields, T.StructField(BROKEN, T.StringType())]) if keep_broken else RAW_REVIEW
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", BROKEN).json(path)
    if partitions:
        return raw.repartition(partitions)
    whole = [name.endswith(UNSPLITTABLE) for name in raw.inputFiles()]
    if not any(whole):
        return raw
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if all(whole):
        return raw.repartition(tasks)
    # conditions on the file's name choose files before anything is read, so each file is read once
    ends = " OR ".join(f"endswith(_metadata.file_name, '{end}')" for end in UNSPLITTABLE)
    return raw.where(ends).repartition(tasks).unionByName(raw.where(f"NOT ({ends})"))


def parse_raw_reviews(lines: DataFrame, value: str = "value", keep_broken: bool = False) -> DataFrame:
    """The same records from a table that holds one JSON text per row (extra columns are kept)."""
    others = [c for c in lines.columns if c != value]
    schema = T.StructType([*RAW_REVIEW.fields, T.StructField(BROKEN, T.StringType())]) if keep_broken else RAW_REVIEW
    return lines.withColumn("_raw", F.from_json(value, schema, {"columnNameOfCorruptRecord": BROKEN})).select(*others, "_raw.*")


def epoch_to_timestamp(epoch: str) -> str:
    """Seconds, or milliseconds when the number is too large for seconds; fractions are cut off."""
    number = f"try_cast({epoch} AS DOUBLE)"
    seconds = f"CASE WHEN {number} > {fv.MILLISECOND_EPOCH_ABOVE} THEN {number} / 1000.0D ELSE {number} END"
    return f"timestamp_seconds(try_cast({seconds} AS BIGINT))"


# Why a record is no review; the first reason that holds counts.
REASONS = {
    "malformed": f"{BROKEN} IS NOT NULL",
    "no product": "business_id IS NULL",
    "no rating": "stars IS NULL",
    "no time": "review_timestamp IS NULL",
}
ACCEPTED = "accepted"


def normalise_reviews(raw: DataFrame, category: str) -> DataFrame:
    return _with_review_columns(raw, category).where("business_id IS NOT NULL AND stars IS NOT NULL AND review_timestamp IS NOT NULL")


def judge_reviews(raw: DataFrame, category: str) -> DataFrame:
    """Every record with its normalised columns, the reason why it is no review (``accepted`` for reviews), and, of the others,
    the record: the broken line, or the fields that were read as JSON."""
    have = [c for c in raw.columns if c != BROKEN]
    if BROKEN not in raw.columns:
        raw = raw.withColumn(BROKEN, F.lit(None).cast("string"))
    whole = derive(raw, {"_record": f"coalesce({BROKEN}, to_json(struct({', '.join(f'`{c}`' for c in have)})))"})
    judged = derive(_with_review_columns(whole, category, BROKEN, "_record"), {
        "rejection": "CASE " + " ".join(f"WHEN {holds} THEN '{reason}'" for reason, holds in REASONS.items()) + f" ELSE '{ACCEPTED}' END"})
    return derive(judged, {"record": f"CASE WHEN rejection <> '{ACCEPTED}' THEN _record END"}).drop(BROKEN, "_record")


@dataclass
class Ingested:
    """Reviews, the records that are none with their reason, and how many there are of each."""

    reviews: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def ingest(raw: DataFrame, out: str, category: str) -> Ingested:
    """Judges raw records in one pass and writes them under ``out``, reviews and each kind of rejected records apart.

    A rejected record is written as it was read; columns of a review, its text among them, are not written beside it once more.
    """
    spark, seen = raw.sparkSession, Observation("ingest")
    judged = judge_reviews(raw, category)
    judged = derive(judged, {c: f"CASE WHEN rejection = '{ACCEPTED}' THEN `{c}` END" for c in judged.columns if c not in ("rejection", "record")}
                    ).select(*judged.columns)
    watched = judged.observe(seen, *[
        F.expr(f"count_if(rejection = '{kind}')").alias(kind) for kind in (ACCEPTED, *REASONS)])
    with shuffles_dropped(spark):
        watched.write.mode("overwrite").partitionBy("rejection").parquet(out, compression="zstd")
    written = spark.read.schema(judged.schema).parquet(out)
    return Ingested(written.where(f"rejection = '{ACCEPTED}'").drop("rejection", "record"),
                    written.where(f"rejection <> '{ACCEPTED}'").select("rejection", "record"), seen.get)


def _with_review_columns(raw: DataFrame, category: str, *others: str) -> DataFrame:
    check_category(category)
    have = set(raw.columns)
    field = lambda name: name if name in have else "CAST(NULL AS STRING)"
    number = lambda name: f"try_cast({field(name)} AS DOUBLE)"
    product = f"coalesce({field('parent_asin')}, {field('asin')})"
    body = f"coalesce({field('text')}, '')"
    when = epoch_to_timestamp(field("timestamp"))
    identity = f"concat_ws('||', {product}, {field('user_id')}, CAST({field('timestamp')} AS STRING), {body})"
    return raw.selectExpr(
        f"sha2({identity}, 256) AS review_id",
        f"{field('user_id')} AS user_id",
        f"{product} AS business_id",
        f"{product} AS product_id",
        f"{text(category)} AS category",
        f"{field('asin')} AS asin",
        f"{field('parent_asin')} AS parent_asin",
        f"{number('rating')} AS stars",
        f"coalesce({number('helpful_vote')}, 0.0D) AS useful",
        "0.0D AS funny",
        "0.0D AS cool",
        f"{body} AS text",
        f"coalesce({field('title')}, '') AS review_title",
        f"coalesce(try_cast({field('verified_purchase')} AS BOOLEAN), false) AS verified_purchase",
        f"{when} AS review_timestamp",
        f"{when} AS review_datetime",
        *others,
    )


def load_reviews(spark: SparkSession, path: str, category: str, partitions: int | None = None) -> DataFrame:
    """Reviews are required: a missing path raises when the plan is analysed."""
    return normalise_reviews(read_raw_reviews(spark, path, partitions), category)


def load_categories(spark: SparkSession, paths: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Reviews of several categories (name: path); each row carries the name of its own."""
    if not paths:
        raise ValueError("a category is needed")
    return reduce(DataFrame.unionByName, [load_reviews(spark, path, category, partitions) for category, path in paths.items()])


def parse_metadata(lines: DataFrame, value: str = "value") -> DataFrame:
    """One title per product key out of JSON texts.

    Of several titles the smallest that is not blank is taken, so the choice does not depend on file order.
    """
    at = lambda *names: f"coalesce({', '.join(f'get_json_object({value}, ' + text('$.' + n) + ')' for n in names)})"
    return (
        lines.selectExpr(
            f"{at('parent_asin', 'asin')} AS asin",
            f"{at('title', 'name', 'product_title', 'item_name')} AS product_title",
        )
        .where("asin IS NOT NULL")
        .distinct()
        .groupBy("asin")
        .agg(F.expr("coalesce(min(CASE WHEN trim(product_title) <> '' THEN product_title END), min(product_title))")
             .alias("product_title"))
    )


def load_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata is optional: without it products simply have no title."""
    try:
        return parse_metadata(spark.read.text(path))
    except AnalysisException as problem:
        LOGGER.warning("no product metadata at %s, going on without: %s", path, problem)
        return spark.createDataFrame([], METADATA)


def build_products(reviews: DataFrame, category: str, metadata: DataFrame | None = None) -> DataFrame:
    """One row per product: listing statistics, title and descriptive defaults."""
    check_category(category)
    listed = reviews.groupBy("business_id").agg(
        F.avg("stars").alias("listed_business_stars"),
        F.count("*").alias("listed_review_count"),
    )
    if metadata is None:
        titled = listed.withColumn("product_title", F.lit(None).cast("string"))
    else:
        titled = listed.join(metadata.withColumnRenamed("asin", "business_id"), "business_id", "left")
    return derive(titled, {
        "product_id": "business_id",  # equal since ingest
        "category": text(category),
        "average_rating": "CAST(NULL AS DOUBLE)",
        "business_name": "product_title",
        "city": "''",
        "state": "''",
        "categories": text(category),
    })


def with_output_defaults(features: DataFrame, dataset: str) -> DataFrame:
    """Columns later stages rely on, added where the source lacks them."""
    defaults = {"product_id": "business_id", "review_title": "''", "verified_purchase": "CAST(NULL AS BOOLEAN)"}
    missing = {name: value for name, value in defaults.items() if name not in features.columns}
    return derive(features, {"dataset": text(dataset), **missing})
