"""A training corpus from documents, stage by stage; every stage is one operator of vigil.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontamination, line_quality, near_duplicates, pieces, surrogates
from vigil.llm.rows import beside, numbered
from vigil.session import deleted, scratch_path, scratch_run, written_table

KEY = "corpus"  # of the surrogates; a corpus that is given away needs a secret one
CHUNK = 1 << 18  # characters that the tokens stage encodes at once: its workers stand beside an executor that earlier stages have filled
SHINGLE = 5  # words in a shingle of the near_dedup stage; four are the contract of op10_near_duplicates alone


def _settled(spark: SparkSession, name: str, make) -> DataFrame:
    """The rows of ``make()``, written; all tables that it writes on the way are deleted."""
    path = scratch_path(spark, name)
    with scratch_run(spark):
        found = make()
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _documents(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("doc").getField(c).alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that too many documents of their host share.

    A null text is empty, and an empty one is rejected; a null source is a host of its own; a null doc_id counts as the last
    one. A document that loses lines has a new n_chars.
    """
    rows = numbered(docs)

    def judged():
        found = line_quality.line_quality(rows.select("row", "doc.doc_id", "doc.text", "doc.source"), row="row")
        return found.where("NOT kept OR removed IS NOT NULL").selectExpr("row", "NOT kept AS gone", "CASE WHEN kept THEN removed END AS removed")
    changes = _settled(spark, "verdicts", judged)
    kept = beside(rows, changes).where("gone IS NULL OR NOT gone")
    shown = line_quality.without_lines(kept, "doc.text", "removed").withColumn("doc", F.expr("doc").withField("text", F.col("shown")).withField(
        "n_chars", F.expr("CASE WHEN removed IS NULL THEN doc.n_chars ELSE CAST(length(shown) AS BIGINT) END")))
    return _documents(shown, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Null, empty and blank texts are duplicates of nothing and stay; a null doc_id counts as the largest, and of repeated rows
    one stays.
    """
    rows = numbered(docs)

    def leaving():
        found = written_table(spark, near_duplicates.near_duplicates(rows.select("row", "doc.doc_id", "doc.text"), row="row", size=SHINGLE),
                              "found")
        return found.join(near_duplicates.one_of_each(found), "row", "left_anti").selectExpr("row", "true AS gone")
    return _documents(beside(rows, _settled(spark, "leaving", leaving)).where("gone IS NULL"), docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; null, empty and blank texts have none, nor have such items any."""
    rows = numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def hit():
        found = decontamination.contamination(rows.select("row", "doc.doc_id", "doc.text"), items, row="row")
        return found.where("n_hit > 0").selectExpr("row", "true AS gone")
    return _documents(beside(rows, _settled(spark, "hit", hit)).where("gone IS NULL"), docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; null and empty texts stay. A text with an entity has a new n_chars."""
    found = surrogates.pseudonymised(docs, key=KEY).withColumn("doc", F.expr("doc").withField("text", F.col("text")).withField(
        "n_chars", F.expr("CASE WHEN n_entities = 0 THEN doc.n_chars ELSE CAST(length(text) AS BIGINT) END")))
    return _documents(found, docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as piece ids; a null or empty text has none."""
    return pieces.encoded(docs, keep=("doc_id", "lang", "source", "n_chars"), chunk=CHUNK).selectExpr(
        "doc_id", "lang", "source", "n_chars", "CAST(size(ids) AS BIGINT) AS n_pieces", "ids")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("private", private), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's table is deleted once the next one is written; the last one stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_run(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before:
            deleted(spark, before)
        before = path
    return docs


ORACLE_SQL = None
