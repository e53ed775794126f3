"""The queries of the subpackage and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (
    chat,
    decontamination,
    hard_negatives,
    licenses,
    line_quality,
    manifest,
    near_duplicates,
    pieces,
    revisits,
    secrets,
    surrogates,
    token_files,
    url_filter,
)
from vigil.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(licenses.TEMPLATES, "license string, text string")
    headers = spark.createDataFrame(licenses.HEADERS, "license string, text string")
    return licenses.licensed(licenses.files_of(table(spark, sf_dir, "documents")), templates, keep=("doc_id",), headers=headers)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents")).drop("row", "removed")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), rules)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encoded(table(spark, sf_dir, "documents")))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame(chat.ADDED, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.conversation_digests(chat.formatted_turns(chat.events_of(turns)))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymised(table(spark, sf_dir, "documents"), key="op7")
    return found.selectExpr("doc.doc_id AS doc_id", "text", "n_entities", *[
        f"coalesce(CAST(found['{t}'] AS BIGINT), 0L) AS n_{t}" for t in surrogates.PATTERNS])


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.shown(revisits.resolved(revisits.records_of(table(spark, sf_dir, "pages"))))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents")).drop("row", "grp")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings")).withColumn("label", F.expr(
        "CASE WHEN vec_id % 7 = 0 THEN CAST((CAST(label AS DECIMAL(20, 0)) + 1) % 10 AS BIGINT) ELSE label END"))
    return hard_negatives.hard_negatives(rows, "vec_id % 100 = 0")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.digests(token_files.token_files(spark, path))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}


ORACLE_SQL = {
    "op2_licenses": licenses.ORACLE,
    "op3_line_quality": line_quality.ORACLE,
    "op4_url_filter": url_filter.ORACLE,
    "op6_chat": chat.ORACLE,
    "op8_revisits": revisits.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op10_near_duplicates": near_duplicates.ORACLE,
    "op11_manifest": manifest.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
