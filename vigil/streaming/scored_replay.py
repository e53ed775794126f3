"""Reviews scored by a stored model as they arrive, and product-months merged as they change.

A folder holds one replay:

  checkpoint/            of the stream
  model/version=V/       the model that is pinned; V is a digest of its tables
  months/batch=N/month=M/  sums of month M after batch N; only the newest one of each month is live
  late/batch=N/          scored reviews of months that the caller had closed

A batch is a version of the months it touches: it is written beside the ones before and counts once it is complete. So a batch
that is repeated, or breaks off anywhere, neither counts twice nor loses a month, and what is read has one folder for each month,
however many batches there were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.operators.rollup import DESCRIPTION, KEY, MEANS
from vigil.operators.training import Model, scorer
from vigil.session import deleted, scratch_path

SUMS = ("review_count", *[f"{k}_{c}" for c in MEANS.values() for k in ("sum", "count")])
SCHEMA = ("business_id string, review_month date, review_count long, max_anomaly_score double, "
          + ", ".join(f"sum_{c} double, count_{c} long" for c in MEANS.values()) + ", batch long, month string")
MONTH = "coalesce(date_format(review_month, \"'m'yyyy-MM\"), 'none')"  # no value that reads as a date or a null


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def _parts(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of the partition folders ``column=value`` in a folder; empty if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    return [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]


def version_of(model: Model) -> str:
    """A digest of the node table and the facts of the fit: the same for the same model, wherever it is stored."""
    def digest(table: DataFrame) -> int:
        return table.agg(F.expr(f"bit_xor(xxhash64({', '.join(sorted(table.columns))}))")).first()[0] or 0
    return f"{(digest(model.nodes) ^ digest(model.meta)) & (2**64 - 1):016x}"


def pinned(spark: SparkSession, folder: str, model: Model | None = None, renew: bool = False) -> tuple[str, Model]:
    """(version, model) that a replay scores with: the one it began with, until ``renew`` pins another.

    Without a pinned model, ``model`` is stored in the folder and pinned; the newest complete copy counts.
    """
    held = [v for v in _parts(spark, f"{folder}/model", "version") if _exists(spark, f"{folder}/model/version={v}/pinned/_SUCCESS")]
    at = {v: spark.read.parquet(f"{folder}/model/version={v}/pinned").first()["at"] for v in held}
    version = version_of(model) if model and (renew or not held) else max(held, key=at.get, default=None)
    if version is None:
        raise ValueError("no model is pinned in this folder, and none is given")
    path = f"{folder}/model/version={version}"
    if version not in held:
        model.save(path)
    if version not in held or version != max(held, key=at.get):
        spark.range(1).select(F.lit(max(at.values(), default=0) + 1).alias("at")).write.mode("overwrite").parquet(f"{path}/pinned")
    return version, Model.load(spark, path)


def _sums(scored: DataFrame) -> DataFrame:
    """What some scored reviews add to each product-month. The key alone counts; what a product is called is its table's matter."""
    return scored.groupBy(*KEY).agg(
        F.count("*").alias("review_count"), F.max("anomaly_score").alias("max_anomaly_score"),
        *[F.expr(e) for c in MEANS.values() for e in (f"sum(CAST({c} AS DOUBLE)) AS sum_{c}", f"count({c}) AS count_{c}")])


def _live(spark: SparkSession, folder: str, upto: int | None = None) -> dict[str, int]:
    """Month -> newest complete batch that wrote it, of those below ``upto``."""
    live: dict[str, int] = {}
    for batch in sorted(int(b) for b in _parts(spark, f"{folder}/months", "batch")):
        path = f"{folder}/months/batch={batch}"
        if (upto is None or batch < upto) and _exists(spark, f"{path}/_SUCCESS"):
            live |= dict.fromkeys(_parts(spark, path, "month"), batch)
    return live


def _stored(spark: SparkSession, folder: str, live: dict[str, int]) -> DataFrame:
    """Sums of the given versions of months: one folder each, no other is opened."""
    paths = [f"{folder}/months/batch={batch}/month={month}" for month, batch in sorted(live.items())]
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", f"{folder}/months").parquet(*paths)


def _merged(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*KEY).agg(F.max("max_anomaly_score").alias("max_anomaly_score"), *[F.sum(c).alias(c) for c in SUMS])


def merge(spark: SparkSession, folder: str, scored: DataFrame, batch: int, open_months: int | None = None) -> None:
    """Adds one batch of scored reviews to the stored months; rewritten are the months that it touches.

    A batch that is already complete is left as it is. With ``open_months``, months further back than so many before the
    newest one known are closed: their reviews go to the late table instead, whole.
    """
    target = f"{folder}/months/batch={batch}"
    if not _exists(spark, f"{target}/_SUCCESS"):
        rows = derive(scored, {"review_month": "CAST(trunc(CAST(review_timestamp AS TIMESTAMP), 'month') AS DATE)"})
        before = _live(spark, folder, upto=batch)
        if open_months is not None:
            newest = max((m[1:] for m in before if m != "none"), default=None)
            closed = f"review_month < add_months(DATE'{newest}-01', -{open_months})" if newest else "false"
            rows.where(closed).write.mode("overwrite").parquet(f"{folder}/late/batch={batch}")
            rows = rows.where(f"NOT coalesce({closed}, false)")
        sums = _sums(rows)
        touched = {r["month"] for r in rows.select(F.expr(MONTH).alias("month")).distinct().collect()}  # a row per month
        old = _stored(spark, folder, {m: b for m, b in before.items() if m in touched})
        merged = _merged(old.select(*KEY, "max_anomaly_score", *SUMS).unionByName(sums))
        merged.withColumn("month", F.expr(MONTH)).repartition("month", F.expr("pmod(xxhash64(business_id), 8)")).write.mode(
            "overwrite").partitionBy("month").parquet(target)
    _clean(spark, folder, batch)


def _clean(spark: SparkSession, folder: str, batch: int) -> None:
    """Versions of months that a complete batch has replaced go, and batches without any month left."""
    replaced = set(_parts(spark, f"{folder}/months/batch={batch}", "month"))
    for other in (int(b) for b in _parts(spark, f"{folder}/months", "batch")):
        if other < batch:
            months = set(_parts(spark, f"{folder}/months/batch={other}", "month"))
            if months <= replaced:
                deleted(spark, f"{folder}/months/batch={other}")
                continue
            for month in months & replaced:
                deleted(spark, f"{folder}/months/batch={other}/month={month}")


def stored_months(spark: SparkSession, folder: str, products: DataFrame | None = None) -> DataFrame:
    """Every product-month so far, with the description columns of ``products`` (one row per business_id) if it is given."""
    months = _stored(spark, folder, _live(spark, folder)).select(
        *KEY, "review_count", "max_anomaly_score", *[F.expr(f"sum_{c} / nullif(count_{c}, 0)").alias(name) for name, c in MEANS.items()])
    if products is None:
        return months
    return months.join(products.select("business_id", *DESCRIPTION), "business_id", "left")


def replay_with_model(features: DataFrame, folder: str | None = None, model: Model | None = None, renew: bool = False,
                      open_months: int | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, **trigger) -> str:
    """Run a stream of review features to its end, scored by the pinned model; returns the folder of the replay.

    The model is read and broadcast once for a run, not for each batch. ``prepare`` may change a batch before it is scored.
    Rows before the model's cutoff are left out, as in a batch run. The folder's checkpoint carries on from where the last run
    ended or broke off.
    """
    spark = features.sparkSession
    folder = folder or scratch_path(spark, "scored-replay")
    _, held = pinned(spark, folder, model, renew)
    score = scorer(held)

    def keep(batch: DataFrame, number: int) -> None:
        merge(spark, folder, score(prepare(batch) if prepare else batch), number, open_months)

    features.writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(keep).trigger(
        **(trigger or {"availableNow": True})).start().awaitTermination()
    return folder
