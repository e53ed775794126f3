"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Dates and months are taken in UTC; nothing else about the caller's session is changed."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, as the cluster names it.

    Only a local session without the setting gets a temporary folder: on a
    cluster a machine-local path would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="vigil-"))
    return context.getCheckpointDir()


def deleted(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_run_folder: ContextVar[str | None] = ContextVar("run folder", default=None)


@contextmanager
def scratch_run(spark: SparkSession):
    """Intermediate tables written inside live in one folder, which is deleted at the end.

    For runs that write their results before they end; a frame handed out lazily must outlive this.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        deleted(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = _run_folder.get() or shared_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a table written inside are deleted when it stands, as nothing reads them any more; else they stay
    until the driver collects its garbage. The caller's own setting is put back."""
    before = spark.conf.get(DROPS_SHUFFLES, None)
    spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROPS_SHUFFLES) if before is None else spark.conf.set(DROPS_SHUFFLES, before)


def written_table(spark: SparkSession, df, name: str, **options):
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
