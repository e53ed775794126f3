"""A fixed-size sample that is the same for any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive, hash_uniform, num

FEW = 8  # copies up to which a row is decided on before the shuffle


def hash_sample(
    df: DataFrame,
    key: str,
    max_rows: int,
    total_rows: int,
    seed: int,
    draw: str = "copy",
    bound: bool = False,
) -> DataFrame:
    """About ``max_rows`` of ``total_rows`` rows, without replacement; with ``bound`` never more.

    Rows that are equal in every column are first counted into one; of c equal
    rows floor(c * share + u(key)) are kept. So a row that fills a third of the
    table enters in proportion, costs no more than any other in the shuffle, and
    the expected size is exactly ``max_rows``. ``draw`` numbers the copies kept.

    Whether a row with few copies stays is decided by u(key) before anything is
    shuffled, so about FEW * max_rows rows travel. Rows with more copies are found
    by a count of 8-byte hashes and join them.
    """
    share = min(1.0, max_rows / max(total_rows, 1))
    kept = "_copies" if share == 1.0 else (
        f"CAST(floor(_copies * {num(share)} + {hash_uniform(seed, 'sample', key)}) AS BIGINT)")
    if FEW * share < 1:
        chance = hash_uniform(seed, "sample", key)
        whole = f"xxhash64({', '.join(f'`{c}`' for c in df.columns)})"
        likely = f"{chance} >= {num(1 - FEW * share)}"
        many = df.selectExpr(f"{whole} AS _hash").groupBy("_hash").count().where(f"count > {FEW}").select("_hash")
        frequent = df.where(f"NOT ({likely})").withColumn("_hash", F.expr(whole)).join(many, "_hash", "left_semi")
        df = df.where(likely).unionByName(frequent.drop("_hash"))
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    drawn = (
        derive(counted, {"_kept": kept}).where("_kept > 0")
        .selectExpr(*df.columns, f"explode(sequence(1L, _kept)) AS {draw}")
    )
    # the excess is a few standard deviations of the sample's size
    return drawn.orderBy(F.expr(hash_uniform(seed, "bound", key, draw)), *drawn.columns).limit(max_rows) if bound else drawn
