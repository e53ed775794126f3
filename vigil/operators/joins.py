"""Attaching per-key statistics to a big table without a hot partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

ROWS_PER_TASK = 2_000_000   # a key with as many rows is not left to one task of the shuffle
BROADCAST_TABLE = 500_000    # keys up to which the whole table of statistics is broadcast and no row moves
BROADCAST_KEYS = 200_000     # heavy keys that are matched by a broadcast; with more, they are salted
SPREAD = 1 << 20
SHARES = 64                  # shares a heavy key is dealt into when salted


def packed(rows: DataFrame) -> DataFrame:
    """Ids that are digests in hexadecimal go through the joins as bytes, half as long; others as they are."""
    if "_id" in rows.columns or dict(rows.dtypes).get("review_id") != "string":
        return rows
    shorter = derive(rows, {"_id": "CASE WHEN lower(hex(unhex(review_id))) = review_id THEN unhex(review_id) END"})
    return derive(shorter, {"review_id": "CASE WHEN _id IS NULL THEN review_id END"})


def unpacked(rows: DataFrame) -> DataFrame:
    return derive(rows, {"review_id": "coalesce(lower(hex(_id)), review_id)"}).drop("_id") if "_id" in rows.columns else rows


def attach_by_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    inner: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_keys: int = BROADCAST_KEYS,
    *,
    broadcast_table: int = BROADCAST_TABLE,
) -> DataFrame:
    """Join ``rows`` with ``per_key``, which has one row per key and its row count in ``weight``.

    Counted to be at most ``broadcast_table`` keys, they are all broadcast and ``rows`` stay where they are. Of more,
    keys with ``rows_per_task`` rows or more are heavy; by their weight there are
    at most total / rows_per_task of them, found by a filter. Counted to be at most
    ``broadcast_keys``, they are matched by a broadcast; their rows, and rows with a
    NULL key, then pass the shuffled join under a NULL key and are dealt over all
    partitions by a hash of ``spread_by``. More of them are salted instead: their
    one row is repeated for each of SHARES shares, and their rows are dealt among
    these. All other keys meet their single match as usual. The dealing depends on row
    content only, so a recomputed task sends its rows to the same places.
    """
    payload = [c for c in per_key.columns if c not in keys]
    known = per_key.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).selectExpr(
        *keys, f"struct({', '.join(payload)}) AS _cold")
    known = written_table(rows.sparkSession, known, "per-key")  # read twice, and counted
    if known.limit(broadcast_table + 1).count() <= broadcast_table:
        joined = rows.join(F.broadcast(known), keys, "inner" if inner else "left")
        return joined.selectExpr(*rows.columns, *[f"_cold.{c} AS {c}" for c in payload])
    heaviest = known.where(f"_cold.{weight} >= {rows_per_task}").withColumnRenamed("_cold", "_hot")
    heavy = heaviest.limit(broadcast_keys + 1).count()
    if heavy > broadcast_keys:
        return _salted(rows, known, keys, payload, weight, spread_by, inner, rows_per_task)
    settled = " OR ".join(["_hot IS NOT NULL", *[f"{k} IS NULL" for k in keys]])
    found = rows.join(F.broadcast(heaviest), keys, "left") if heavy else derive(rows, {
        "_hot": f"CAST(NULL AS {known.schema['_cold'].dataType.simpleString()})"})
    routed = derive(found, {
        **{f"_join_{k}": f"CASE WHEN NOT ({settled}) THEN {k} END" for k in keys},
        "_spread": f"CASE WHEN {settled} THEN pmod(xxhash64({', '.join(spread_by)}), {SPREAD}L) ELSE 0L END",
    })
    cold = known.selectExpr(*[f"{k} AS _join_{k}" for k in keys], "_cold",
                            f"pmod(xxhash64({', '.join(keys)}), 1L) AS _spread")  # a plain 0 would be optimised out of the join key
    joined = routed.join(cold, [*[f"_join_{k}" for k in keys], "_spread"], "left")
    if inner:
        joined = joined.where("_hot IS NOT NULL OR _cold IS NOT NULL")
    return joined.selectExpr(*rows.columns, *[f"coalesce(_hot, _cold).{c} AS {c}" for c in payload])


def _salted(rows, known, keys, payload, weight, spread_by, inner, rows_per_task):
    """Every row picks a share by its content; a heavy key's row stands in all shares, another one's in share 0."""
    flags = known.selectExpr(*keys, f"_cold.{weight} >= {rows_per_task} AS _heavy", "_cold")
    shared = flags.selectExpr(*keys, "_cold", f"explode(sequence(0L, CASE WHEN _heavy THEN {SHARES - 1}L ELSE 0L END)) AS _share")
    marks = flags.where("_heavy").select(*keys, F.lit(True).alias("_heavy"))
    dealt = derive(rows.join(marks, keys, "left"), {
        "_share": f"CASE WHEN _heavy THEN pmod(xxhash64({', '.join(spread_by)}), {SHARES}L) ELSE 0L END"})
    joined = dealt.join(shared, [*keys, "_share"], "inner" if inner else "left")
    return joined.selectExpr(*rows.columns, *[f"_cold.{c} AS {c}" for c in payload])
