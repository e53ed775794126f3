"""Statistics of a key as they stood at the time of each row: no row sees its own future."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.operators.joins import attach_by_key

DAY = 86_400  # seconds in a slice of time
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def history(rows: DataFrame, key: str, time: str, measures: dict[str, str], count: str) -> DataFrame:
    """One row per key and second (_key, _second): rows of the key before that second, and their means.

    Rows are first combined by key and second. Prefix sums then run over the days of a key and, beside that, over the seconds
    of a day, so a window holds as many rows as there are days in the table or seconds in a day, however many rows a key has.
    Rows without a key or a time are no one's history. ``_rows`` is the number of rows of the second itself.
    """
    known = rows.where(f"`{key}` IS NOT NULL AND `{time}` IS NOT NULL").selectExpr(
        f"`{key}` AS _key", f"unix_seconds(`{time}`) AS _second", *[f"CAST({e} AS DOUBLE) AS _m{i}" for i, e in enumerate(measures.values())])
    sums, counts = {"_rows": "count(*)"}, {}
    for i in range(len(measures)):
        sums[f"_s{i}"] = f"sum(_m{i})"
        counts[i] = f"_c{i}" if known.schema[f"_m{i}"].nullable else "_rows"  # what is never NULL is there in every row
        sums |= {counts[i]: f"count(_m{i})"} if counts[i] != "_rows" else {}
    seconds = known.groupBy("_key", "_second").agg(*_named(sums))
    # known not to be NULL, so that no filter sets the two uses of this table apart and its shuffle serves both
    seconds = derive(seconds, {"_day": f"coalesce(CAST(floor(_second / {DAY}) AS BIGINT), 0L)"})
    days = seconds.groupBy("_key", "_day").agg(*_named({name: f"sum({name})" for name in sums}))
    earlier = days.selectExpr("_key", "_day", *[
        f"coalesce(sum({name}) OVER (PARTITION BY _key ORDER BY _day {BEFORE}), 0) AS _before{name}" for name in sums])
    same_day = derive(seconds, {
        f"_day{name}": f"coalesce(sum({name}) OVER (PARTITION BY _key, _day ORDER BY _second {BEFORE}), 0)" for name in sums})
    totals = same_day.join(earlier, ["_key", "_day"])
    return totals.selectExpr(
        "_key", "_second", "_rows", f"_before_rows + _day_rows AS `{count}`",
        *[f"try_divide(_before_s{i} + _day_s{i}, _before{counts[i]} + _day{counts[i]}) AS `{name}`" for i, name in enumerate(measures)])


def _named(expressions: dict[str, str]):
    return [F.expr(e).alias(name) for name, e in expressions.items()]


def attach_history(
    rows: DataFrame, key: str, time: str, measures: dict[str, str], count: str, spread_by: list[str],
    told_by: DataFrame | None = None, **limits,
) -> DataFrame:
    """``rows`` with means of ``measures`` (name: expression) over the earlier rows of the same key, and their ``count``.

    Earlier means in an earlier second; rows of one second do not see one another, whatever their order. A key's first
    rows, and rows without a key or a time, have a count of 0 and NULL means; a measure that is NULL is left out of its mean.
    Hot seconds and missing keys are dealt out as ``attach_by_key`` does, by a hash of ``spread_by``. ``told_by`` is a narrower
    table of the same rows (key, time and what is measured), if there is one: the past is then summed up from it.
    """
    keyed = derive(rows, {"_key": f"CASE WHEN `{time}` IS NOT NULL THEN `{key}` END", "_second": f"unix_seconds(`{time}`)"})
    past = history(rows if told_by is None else told_by, key, time, measures, count)
    found = attach_by_key(keyed, past, ["_key", "_second"], "_rows", spread_by, **limits)
    return derive(found.drop("_key", "_second", "_rows"), {count: f"coalesce(`{count}`, 0L)"})
