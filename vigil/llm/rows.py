"""Row numbers that stay the same, and verdicts on some rows brought to all rows without moving the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

FILES = 200_000        # files whose numbers are broadcast
IDS = 500_000          # changes that are broadcast
BITS = 28              # with more, a filter of 2^BITS bits is, 32 MB of bitmaps at most
POSITION = 32_768      # bits of a bitmap, as bitmap_construct_agg makes them


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc): every row of ``docs`` as a struct, with a number of its own that is the same whenever it is computed.

    For a table as it was read, the number is that of the file (by a small table written once) and the place in it, so nothing
    is copied. Any other frame is written once with its numbers.
    """
    spark = docs.sparkSession
    packed = F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc")
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return written_table(spark, docs.select(F.monotonically_increasing_id().alias("row"), packed), "numbered")
    hidden = docs.metadataColumn("_metadata")
    files = written_table(spark, docs.select(hidden["file_path"].alias("file")).distinct().selectExpr(
        "file", "row_number() OVER (ORDER BY file) AS number"), "files")
    known = F.broadcast(files) if files.limit(FILES + 1).count() <= FILES else files
    placed = docs.select(packed, hidden["file_path"].alias("file"), hidden["row_index"].alias("at"))
    return placed.join(known, "file").selectExpr("CAST(number AS BIGINT) * 1099511627776L + at AS row", "doc")


def beside(rows: DataFrame, changes: DataFrame, ids: int = IDS) -> DataFrame:
    """``rows`` with the columns of ``changes`` where their ``row`` is in it (at most once), else null.

    Up to ``ids`` changes, with up to four times as many values in lists, are broadcast. More are first turned into a filter of bounded size, which is broadcast; rows that it
    lets pass have no change and are not shuffled.
    """
    spark = rows.sparkSession
    lists = [f"size({f.name})" for f in changes.schema if f.dataType.typeName() == "array"]
    held = changes.agg(F.count("*"), F.expr(f"coalesce(sum({' + '.join(lists) or 0}), 0)")).first()
    if held[0] <= ids and held[1] <= 4 * ids:
        return rows.join(F.broadcast(changes), "row", "left")
    bit = f"pmod(xxhash64(row), {1 << BITS}L)"
    marks = written_table(spark, changes.selectExpr(f"{bit} AS bit").groupBy(
        F.expr(f"bit div {POSITION}").alias("_bucket")).agg(F.expr(f"bitmap_construct_agg(bit % {POSITION})").alias("_marks")), "marks")
    placed = derive(derive(rows, {"_bit": bit}), {"_bucket": f"_bit div {POSITION}", "_at": f"_bit % {POSITION}"})
    byte = "CAST(conv(hex(substring(_marks, CAST(_at div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    flagged = placed.join(F.broadcast(marks), "_bucket", "left").withColumn(
        "_met", F.expr(f"_marks IS NOT NULL AND shiftright({byte}, CAST(_at % 8 AS INT)) & 1 = 1"))
    touched = flagged.where("_met").select(*rows.columns).join(changes, "row", "left")
    rest = flagged.where("NOT _met").selectExpr(*rows.columns, *[
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in changes.schema if f.name != "row"])
    return touched.unionByName(rest)
