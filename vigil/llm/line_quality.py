"""Quality rules of single texts and of lines that many documents of a host share; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.operators.joins import attach_by_key
from vigil.session import written_table

LIMIT = 10        # documents of a host that may carry the same line
LEAST_SHARE = 20  # a document is depleted if fewer percent of its line characters remain
MIN_WORDS = 10
MAX_REPEATED = 20  # percent of the words that may stand in repeated windows
RUN = 5

BLANK = r"[\\x09-\\x0D ]"
LINES = r"split(text, '\\n')"
NORMAL = r"lower(trim(regexp_replace(line, '[0-9\\x09-\\x0D ]+', ' ')))"


def measured(docs: DataFrame) -> DataFrame:
    """Adds the rules of one text to rows with a column text; ``lines`` keeps one entry per line.

    An entry of lines has the hash and the length of the normalised line (lower
    case, runs of digits and white space one blank); both are null for a blank line.
    """
    filled = docs.withColumn("text", F.expr("coalesce(text, '')"))
    cut = derive(filled, {"_words": f"array_remove(split(text, '{BLANK}+'), '')", "_lines": LINES})
    hashed = derive(cut, {
        "_n": "size(_words)",
        "_spoken": f"filter(_lines, line -> line RLIKE '[^\\\\x09-\\\\x0D ]')",
        "_hashes": "transform(_words, w -> xxhash64(w))",
        "_normal": f"transform(_lines, line -> {NORMAL})"})
    windows = derive(hashed, {
        "_windows": f"CASE WHEN _n >= {RUN} THEN transform(sequence(1, _n - {RUN - 1}), "
                    f"i -> xxhash64(slice(_hashes, i, {RUN}))) ELSE array() END"})
    repeated = derive(windows, {
        "_sorted": "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN "
                   "sort_array(transform(_windows, (w, i) -> struct(w, i))) ELSE array() END"})
    placed = derive(repeated, {
        "_places": "sort_array(transform(filter(_sorted, (x, i) -> coalesce(get(_sorted, i - 1).w = x.w, false) "
                   "OR coalesce(get(_sorted, i + 1).w = x.w, false)), x -> x.i))"})
    ruled = derive(placed, {
        "n_words": "CAST(_n AS BIGINT)",
        "word_chars": "CAST(length(array_join(_words, '')) AS BIGINT)",
        "n_symbols": "CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '')) AS BIGINT)",
        "n_dup_lines": "CAST(size(_spoken) - size(array_distinct(_spoken)) AS BIGINT)",
        "n_repeat_words": f"""CAST(aggregate(_places, named_struct('n', 0, 'upto', 0), (a, i) -> named_struct(
            'n', a.n + i + {RUN} - greatest(a.upto, i), 'upto', i + {RUN}), a -> a.n) AS BIGINT)""",
        "lines": "transform(_normal, line -> CASE WHEN line <> '' THEN "
                 "named_struct('h', xxhash64(line), 'chars', length(line)) END)"})
    failed = derive(ruled, {
        "base_failed": f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"})
    return failed.drop(*[c for c in failed.columns if c.startswith("_")])


def line_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                 row: str | None = None, limit: int = LIMIT, least_share: int = LEAST_SHARE) -> DataFrame:
    """Verdict on every document: its own rules, then what is left of it without lines shared too widely.

    One row per input row: row, doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_chars and n_removed_chars (characters of normalised
    lines), removed (numbers of the removed lines, from 0; null if none), kept.

    A line that stands in more than ``limit`` documents of a host is removed from all of them. A document with less than
    ``least_share`` percent of its characters left is depleted and rejected. So that a group of copies does not vanish as a
    whole, a depleted document is spared, with all its lines, if it is the first depleted one of its host (by doc_id, without a
    failed rule) to have them, for at least half of the characters it would lose.

    Every row is a document, repeated ones too. A null text is empty and fails; a
    null host counts as the empty host; null ids come last. Other columns are not
    looked at; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    number = F.col(row) if row else F.monotonically_increasing_id()
    source = docs.select(number.cast("bigint").alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"),
                         F.expr("xxhash64(coalesce(CAST({} AS STRING), ''))".format(f"`{host}`")).alias("host"),
                         F.col(text).cast("string").alias("text"))
    rules = written_table(spark, measured(source).drop("text"), "rules")
    held = rules.select("host", F.explode(F.expr("array_distinct(transform(lines, x -> x.h))")).alias("h")).where("h IS NOT NULL")
    common = held.groupBy("host", "h").agg(F.count("*").alias("holders")).where(f"holders > {limit}")
    each = rules.select("row", "host", F.posexplode("lines").alias("line", "x")).selectExpr(
        "row", "host", "line", "x.h AS h", "x.chars AS chars").where("h IS NOT NULL")
    # A line that very many documents have is no key that one task gets.
    lost = written_table(spark, attach_by_key(each, common, ["host", "h"], "holders", ["row"], inner=True).drop("holders"), "lost")
    totals = lost.groupBy("row").agg(F.collect_list("line").alias("removed"), F.sum("chars").alias("gone"))
    judged = rules.selectExpr("*", "aggregate(lines, 0L, (a, x) -> a + coalesce(x.chars, 0)) AS n_chars").drop(
        "lines", "host").join(totals, "row", "left").withColumn("depleted", F.expr(
            f"NOT base_failed AND 100 * (n_chars - coalesce(gone, 0L)) < {least_share} * n_chars"))
    judged = written_table(spark, judged, "judged")
    told = lost.join(judged.where("depleted").selectExpr("row", f"coalesce(doc_id, {2**63 - 1}) AS id"), "row")
    first = told.groupBy("host", "h").agg(F.expr("min(struct(id, row)).row").alias("row"))
    own = told.join(first, ["host", "h", "row"]).groupBy("row").agg(F.sum("chars").alias("own"))
    spared = judged.join(own, "row", "left").withColumn("spared", F.expr("depleted AND 2 * coalesce(own, 0L) >= gone"))
    return spared.selectExpr(
        "row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_chars",
        "CASE WHEN spared THEN 0L ELSE coalesce(gone, 0L) END AS n_removed_chars", "CASE WHEN NOT spared THEN removed END AS removed",
        "NOT base_failed AND (NOT depleted OR spared) AS kept")


def without_lines(rows: DataFrame, text: str, removed: str) -> DataFrame:
    """Adds the column shown: a text without the lines of the given numbers.

    The lines are a column of their own, which the expressions after it name twice: so Spark keeps it, and a text is cut once.
    """
    cut = derive(rows, {"_lines": f"CASE WHEN {removed} IS NOT NULL THEN split({text}, '\\\\n') END"})
    return derive(cut, {"shown": f"CASE WHEN {removed} IS NULL THEN {text} ELSE array_join(transform(array_except("
                                 f"sequence(0, size(_lines) - 1), {removed}), i -> get(_lines, i)), '\\n') END"}).drop("_lines")


# The same result in SQL. Words are split at ASCII white space; ties, hosts and limits as above.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x09-\x0D ]+'), lambda x: x <> '') AS words,
             string_split(text, chr(10)) AS lines FROM d),
p AS (SELECT row, unnest(words) AS w0, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT row, i, concat_ws(' ', w0, lead(w0, 1) OVER o, lead(w0, 2) OVER o, lead(w0, 3) OVER o, lead(w0, 4) OVER o) AS k,
             lead(w0, 4) OVER o AS w4 FROM p WINDOW o AS (PARTITION BY row ORDER BY i)),
r AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, k) AS n FROM g WHERE w4 IS NOT NULL) WHERE n > 1),
c AS (SELECT row, count(DISTINCT i + o) AS n_repeat_words FROM r, (SELECT unnest(range(0, 5)) AS o) GROUP BY row),
e AS (SELECT row, unnest(lines) AS l FROM w),
u AS (SELECT row, count(*) - count(DISTINCT l) AS n_dup_lines FROM e WHERE regexp_matches(l, '[^\x09-\x0D ]') GROUP BY row),
m AS (SELECT w.row, doc_id, host, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN u USING (row) LEFT JOIN c USING (row)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m),
n AS (SELECT row, lower(trim(regexp_replace(l, '[0-9\x09-\x0D ]+', ' ', 'g'))) AS l FROM e),
v AS (SELECT row, host, l, count(*) * length(l) AS chars, base_failed, doc_id FROM n JOIN b USING (row) WHERE l <> ''
      GROUP BY row, host, l, base_failed, doc_id),
t AS (SELECT *, count(*) OVER (PARTITION BY host, l) > {LIMIT} AS common FROM v),
x AS (SELECT row, sum(chars)::BIGINT AS n_chars, coalesce(sum(chars) FILTER (WHERE common), 0)::BIGINT AS gone FROM t GROUP BY row),
z AS (SELECT row, NOT base_failed AND 100 * (n_chars - gone) < {LEAST_SHARE} * n_chars AS depleted FROM x JOIN b USING (row)),
f AS (SELECT row, chars, row_number() OVER (PARTITION BY host, l ORDER BY doc_id NULLS LAST, row) AS place
      FROM t JOIN z USING (row) WHERE common AND depleted),
o AS (SELECT row, sum(chars) AS own FROM f WHERE place = 1 GROUP BY row),
j AS (SELECT b.*, coalesce(n_chars, 0)::BIGINT AS n_chars, coalesce(gone, 0)::BIGINT AS gone, coalesce(depleted, false) AS depleted,
             coalesce(depleted AND 2 * coalesce(own, 0) >= gone, false) AS spared
      FROM b LEFT JOIN x USING (row) LEFT JOIN z USING (row) LEFT JOIN o USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND (NOT depleted OR spared) AS kept,
       n_chars, CASE WHEN spared THEN 0 ELSE gone END AS n_removed_chars FROM j
"""
