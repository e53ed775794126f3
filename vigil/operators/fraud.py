"""Fraud-like signals of the reviews inside queued product-months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.sql import capped, clip01, derive, flag, num, weighted_sum
from vigil.functions.text_kernels import folded
from vigil.operators.joins import BROADCAST_TABLE, ROWS_PER_TASK, attach_by_key, packed, unpacked
from vigil.session import written_table

TEXT_KEYS = 1_000_000  # different texts that are fetched by a broadcast of their keys
TEXT_CHARACTERS = 1 << 25  # characters up to which the different texts themselves are broadcast
CASE = ["business_id", "review_month"]
SPREAD_BY = ("_id", "review_id", "user_id", "stars")


def with_copy_key(reviews: DataFrame) -> DataFrame:
    """Adds the digest of the folded text, unless it is there already: equal ones are copies of one another."""
    return reviews if "_copy_key" in reviews.columns else reviews.withColumn(
        "_copy_key", F.unhex(F.md5(F.lower(folded("text")))))


def with_text_key(reviews: DataFrame) -> DataFrame:
    """Adds the digest of the display text: rows that share it share the text."""
    if "_text" in reviews.columns or "clean_review_text" not in reviews.columns:
        return reviews
    return derive(reviews, {"_text": "unhex(md5(CASE WHEN clean_review_text IS NULL THEN '-' ELSE concat('=', clean_review_text) END))"})


def with_texts(few: DataFrame, reviews: DataFrame, shown: dict[str, str] | None = None) -> DataFrame:
    """Adds clean_review_text, or the columns ``shown`` that are made of it, to a few rows that carry the key of their text.

    Each different text is fetched once, however many rows show it. The keys are broadcast up to TEXT_KEYS of them, so texts
    that nobody asked for stay where they are; more are left to a shuffled join. A text that very many rows show is dealt out
    as any hot key. Where the different texts are counted to be at most TEXT_CHARACTERS by their ``review_length``, they are
    broadcast and the rows stay where they are; what is ``shown`` in place of the text is taken of each different text once and is
    broadcast like any statistics.
    """
    few = written_table(few.sparkSession, few, "few", compression="zstd")
    keys = few.groupBy("_text").agg(F.count("*").alias("_shown"))
    broadcast_table = BROADCAST_TABLE if shown else 0
    if not shown and "review_length" in few.columns:
        characters = few.groupBy("_text").agg(F.max("review_length").alias("length")).agg(F.sum("length")).first()[0]
        broadcast_table = BROADCAST_TABLE if (characters or 0) <= TEXT_CHARACTERS else 0
    wanted = F.broadcast(keys) if keys.limit(TEXT_KEYS + 1).count() <= TEXT_KEYS else keys
    texts = with_text_key(reviews).select("_text", "clean_review_text").join(wanted, "_text").distinct()
    if shown:
        texts = derive(texts, shown).drop("clean_review_text")
    return attach_by_key(few, texts, ["_text"], "_shown", spread_by=[c for c in SPREAD_BY if c in few.columns],
                         broadcast_table=broadcast_table).drop("_text", "_shown")


def with_copy_counts(reviews: DataFrame, counted_in: DataFrame | None = None) -> DataFrame:
    """near_duplicate_review_count: reviews of the same product-month with the same folded text.

    Texts are compared by digest. Counts are combined before the shuffle and only groups of two and
    more are joined back, so a text that fills a third of the table is one row of the join.
    """
    groups = (
        with_copy_key(reviews if counted_in is None else counted_in)
        .groupBy(*CASE, "_copy_key").agg(F.count("*").alias("_copies")).where("_copies > 1")
    )
    rows = packed(with_copy_key(reviews))
    joined = attach_by_key(rows, groups, [*CASE, "_copy_key"], "_copies", spread_by=[c for c in SPREAD_BY if c in rows.columns])
    return unpacked(derive(joined, {"near_duplicate_review_count": "coalesce(_copies, 1L)"}).drop("_copies", "_copy_key"))


def reviews_of_cases(
    scored: DataFrame, cases: DataFrame, weight: str, rows_per_task: int = ROWS_PER_TASK, broadcast_table: int = BROADCAST_TABLE,
) -> DataFrame:
    """Reviews of the product-months in ``cases``, one row for each with its row count in ``weight``, and near_duplicate_review_count.

    Copies stand in one product-month. So rows are dealt by it once, for the join, for the count and for a rank that may
    follow, and a task holds fewer than ``rows_per_task`` rows of one. Larger ones, at most total / rows_per_task, are joined and
    counted as hot keys.
    """
    known = cases.where(" AND ".join(f"{k} IS NOT NULL" for k in CASE))
    known = written_table(scored.sparkSession, known, "cases")  # read twice, and counted
    columns = [*scored.columns, *[c for c in cases.columns if c not in CASE]]
    heavy = known.where(f"{weight} >= {rows_per_task}")
    light = known.where(f"NOT coalesce({weight} >= {rows_per_task}, false)")
    if known.limit(broadcast_table + 1).count() <= broadcast_table:
        dealt = scored.join(F.broadcast(light), CASE).repartition(*CASE)
    else:
        dealt = scored.join(light, CASE)
    rows = derive(dealt.select(*columns), {
        "near_duplicate_review_count":
            f"CASE WHEN _copy_key IS NULL THEN 1L ELSE count(*) OVER (PARTITION BY {', '.join(CASE)}, _copy_key) END"})
    rows = unpacked(rows.drop("_copy_key"))
    if heavy.isEmpty():
        return rows
    spread_by = [c for c in SPREAD_BY if c in scored.columns]
    crowded = attach_by_key(scored, heavy, CASE, weight, spread_by=spread_by, inner=True)
    return rows.unionByName(with_copy_counts(
        crowded, counted_in=scored.join(F.broadcast(heavy.select(*CASE)), CASE, "left_semi")))


def fraud_signals(scored: DataFrame, queue: DataFrame) -> DataFrame:
    """All signals, discounts and the fraud-like score of every review in a queued product-month.

    Of the raw text only its digest goes through the join. The display text goes along only if what follows asks for it;
    ``with_texts`` fetches it afterwards by its key.
    """
    scored = packed(with_text_key(with_copy_key(scored)).drop("text"))
    cases = queue.select(*CASE, "review_count", "extreme_rating_share", "suspicious_review_density",
                         "review_volume_change")
    rows = reviews_of_cases(scored, cases, "review_count")
    rows = derive(rows, {
        "very_short_five_star_signal": flag("stars = 5 AND word_count <= 12"),
        "high_rating_short_text_signal": flag("stars >= 4 AND word_count <= 20"),
        "extreme_deviation_signal": capped("rating_deviation_from_business_average", 3.0),
        "duplicate_text_signal": flag("near_duplicate_review_count > 1 AND word_count >= 4"),
        "burst_signal": capped("abs(review_volume_change)", 2.0),
        "extreme_cluster_signal": capped("extreme_rating_share", 0.75),
        "density_signal": capped("suspicious_review_density", 0.50),
        "unverified_high_rating_signal": flag("stars >= 4 AND NOT verified_purchase"),
        "reviewer_extreme_signal": capped("reviewer_extreme_rating_share", 0.90),
        "bot_text_signal": capped(
            "repeated_character_flag + text_formatting_anomaly_flag + generic_praise_flag + no_space_ratio"),
        "synthetic_language_signal": flag(f"synthetic_templated_language_score >= {num(0.35)}"),
        "long_detailed_review_discount":
            f"CASE WHEN review_length >= 900 AND word_count >= 140 THEN {num(0.15)} ELSE 0.0D END",
    })
    present = " OR ".join(f"{name} >= {num(level)}" for name, level in fv.MANIPULATION_SIGNALS)
    absent = " AND ".join(f"{name} < {num(level)}" for name, level in fv.MANIPULATION_SIGNALS)
    rows = derive(rows, {
        "low_star_manipulation_signal": flag(present),
        "complaint_only_discount": f"CASE WHEN stars <= 2 AND {absent} THEN {num(0.25)} ELSE 0.0D END",
        "fraud_signal_count": " + ".join(flag(f"{name} >= {num(level)}") for name, level in fv.COUNTED_SIGNALS),
    })
    return derive(rows, {"fraud_like_score": clip01(weighted_sum(fv.FRAUD_WEIGHTS))})


def surfaced(signals: DataFrame) -> DataFrame:
    """Reviews with several signals and a high score; low ratings only with a manipulation sign."""
    return signals.where(f"fraud_signal_count >= 2 AND fraud_like_score >= {num(0.60)} "
                         "AND (stars > 2 OR low_star_manipulation_signal = 1)")


def top_suspicious_reviews(
    signals: DataFrame, per_case: int = fv.TOP_REVIEWS_PER_CASE, texts: DataFrame | None = None,
    columns: tuple[str, ...] = fv.TOP_REVIEW_COLUMNS,
) -> DataFrame:
    """The strongest reviews of each case. Spark keeps ``per_case`` rows per case and task before the shuffle.

    With ``texts``, the scored reviews, rows are joined and ranked without their texts; these are fetched for the rows that
    stay. Without it the texts go along. Where ``columns`` names no text, none is fetched and nothing is written.
    """
    ranking = ("row_number() OVER (PARTITION BY business_id, review_month ORDER BY fraud_like_score DESC, "
               "fraud_signal_count DESC, anomaly_score DESC, review_id, stars, useful, review_title, verified_purchase)")
    shown = {"review_text": "clean_review_text", "review_text_preview": "clean_review_text"}
    top = derive(surfaced(signals), {"review_rank": ranking}).where(f"review_rank <= {per_case}")
    if texts is not None and any(c in shown for c in columns):
        top = with_texts(top.select("_text", *[c for c in columns if c not in shown]), texts)
    return top.selectExpr(*[f"{shown.get(c, c)} AS {c}" for c in columns])
