"""Registered queries over the test tables, each a plain use of the operators.

Queries that need a model score before the forest exists use a stand-in score
that any SQL engine can compute; the forest queries use the real model.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions import display
from vigil.functions.sql import derive, flag, num
from vigil.functions.text import clean_text, with_text_features
from vigil.operators.joins import attach_by_key, packed, unpacked
from vigil.operators.places import with_places
from vigil.operators.decisions import decide, moderation_queue, most_urgent, most_urgent_first
from vigil.operators.features import build_review_features, model_vector
from vigil.operators.forest import fit_forest, normalise_score, raw_score
from vigil.operators.fraud import (
    fraud_signals, surfaced, top_suspicious_reviews, with_copy_counts, with_copy_key, with_text_key, with_texts,
)
from vigil.operators.model_drift import model_drift
from vigil.operators.moderation import (
    arm_stats, case_reviews, choose_threshold, latest_labels, most_templated, precision_by_threshold,
    review_backed_cases, with_labels,
)
from vigil.operators.profiles import business_average, reviewer_profile
from vigil.operators.quantiles import exact_quantiles
from vigil.operators.rollup import behavioral_drift, business_month_signals
from vigil.operators.sampling import hash_sample
from vigil.operators.training import (
    baseline_stats, before, find_cutoff, from_cutoff_on, impute_and_scale, mark_suspicious, monthly_counts, score_reviews,
    train, training_cutoff,
)
from vigil.session import prepare, scratch_path, scratch_run, written_table
from vigil.sources import fixtures as fx
from vigil.sources.reviews import ACCEPTED, build_products, ingest, parse_raw_reviews, with_output_defaults
from vigil.sources.tables import append_labels, read_categories, read_labels, read_table, write_categories, write_table
from vigil.streaming.replay import replay_business_months
from vigil.streaming.scored_replay import replay_with_model, stored_months

Query = Callable[["Inputs"], DataFrame]
DIGITS = 9
SAMPLE_ROWS = 2000
SAMPLE_SEED = 7

REVIEW_COLUMNS = (
    "review_id", "user_id", "business_id", "product_id", "category", "asin", "parent_asin", "stars", "useful",
    "funny", "cool", "text", "review_title", "verified_purchase", "review_timestamp", "review_datetime")
BASIC_TEXT = ("review_length", "word_count", "avg_word_length", "uppercase_share", "no_space_ratio")
SENTENCES = ("word_count", "sentence_count", "avg_sentence_length", "sentence_length_variability")
TEXT_FLAGS = ("repeated_character_flag", "generic_praise_flag", "first_person_flag", "concrete_detail_flag",
              "balanced_pros_cons_flag", "specific_experience_flag", "repeated_promotional_language_flag")
FORMATTING = ("html_break_count", "text_formatting_anomaly_flag")
ALL_TEXT = tuple(dict.fromkeys((*BASIC_TEXT, *SENTENCES, *TEXT_FLAGS, *FORMATTING)))
SIGNALS = (
    "near_duplicate_review_count", "very_short_five_star_signal", "high_rating_short_text_signal",
    "extreme_deviation_signal", "duplicate_text_signal", "burst_signal", "extreme_cluster_signal",
    "density_signal", "unverified_high_rating_signal", "reviewer_extreme_signal", "bot_text_signal",
    "synthetic_language_signal", "low_star_manipulation_signal", "complaint_only_discount",
    "long_detailed_review_discount", "fraud_signal_count", "fraud_like_score")


SCORED_COLUMNS = ("review_id", "business_id", "review_month", "business_name", "product_title", "city", "state",
                  *fv.MODEL_FEATURES)
# what the stages of queries about single reviews hold: for counting copies, for the signals, for ranks, and for whole rows
COPY_COLUMNS = ("review_id", "user_id", "business_id", "review_month", "stars", "_copy_key")
SIGNAL_COLUMNS = (*SCORED_COLUMNS, "user_id", "verified_purchase", "no_space_ratio", "synthetic_templated_language_score", "_copy_key")
RANK_COLUMNS = (*SIGNAL_COLUMNS, "review_title", "product_id")
ROW_COLUMNS = tuple(dict.fromkeys((
    *RANK_COLUMNS, "_text", *[c for c in fv.TOP_REVIEW_COLUMNS if c not in (
        *SIGNALS, "anomaly_score", "review_text", "review_text_preview")])))
# what an explanation is made of, besides the text
EXPLAINED = ("review_id", "user_id", "stars", "word_count", "rating_deviation_from_product_average", "reviewer_average_rating",
             "reviewer_review_count", "generic_praise_flag", "synthetic_templated_language_score", "repeated_character_flag",
             "text_formatting_anomaly_flag", "uppercase_share", "_text")
EXPLAINED_COLUMNS = tuple(dict.fromkeys((*SIGNAL_COLUMNS, *EXPLAINED)))
SCORES = ("anomaly_score", "is_suspicious_review")
CASE_COLUMNS = tuple(c for c in SCORED_COLUMNS if c != "review_id")  # for sums over reviews, which name none of them
MONTH = "trunc(review_timestamp, 'month')"
AS_OF_COLUMNS = ("review_id", "business_id", "user_id", "review_date", "review_month", "product_title",
                 "rating_deviation_from_product_average", *fv.MODEL_FEATURES)
REPLAY_COLUMNS = ("business_id", "review_month", "review_timestamp", *fv.MODEL_FEATURES)


def published(df: DataFrame) -> DataFrame:
    """Doubles rounded, dates and timestamps as text: the form in which results are compared."""
    def shown(name: str, dtype: str) -> str:
        if dtype == "double":
            # rounding goes through decimal texts, which whole numbers, most of the values, need not
            return f"CASE WHEN rint(`{name}`) = `{name}` THEN `{name}` ELSE round(`{name}`, {DIGITS}) END + 0.0D AS `{name}`"
        if dtype == "date":
            return f"date_format(`{name}`, 'yyyy-MM-dd') AS `{name}`"
        if dtype.startswith("timestamp"):
            return f"date_format(`{name}`, 'yyyy-MM-dd HH:mm:ss') AS `{name}`"
        return f"`{name}`"
    return df.selectExpr(*[shown(n, t) for n, t in df.dtypes])


STAND_IN_SCORE = (
    f"least(1.0D, {num(0.525)} * rating_deviation_from_business_average / 3.0D + {num(0.375)} * uppercase_share "
    f"+ {num(0.3)} * repeated_character_flag + {num(0.6)} * {flag('html_break_count >= 4')} "
    f"+ {num(0.3)} * generic_praise_flag + {num(0.3)} * {flag('word_count <= 3')})")


def stand_in(df: DataFrame) -> DataFrame:
    return mark_suspicious(derive(df, {"anomaly_score": STAND_IN_SCORE}))


class Inputs:
    """The frames one query builds on, each made once.

    A frame that several branches of a query read (``stored`` and what follows from it) is written
    to the shared folder first, as a stage of a batch run would be.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return written_table(self.spark, df, name, compression="zstd")

    @cached_property
    def reviews(self) -> DataFrame:
        return fx.reviews(self.spark, self.sf_dir)

    @cached_property
    def history(self) -> DataFrame:
        """Who rated what, how and in which month. Written once, as products, reviewers and months are all summed up from it."""
        return self.keep(self.reviews.selectExpr("business_id", "user_id", "stars", f"{MONTH} AS review_month"), "history")

    @cached_property
    def dated_history(self) -> DataFrame:
        """The same with the time of each review, for averages as of then."""
        return self.keep(self.reviews.select("business_id", "user_id", "stars", "review_timestamp"), "dated-history")

    @cached_property
    def months(self) -> DataFrame:
        return self.history.select("review_month")

    def described(self, reviews: DataFrame) -> DataFrame:
        return build_products(reviews, fx.CATEGORY, fx.metadata(self.spark, self.sf_dir))

    @cached_property
    def products(self) -> DataFrame:
        return self.described(self.history)

    @cached_property
    def features(self) -> DataFrame:
        return build_review_features(self.reviews, self.products, same_history=True, history=self.history)

    @cached_property
    def cutoff(self) -> tuple:
        return find_cutoff(self.months, fv.TRAINING_MONTHS, fv.MIN_TRAINING_ROWS)

    @cached_property
    def with_score(self) -> DataFrame:
        return stand_in(self.features)

    @cached_property
    def scored(self) -> DataFrame:
        return self.with_score.where(from_cutoff_on(self.cutoff[0]))

    @cached_property
    def business_months(self) -> DataFrame:
        return business_month_signals(self.scored)

    @cached_property
    def drift(self) -> DataFrame:
        return behavioral_drift(self.business_months)

    def document_features(self, name: str, key: list[str], text: str = "text") -> DataFrame:
        return with_text_features(fx.spread(self.table(name)).selectExpr(*key, f"{text} AS text", "5.0D AS stars"))

    @cached_property
    def label_log(self) -> DataFrame:
        """A moderator labels the labelled documents twice; the second time decides."""
        log = self.table("labels")
        review = "concat('D', doc_id) AS review_id"
        first = log.selectExpr("TIMESTAMP'2024-01-01 00:00:00' AS saved_at", review, "'unsure' AS label",
                               "'first look' AS notes")
        second = log.where("toxic = 0").selectExpr(
            "TIMESTAMP'2024-01-02 00:00:00' AS saved_at", review,
            "CASE WHEN quality = 0 THEN 'suspicious' ELSE 'not suspicious' END AS label", "'' AS notes")
        return first.unionByName(second)

    @cached_property
    def outcomes(self) -> DataFrame:
        """Labels dealt to threshold arms by document."""
        arms = ", ".join(num(t) for t in fv.ARM_THRESHOLDS)
        return latest_labels(self.label_log).selectExpr(
            f"array({arms})[CAST(CAST(substring(review_id, 2) AS BIGINT) % {len(fv.ARM_THRESHOLDS)} AS INT)] AS threshold",
            "label")


class Staged(Inputs):
    """The same frames with the scored features written once, for queries that read them several times.

    Only the numbers and names are written: without the texts the stage is small, and text features
    nobody asks for are not computed.
    """

    kept_columns: tuple[str, ...] | None = (*SCORED_COLUMNS, *SCORES)

    @cached_property
    def with_score(self) -> DataFrame:
        full = stand_in(self.features)
        return self.keep(full.select(*self.kept_columns) if self.kept_columns else full, "with-score")

    @cached_property
    def months(self) -> DataFrame:
        return self.with_score.select("review_month")

    @cached_property
    def training(self) -> DataFrame:
        return self.with_score.where(before(self.cutoff[0]))

    @cached_property
    def baseline(self) -> DataFrame:
        return baseline_stats(self.training, [*fv.MODEL_FEATURES, "anomaly_score"])

    @cached_property
    def monthly_drift(self) -> DataFrame:
        return model_drift(self.scored, self.keep(self.baseline, "baseline"))

    @cached_property
    def decisions(self) -> DataFrame:
        return decide(self.drift, self.monthly_drift)

    @cached_property
    def queue(self) -> DataFrame:
        return moderation_queue(self.decisions)

    @cached_property
    def kept_queue(self) -> DataFrame:
        return self.keep(self.queue, "queue")

    @cached_property
    def signals(self) -> DataFrame:
        return fraud_signals(self.scored, self.kept_queue)

    @cached_property
    def top(self) -> DataFrame:
        return top_suspicious_reviews(self.signals, texts=self.scored)

    @cached_property
    def forest_training(self) -> tuple[DataFrame, int]:
        """Model features of the training window."""
        limit, rows = self.cutoff
        return model_vector(self.with_score.where(before(limit)), "review_id"), rows

    @cached_property
    def forest(self) -> DataFrame:
        training, rows = self.forest_training
        return fit_forest(training, "review_id", rows)


class StagedCases(Staged):
    """For queries about product-months, months or features; no single review is named."""

    kept_columns = (*CASE_COLUMNS, *SCORES)


class StagedTexts(Staged):
    """For queries about single reviews, which show and compare their texts."""

    kept_columns = None


class StagedKeys(StagedTexts):
    """The same without the texts: digests of them are joined and stored, and those that are shown are fetched from the reviews.

    Reviews before the cutoff are summed up but never named or compared, so no id and no digest of them is stored.
    """

    kept_columns = (*ROW_COLUMNS, *SCORES)
    named_by = ("review_id", "_copy_key", "_text")

    @cached_property
    def texts(self) -> DataFrame:
        return derive(self.reviews, {"clean_review_text": clean_text("text")})

    @cached_property
    def months(self) -> DataFrame:
        return self.history.select("review_month")

    @cached_property
    def shown_texts(self) -> DataFrame:
        """Of these alone a text may be shown."""
        return self.texts.where(f"{MONTH} >= DATE'{self.cutoff[0]}'")

    @cached_property
    def keyed(self) -> DataFrame:
        return with_text_key(with_copy_key(self.texts))

    def joined(self, keyed: DataFrame) -> DataFrame:
        return build_review_features(keyed, self.products, same_history=True, history=self.history).drop("text", "clean_review_text")

    @cached_property
    def features(self) -> DataFrame:
        return self.joined(self.keyed)

    @cached_property
    def with_score(self) -> DataFrame:
        named = derive(self.keyed, {c: f"CASE WHEN {MONTH} >= DATE'{self.cutoff[0]}' THEN {c} END" for c in self.named_by})
        return self.keep(stand_in(self.joined(named)).select(*self.kept_columns), "with-score")

    @cached_property
    def top(self) -> DataFrame:
        return top_suspicious_reviews(self.signals, texts=self.shown_texts)


class StagedCopies(StagedKeys):
    """For counts of copies, which ask for nothing but keys."""

    kept_columns = COPY_COLUMNS


class StagedSignals(StagedKeys):
    """For the signals of reviews; no row is shown."""

    kept_columns = (*SIGNAL_COLUMNS, *SCORES)


class StagedExplanations(StagedKeys):
    """For explanations of reviews."""

    kept_columns = (*EXPLAINED_COLUMNS, *SCORES)


class StagedRanks(StagedKeys):
    """For queries that rank reviews and show numbers and keys of them, but no text."""

    kept_columns = (*RANK_COLUMNS, *SCORES)

    @cached_property
    def top(self) -> DataFrame:
        return top_suspicious_reviews(self.signals, columns=tuple(c for c in fv.TOP_REVIEW_COLUMNS if c in self.signals.columns))


# ---- queries ---------------------------------------------------------------

def review_texts(columns) -> Query:
    return lambda x: with_text_features(x.reviews).select("review_id", *columns)


def whole_texts(name, key, columns, text="text") -> Query:
    return lambda x: x.document_features(name, key, text).select(*key, *columns)


def json_path_fields(x: Inputs):
    return x.table("events").selectExpr(
        "event_id", "try_cast(get_json_object(props, '$.k') AS BIGINT) AS k", "get_json_object(props, '$.absent') AS absent")


def hash_sampled(x: Staged):
    limit, rows = x.cutoff
    vector = x.with_score.where(before(limit)).select("review_id", "stars", "word_count")
    return hash_sample(vector, "review_id", SAMPLE_ROWS, rows, SAMPLE_SEED).drop("copy")


def score_normalised(x: Staged):
    bounds = exact_quantiles(x.training, ["anomaly_score"], [0.01, 0.99])
    low, high = [r["value"] for r in bounds.orderBy("probability").collect()]
    return x.training.selectExpr("review_id", f"{normalise_score('anomaly_score', low, high)} AS normalised_score")


def imputed_scaled(x: Inputs):
    """Documents stand in for reviews whose stars are partly unknown: labelled ones have a rating."""
    names = ["stars", "review_length", "uppercase_share"]
    labels = x.table("labels").selectExpr("doc_id", "quality * 4.0D + 1.0D AS stars")
    docs = x.document_features("documents", ["doc_id"]).drop("stars")
    rows = x.keep(docs.join(labels, "doc_id", "left").select("doc_id", *names), "documents")
    medians = exact_quantiles(rows, names, [0.5])
    filled = rows.fillna({r["feature"]: r["value"] for r in medians.collect()})
    return impute_and_scale(rows, baseline_stats(filled, names))


def review_explanations(x: StagedKeys):
    """What is said of a text is taken of each different text once, so no text meets the reviews."""
    marks = {"_marks": display.text_marks("clean_review_text")}
    reviews = with_texts(surfaced(x.signals).select(*EXPLAINED), x.shown_texts, marks)
    return derive(reviews, {"explanation": display.review_explanation(reviews)}).select("review_id", "explanation")


def whole_display(name: str, key: str, text: str) -> Query:
    def query(x: Inputs):
        shown = derive(fx.spread(x.table(name)), {"shown": display.display_text(text)})
        return shown.selectExpr(key, "md5(shown) AS shown_md5", "length(shown) AS shown_length",
                                f"{display.has_ingredient_list('shown')} AS ingredient_list")
    return query


def display_names(x: Staged):
    return x.queue.selectExpr(
        "business_id", f"{display.month_key('review_month')} AS month_key",
        f"{display.month_label('review_month')} AS month_label",
        f"{display.product_display_name(x.queue)} AS display_name",
        f"{display.anomaly_band('max_anomaly_score')} AS anomaly_band")


def queue_places(x: Staged):
    """The place of each case in the moderators' order, by scores as they are published."""
    shown = derive(x.queue, {"decision_score": f"round(decision_score, {DIGITS})"})
    return with_places(shown, most_urgent()).select("business_id", "review_month", "decision_score", "review_count", "place")


def queue_explained(x: Staged):
    return derive(x.queue, {"explanation": display.case_explanation(x.queue)}).select(
        "business_id", "review_month", "explanation")


def top_labelled(x: Staged):
    """Surfaced reviews beside moderator labels; here all verified purchases were judged."""
    log = x.with_score.where("verified_purchase").selectExpr(
        "TIMESTAMP'2024-01-01 00:00:00' AS saved_at", "review_id",
        "CASE WHEN stars = 5 THEN 'suspicious' ELSE 'unsure' END AS label")
    return with_labels(x.top, log).select("review_id", "business_id", "stars", "moderator_label")


def labels_round_trip(x: Inputs):
    """Labels appended in two goes and read back; the last one per review counts."""
    path = scratch_path(x.spark, "labels")
    append_labels(x.label_log.where("label = 'unsure'"), path)
    append_labels(x.label_log.where("label != 'unsure'"), path)
    return latest_labels(read_labels(x.spark, path)).select("review_id", "label")


def precision(x: Inputs):
    documents = x.document_features("documents", ["doc_id"]).selectExpr(
        "concat('D', doc_id) AS review_id", "synthetic_templated_language_score AS anomaly_score")
    return precision_by_threshold(documents, x.label_log, thresholds=(0.05, 0.10, 0.15, 0.20))


def stored_by_month(x: Inputs):
    """Features written by month and read back for the scoring window only: other months' folders stay closed."""
    path, columns = scratch_path(x.spark, "features"), ("review_id", "business_id", "review_month", "dataset", *fv.MODEL_FEATURES)
    with scratch_run(x.spark):  # written first, so that shuffles of the joins are gone before the one by month
        limit = x.cutoff[0]
        rows = unpacked(x.keep(packed(x.features.select(*[c for c in columns if c != "dataset"])), "joined"))
        write_table(with_output_defaults(rows, "reviews").select(*columns), path, by_month=True)
    return read_table(x.spark, path).where(from_cutoff_on(limit)).select(*columns)


def stored_categories(x: Inputs):
    """Three categories in one table; one is written again with fewer reviews and replaces itself alone; two are read."""
    path = scratch_path(x.spark, "categories")
    rows = x.reviews.selectExpr(
        "review_id", "business_id", "stars", "useful",
        "CASE WHEN verified_purchase THEN 'kept' WHEN useful > 0 THEN 'returned' ELSE 'other' END AS category")
    write_categories(rows, path)
    write_categories(rows.where("category = 'returned' AND stars < 5"), path)
    return read_categories(x.spark, path, "kept", "returned")


def rejected_records(x: Inputs):
    """Records by what became of them and by product, from lines of which some are broken or incomplete."""
    taken = ingest(parse_raw_reviews(fx.faulty_review_lines(x.spark, x.sf_dir), keep_broken=True),
                   scratch_path(x.spark, "ingested"), fx.CATEGORY)
    product = "coalesce(get_json_object(record, '$.parent_asin'), get_json_object(record, '$.asin'))"
    rejected = taken.rejected.selectExpr("rejection", f"CASE WHEN rejection <> 'malformed' THEN {product} END AS business_id")
    reviews = taken.reviews.selectExpr(f"'{ACCEPTED}' AS rejection", "business_id")
    return reviews.unionByName(rejected).groupBy("rejection", "business_id").agg(F.count("*").alias("records"))


def forest_scores(x: Staged):
    training, rows = x.forest_training
    nodes = x.keep(x.forest, "nodes")
    return training.select("review_id", raw_score(
        nodes, list(fv.MODEL_FEATURES), min(fv.FOREST_SUBSAMPLE, rows)).alias("raw_score"))


def forest_scored(x: Inputs, columns=None, named: bool = True) -> tuple[DataFrame, DataFrame]:
    """Reviews scored by the real model, and the queue that follows from them. Their ids are kept only if ``named``."""
    stored = x.keep(x.features if columns is None else x.features.select(*columns), "features")
    model = train(stored)
    scores = score_reviews(stored, model)
    scores = x.keep(scores if named else scores.drop("review_id"), "scored")
    drift = behavioral_drift(business_month_signals(scores))
    return scores, moderation_queue(decide(drift, model_drift(scores, model.baseline)))


def forest_cases(x: Inputs):
    """Flagship: product-months routed to moderators by the real model."""
    return most_urgent_first(forest_scored(x, SCORED_COLUMNS, named=False)[1])


def forest_top_reviews(x: StagedKeys):
    """The strongest reviews of the cases that the real model queues."""
    scores, queue = forest_scored(x, ROW_COLUMNS)
    return top_suspicious_reviews(fraud_signals(scores, x.keep(queue, "queue")), texts=x.shown_texts)


def replayed(x: Inputs):
    """The scored reviews arrive as a stream of lineitems; statistics over all history are a static table."""
    arriving = (x.spark.readStream.schema(x.table("lineitem").schema)
                .option("pathGlobFilter", "lineitem.parquet").parquet(x.sf_dir)
                .repartition(x.spark.sparkContext.defaultParallelism))
    live = with_text_features(fx.normalise_reviews(fx.raw_reviews(x.spark, x.sf_dir, lineitem=arriving), fx.CATEGORY))
    described = x.products.drop("product_id", "category")
    rows = derive(attach_by_key(live, described, ["business_id"], "listed_review_count", ["review_id"]), {
        "is_extreme_rating": flag("stars IN (1.0D, 5.0D)"),
        "rating_deviation_from_business_average": "abs(stars - listed_business_stars)",
    })
    return replay_business_months(rows.where(f"review_timestamp >= TIMESTAMP'{x.cutoff[0]} 00:00:00'"), score=stand_in)


def replayed_forest(x: Inputs):
    """Features arrive as a stream in two runs; the second one goes on from the checkpoint with the model of the first."""
    stored = x.keep(x.features.select("review_id", *REPLAY_COLUMNS), "features")
    model, source, folder = train(stored), scratch_path(x.spark, "arriving"), None
    for half in (0, 1):
        rows = stored.where(f"pmod(xxhash64(review_id), 2) = {half}").select(*REPLAY_COLUMNS)
        rows.write.mode("append").parquet(source, compression="zstd")
        arriving = x.spark.readStream.schema(rows.schema).parquet(source)
        folder = replay_with_model(arriving, folder, None if half else model)
    return stored_months(x.spark, folder, x.products)


# name -> (kind of inputs, query)
QUERIES: dict[str, tuple[type[Inputs], Query]] = {
    "ingest_normalised": (Inputs, lambda x: fx.reviews_from_json(x.spark, x.sf_dir).select(*REVIEW_COLUMNS)),
    "review_id_hash": (Inputs, lambda x: x.reviews.select("review_id", "business_id", "review_timestamp")),
    "json_path_fields": (Inputs, json_path_fields),
    "metadata_latest": (Inputs, lambda x: fx.metadata(x.spark, x.sf_dir)),
    "product_dim": (Inputs, lambda x: x.described(x.reviews)),
    "text_basic": (Inputs, review_texts(BASIC_TEXT)),
    "text_sentences": (Inputs, review_texts(SENTENCES)),
    "text_flags": (Inputs, review_texts(TEXT_FLAGS)),
    "html_breaks": (Inputs, review_texts(FORMATTING)),
    "synthetic_score": (Inputs, review_texts(("synthetic_templated_language_score",))),
    "document_text_features": (Inputs, whole_texts("documents", ["doc_id"], ALL_TEXT)),
    "page_text_features": (Inputs, whole_texts("pages", ["page_id"], ALL_TEXT, "html")),
    "conversation_text_features": (Inputs, whole_texts("conversations", ["conv_id", "turn"], ALL_TEXT)),
    "business_average": (Inputs, lambda x: business_average(x.reviews)),
    "reviewer_profile": (Inputs, lambda x: reviewer_profile(x.reviews)),
    "review_features": (Inputs, lambda x: x.features.select(
        "review_id", "business_id", "user_id", "review_date", "review_month", "product_title",
        "rating_deviation_from_product_average", "synthetic_templated_language_score", *fv.MODEL_FEATURES)),
    "review_features_as_of": (Inputs, lambda x: build_review_features(
        x.reviews, x.described(x.dated_history), as_of=True, history=x.dated_history, kept=AS_OF_COLUMNS).select(*AS_OF_COLUMNS)),
    "monthly_counts": (Inputs, lambda x: monthly_counts(x.reviews.selectExpr(f"{MONTH} AS review_month"))),
    "training_cutoff": (Inputs, lambda x: training_cutoff(x.reviews.selectExpr(f"{MONTH} AS review_month"))),
    "hash_sample": (Staged, hash_sampled),
    "baseline_stats": (StagedCases, lambda x: x.baseline),
    "score_normalise": (Staged, score_normalised),
    "imputed_scaled": (Inputs, imputed_scaled),
    "stored_by_month": (Inputs, stored_by_month),
    "stored_categories": (Inputs, stored_categories),
    "rejected_records": (Inputs, rejected_records),
    "business_month": (Inputs, lambda x: x.business_months),
    "behavioral_drift": (Inputs, lambda x: x.drift),
    "model_drift": (StagedCases, lambda x: x.monthly_drift),
    "decisions": (StagedCases, lambda x: x.decisions),
    "moderation_queue": (StagedCases, lambda x: most_urgent_first(x.queue)),
    "queue_places": (StagedCases, queue_places),
    "queue_explained": (StagedCases, queue_explained),
    "duplicate_reviews": (StagedCopies, lambda x: with_copy_counts(x.scored).select("review_id", "near_duplicate_review_count")),
    "fraud_signals": (StagedSignals, lambda x: x.signals.select("review_id", "business_id", "review_month", *SIGNALS)),
    "top_suspicious_reviews": (StagedKeys, lambda x: x.top),
    "review_explanations": (StagedExplanations, review_explanations),
    "document_display": (Inputs, whole_display("documents", "doc_id", "text")),
    "page_display": (Inputs, whole_display("pages", "page_id", "html")),
    "display_names": (StagedCases, display_names),
    "review_backed_cases": (StagedRanks, lambda x: review_backed_cases(x.kept_queue, x.top).select(
        "business_id", "review_month", "product_key", "month_key", "decision_score")),
    "case_reviews": (StagedRanks, lambda x: case_reviews(x.top, x.kept_queue).select(
        "product_key", "month_key", "review_id", "decision_score", "fraud_like_score", "fraud_signal_count")),
    "synthetic_top200": (StagedRanks, lambda x: most_templated(x.top).select(
        "review_id", "business_id", "synthetic_templated_language_score")),
    "latest_labels": (Inputs, labels_round_trip),
    "labelled_top_reviews": (StagedRanks, top_labelled),
    "precision_by_threshold": (Inputs, precision),
    "arm_stats": (Inputs, lambda x: arm_stats(x.spark, x.outcomes)),
    "threshold_choice": (Inputs, lambda x: choose_threshold(arm_stats(x.spark, x.outcomes), explore=0.0)),
    # thresholds of some thousands: nine digits behind the point would leave the last bits of a double to decide
    "forest_nodes": (Staged, lambda x: derive(x.forest, {"threshold": "round(threshold, 6)"})),
    "forest_scores": (Staged, forest_scores),
    "forest_cases": (Inputs, forest_cases),
    "forest_top_reviews": (StagedKeys, forest_top_reviews),
    "replay_month_signals": (Inputs, replayed),
    "replay_forest_months": (Inputs, replayed_forest),
    "replay_behavioral_drift": (Inputs, lambda x: behavioral_drift(replayed(x))),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(kind: type[Inputs], query: Query):
        return lambda spark, sf_dir: published(query(kind(prepare(spark), sf_dir)))
    return {name: bind(*how) for name, how in QUERIES.items()}
