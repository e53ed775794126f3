"""SQL equivalents of the registered queries, for checking them in another engine.

Each text is a chain of common table expressions over the test tables. Fixed
values are read from ``fixed_values``; the computation itself is written
independently of the DataFrame code.
"""

from __future__ import annotations

from vigil import fixed_values as fv
from vigil.sources.fixtures import CATEGORY, TEXT_STYLES

S = r"[\s\x0B]"  # what Java calls white space
DIGITS = 9


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def n(x: float) -> str:
    """A DOUBLE literal (a plain decimal point makes a DECIMAL)."""
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def word(words) -> str:
    return rf"'\b({'|'.join(words)})\b'"


def flag(condition: str) -> str:
    return f"(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END)"


def total(weights, terms=None) -> str:
    terms = terms or {}
    return " + ".join(f"({n(w)} * {terms.get(name, name)})" for name, w in weights)


def clip(x: str) -> str:
    return f"greatest(0e0, least(1e0, {x}))"


def build(*ctes: str, final: str) -> str:
    """WITH text of the named CTEs and all they need, in order of definition."""
    needed: set[str] = set()

    def need(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for other in CTES[name][0]:
                need(other)

    for name in ctes:
        need(name)
    parts = [f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in CTES if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + final


def shown(columns, doubles=(), dates=()) -> str:
    out = []
    for c in columns:
        if c in doubles:
            out.append(f"round({c}, {DIGITS}) + 0e0 AS {c}")
        elif c in dates:
            out.append(f"strftime({c}, '%Y-%m-%d') AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def text_ctes(prefix: str, source: str, key: str, needs: tuple[str, ...]) -> dict:
    """Text features of ``source`` (columns key.., text, stars)."""
    clean = f"regexp_replace(coalesce(text, ''), '<br{S}*/?>', chr(10), 'gi')"
    no_breaks = f"regexp_replace(coalesce(text, ''), '<br{S}*/?>', '', 'gi')"
    # five equal characters in a row, other than line ends: asked of each distinct character
    repeated = ("len(list_filter(list_distinct(string_split(clean, '')), lambda ch: length(ch) = 1 and "
                "ch NOT IN (chr(10), chr(13), chr(133), chr(8232), chr(8233)) and contains(clean, repeat(ch, 5)))) > 0")
    templated = total(fv.TEMPLATED_WEIGHTS, {
        "short_five_star": flag("stars = 5 AND word_count <= 12"),
        "lacks_detail": "(1e0 - concrete_detail_flag)",
        "even_sentences": flag("sentence_count >= 2 AND sentence_length_variability <= 0.10e0"),
    })
    return {
        f"{prefix}1": (needs, f"SELECT *, {clean} AS clean, greatest((length(coalesce(text, '')) - length({no_breaks})) / 4e0, 0e0) "
                              f"AS html_break_count FROM {source}"),
        f"{prefix}2": ((f"{prefix}1",), f"SELECT *, trim(regexp_replace(clean, '{S}+', ' ', 'g')) AS flat FROM {prefix}1"),
        f"{prefix}3": ((f"{prefix}2",), rf"""SELECT *, lower(flat) AS low, length(clean)::DOUBLE AS review_length,
            CASE WHEN flat = '' THEN 0e0 ELSE len(string_split(flat, ' '))::DOUBLE END AS word_count,
            list_transform(list_filter(string_split(regexp_replace(flat, '[.!?]+', '|', 'g'), '|'), lambda p: trim(p) <> ''),
                           lambda p: len(string_split(trim(p), ' '))::DOUBLE) AS lens FROM {prefix}2"""),
        f"{prefix}4": ((f"{prefix}3",), rf"""SELECT *, review_length / greatest(word_count, 1e0) AS avg_word_length,
            CASE WHEN word_count = 0 THEN 0e0 ELSE greatest(len(lens)::DOUBLE, 1e0) END AS sentence_count,
            length(regexp_replace(clean, '[^A-Z]', '', 'g'))::DOUBLE
              / greatest(length(regexp_replace(clean, '[^A-Za-z]', '', 'g'))::DOUBLE, 1e0) AS uppercase_share,
            {flag(repeated)} AS repeated_character_flag,
            {flag(f"regexp_matches(low, {word(fv.GENERIC_PRAISE)})")} AS generic_praise_flag,
            {flag(f"regexp_matches(low, {word(fv.FIRST_PERSON)})")} AS first_person_flag,
            {flag(f"regexp_matches(low, {word(fv.CONCRETE_DETAIL)})")} AS concrete_detail_flag,
            {flag(f"regexp_matches(low, {word(fv.BALANCED)})")} AS balanced_pros_cons_flag,
            {flag(f"regexp_matches(low, {word(fv.EXPERIENCE)})")} AS specific_experience_flag,
            {flag(f"regexp_matches(low, {word(fv.PROMOTIONAL)})")} AS repeated_promotional_language_flag
            FROM {prefix}3"""),
        f"{prefix}5": ((f"{prefix}4",), rf"""SELECT *, word_count / greatest(sentence_count, 1e0) AS avg_sentence_length,
            least(avg_word_length / 25e0, 1e0) AS no_space_ratio,
            {flag(f"html_break_count >= 4 OR (avg_word_length >= 18 AND review_length >= 60) OR regexp_matches(clean, chr(10) || '{S}*' || chr(10) || '{S}*' || chr(10))")}
              AS text_formatting_anomaly_flag FROM {prefix}4"""),
        f"{prefix}6": ((f"{prefix}5",), f"""SELECT *, CASE WHEN sentence_count < 2 THEN 0e0 ELSE least(
            sqrt(list_sum(list_transform(lens, lambda x: pow(x - avg_sentence_length, 2))) / greatest(sentence_count, 1e0))
              / greatest(avg_sentence_length, 1e0), 1e0) END AS sentence_length_variability FROM {prefix}5"""),
        prefix: ((f"{prefix}6",), f"SELECT * EXCLUDE (lens, low, flat), {clip(templated)} "
                                  f"AS synthetic_templated_language_score FROM {prefix}6"),
    }


CTES: dict[str, tuple[tuple[str, ...], str]] = {}

styles = " ".join(f"WHEN {i} THEN {'d.text' if t is None else q(t)}" for i, t in enumerate(TEXT_STYLES))
CTES["raw"] = ((), f"""
SELECT CASE WHEN l_linenumber <> 1 THEN 'B' || l_suppkey END AS parent_asin,
  CASE WHEN l_linenumber = 1 THEN 'B' || l_suppkey ELSE 'V' || l_partkey END AS asin,
  CASE WHEN o_custkey % 50 <> 0 THEN 'U' || o_custkey END AS user_id,
  epoch(l_shipdate)::BIGINT * (CASE WHEN l_linenumber % 2 = 0 THEN 1000 ELSE 1 END) AS ts, l_shipdate AS shipped,
  CASE WHEN l_quantity > 25 THEN 5e0 WHEN l_quantity < 6 THEN 1e0 ELSE ceil(l_quantity / 10)::DOUBLE END AS stars,
  CASE WHEN l_tax > 0 THEN round(l_tax * 100) ELSE 0e0 END AS useful, o_orderpriority AS review_title,
  CASE style {styles} END AS text, l_returnflag <> 'R' AS verified_purchase
FROM (SELECT *, (l_orderkey * 7 + l_partkey * 13 + l_linenumber) % {len(TEXT_STYLES)} AS style FROM lineitem) l
JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN documents d ON style = {TEXT_STYLES.index(None)} AND d.doc_id = l_orderkey % (SELECT count(*) FROM documents)""")
CTES["reviews"] = (("raw",), f"""
SELECT sha256(concat_ws('||', coalesce(parent_asin, asin), user_id, ts::VARCHAR, coalesce(text, ''))) AS review_id, user_id,
  coalesce(parent_asin, asin) AS business_id, coalesce(parent_asin, asin) AS product_id, '{CATEGORY}' AS category, asin,
  parent_asin, stars, useful, 0e0 AS funny, 0e0 AS cool, coalesce(text, '') AS text, review_title, verified_purchase,
  date_trunc('second', shipped) AS review_timestamp, date_trunc('second', shipped) AS review_datetime,
  date_trunc('day', shipped)::DATE AS review_date, date_trunc('month', shipped)::DATE AS review_month FROM raw""")
CTES["metadata"] = ((), """
SELECT 'B' || s_suppkey AS asin, min(title) AS product_title FROM (
  SELECT s_suppkey, s_name AS title FROM supplier WHERE s_suppkey % 10 <> 0
  UNION ALL SELECT s_suppkey, 'Alternate ' || s_name FROM supplier WHERE s_suppkey % 10 <> 0 AND s_suppkey % 7 = 0) GROUP BY s_suppkey""")
CTES["products"] = (("reviews", "metadata"), f"""
SELECT r.*, m.product_title, '{CATEGORY}' AS category, NULL::DOUBLE AS average_rating, m.product_title AS business_name,
  '' AS city, '' AS state, '{CATEGORY}' AS categories
FROM (SELECT business_id, max(product_id) AS product_id, avg(stars) AS listed_business_stars, count(*) AS listed_review_count
      FROM reviews GROUP BY business_id) r LEFT JOIN metadata m ON m.asin = r.business_id""")
CTES |= text_ctes("texts", "reviews", "review_id", ("reviews",))
CTES["reviewers"] = (("reviews",), f"""
SELECT user_id, avg(stars) AS reviewer_average_rating, count(*)::DOUBLE AS reviewer_review_count,
  avg({flag('stars IN (1, 5)')}) AS reviewer_extreme_rating_share, avg({flag('stars = 5')}) AS reviewer_five_star_share,
  avg({flag('stars = 1')}) AS reviewer_one_star_share FROM reviews GROUP BY user_id""")
REVIEWER = ("reviewer_average_rating", "reviewer_review_count", "reviewer_extreme_rating_share",
            "reviewer_five_star_share", "reviewer_one_star_share")
CTES["features"] = (("texts", "products", "reviewers"), f"""
SELECT t.*, p.product_title, p.business_name, p.city, p.state, {flag('stars IN (1, 5)')} AS is_extreme_rating,
  {', '.join(f'coalesce(u.{c}, 0e0) AS {c}' for c in REVIEWER)},
  stars - listed_business_stars AS rating_deviation_from_product_average,
  abs(stars - listed_business_stars) AS rating_deviation_from_business_average
FROM texts t LEFT JOIN products p ON p.business_id = t.business_id LEFT JOIN reviewers u ON u.user_id = t.user_id""")
REVIEWER_OF = {"reviewer_average_rating": "avg(stars)", "reviewer_review_count": "count(*)",
               **{f"reviewer_{name}_share": f"avg({flag(of)})" for name, of in (
                   ("extreme_rating", "stars IN (1, 5)"), ("five_star", "stars = 5"), ("one_star", "stars = 1"))}}
CTES["features_as_of"] = (("texts", "products"), f"""
SELECT *, coalesce(stars - average_before, 0e0) AS rating_deviation_from_product_average,
  coalesce(abs(stars - average_before), 0e0) AS rating_deviation_from_business_average
FROM (SELECT t.*, p.product_title, {flag('stars IN (1, 5)')} AS is_extreme_rating,
  {', '.join(f'CASE WHEN t.user_id IS NULL THEN 0e0 ELSE coalesce(({e} OVER u)::DOUBLE, 0e0) END AS {c}' for c, e in REVIEWER_OF.items())},
  avg(stars) OVER b AS average_before
FROM texts t LEFT JOIN products p ON p.business_id = t.business_id
WINDOW b AS (PARTITION BY t.business_id ORDER BY t.review_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 SECOND PRECEDING),
  u AS (PARTITION BY t.user_id ORDER BY t.review_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 SECOND PRECEDING))""")
CTES["months"] = (("reviews",), """
SELECT review_month, count(*) AS count, row_number() OVER (ORDER BY review_month) AS place,
  (sum(count(*)) OVER (ORDER BY review_month))::BIGINT AS running FROM reviews WHERE review_month IS NOT NULL GROUP BY review_month""")
MONTHS = max(fv.TRAINING_MONTHS, fv.MIN_TRAINING_MONTHS)
CTES["cutoff"] = (("months",), f"""
SELECT (CASE WHEN by_months THEN a ELSE b END + INTERVAL 1 MONTH)::DATE AS cutoff_date,
  CASE WHEN by_months THEN na ELSE nb END AS training_rows, total_rows, by_months
FROM (SELECT *, na >= {fv.MIN_TRAINING_ROWS} AS by_months FROM (
  SELECT max(review_month) FILTER (place <= {MONTHS}) AS a, max(running) FILTER (place <= {MONTHS}) AS na,
    min(review_month) FILTER (running >= {fv.MIN_TRAINING_ROWS}) AS b, min(running) FILTER (running >= {fv.MIN_TRAINING_ROWS}) AS nb,
    max(running) AS total_rows FROM months))""")
CTES["with_score"] = (("features",), f"""
SELECT *, {flag(f'anomaly_score >= {n(fv.SUSPICIOUS_SCORE)}')} AS is_suspicious_review FROM (
  SELECT *, least(1e0, 0.525e0 * rating_deviation_from_business_average / 3e0 + 0.375e0 * uppercase_share
    + 0.3e0 * repeated_character_flag + 0.6e0 * {flag('html_break_count >= 4')} + 0.3e0 * generic_praise_flag
    + 0.3e0 * {flag('word_count <= 3')}) AS anomaly_score FROM features)""")
CTES["training"] = (("with_score", "cutoff"), "SELECT s.* FROM with_score s, cutoff WHERE review_month < cutoff_date")
CTES["scored"] = (("with_score", "cutoff"), "SELECT s.* FROM with_score s, cutoff WHERE review_month >= cutoff_date")

BASE = (*fv.MODEL_FEATURES, "anomaly_score")


def baseline_cte(source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, coalesce(nullif(stddev_pop({c}), 0), 1e0) AS std, "
        + ", ".join(f"quantile_cont({c}, {p}) AS {name}" for name, p in
                    (("p05", 0.05), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
        + f" FROM {source}" for c in BASE)


def month_ctes(suffix: str, scored: str, base: str) -> dict:
    """Product-months, drift, decisions and queue over the given scored reviews and baseline tables."""
    terms = ", ".join(f"avg({c}) AS {c}_mean" for c in fv.MODEL_FEATURES)
    feature_drift = " + ".join(
        f"least(abs({c}_mean - (SELECT mean FROM {base} WHERE feature = '{c}')) / "
        f"greatest((SELECT std FROM {base} WHERE feature = '{c}'), {fv.TINY}), 5e0) / 5e0" for c in fv.MODEL_FEATURES)
    score = lambda c: f"(SELECT {c} FROM {base} WHERE feature = 'anomaly_score')"
    behaviour = " + ".join(f"({n(w)} * least(abs({name}) / {n(full)}, 1e0))" for name, full, w in fv.BEHAVIOUR_WEIGHTS)
    lag = lambda c: f"lag({c}) OVER (PARTITION BY business_id ORDER BY review_month)"
    x = suffix
    fills = ", ".join(f"coalesce({c}, 0e0) AS {c}" for c in fv.ZERO_FILLED_DECISION_INPUTS)
    return {
        f"business_month{x}": ((scored,), f"""
SELECT business_id, review_month, max(business_name) AS business_name, max(product_title) AS product_title, max(city) AS city,
  max(state) AS state, count(*) AS review_count, avg(stars) AS avg_rating, avg(is_extreme_rating) AS extreme_rating_share,
  avg(review_length) AS avg_review_length, avg(anomaly_score) AS avg_anomaly_score, max(anomaly_score) AS max_anomaly_score,
  avg(is_suspicious_review) AS suspicious_review_density FROM {scored} GROUP BY business_id, review_month"""),
        f"lagged{x}": ((f"business_month{x}",), f"""
SELECT *, {lag('review_count')} AS prev_review_count, {lag('avg_rating')} AS prev_avg_rating,
  {lag('extreme_rating_share')} AS prev_extreme_rating_share, {lag('avg_review_length')} AS prev_avg_review_length
FROM business_month{x}"""),
        f"shifted{x}": ((f"lagged{x}",), f"""
SELECT *, CASE WHEN prev_review_count IS NULL THEN 0e0 ELSE (review_count - prev_review_count) / greatest(prev_review_count::DOUBLE, 1e0) END AS review_volume_change,
  CASE WHEN prev_avg_rating IS NULL THEN 0e0 ELSE avg_rating - prev_avg_rating END AS rating_shift,
  CASE WHEN prev_extreme_rating_share IS NULL THEN 0e0 ELSE extreme_rating_share - prev_extreme_rating_share END AS extreme_rating_share_shift,
  CASE WHEN prev_avg_review_length IS NULL THEN 0e0 ELSE (avg_review_length - prev_avg_review_length) / greatest(prev_avg_review_length, 1e0) END AS review_length_shift
FROM lagged{x}"""),
        f"drift{x}": ((f"shifted{x}",), f"SELECT *, least(1e0, {behaviour}) AS behavioral_drift_score FROM shifted{x}"),
        f"population{x}": ((scored,), f"""
SELECT review_month, count(*) AS scored_review_count, avg(anomaly_score) AS anomaly_score_mean,
  quantile_disc(anomaly_score, 0.95) AS anomaly_score_p95, {terms} FROM {scored} GROUP BY review_month"""),
        f"parts{x}": ((f"population{x}", base), f"""
SELECT *, ({feature_drift}) / {len(fv.MODEL_FEATURES)} AS feature_drift_score,
  least((abs(anomaly_score_mean - {score('mean')}) / greatest({score('std')}, {fv.TINY})
       + abs(anomaly_score_p95 - {score('p95')}) / greatest({score('std')}, {fv.TINY})) / 6e0, 1e0) AS prediction_drift_score
FROM population{x}"""),
        f"model_drift{x}": ((f"parts{x}",), f"""
SELECT *, model_drift_score >= {n(fv.RETRAINING_ALERT)} AS retraining_alert FROM (
  SELECT *, least(1e0, {total(fv.MODEL_DRIFT_WEIGHTS)}) AS model_drift_score FROM parts{x})"""),
        f"joined{x}": ((f"drift{x}", f"model_drift{x}"), f"""
SELECT b.* EXCLUDE (suspicious_review_density, behavioral_drift_score, avg_anomaly_score, max_anomaly_score), {fills}, retraining_alert
FROM drift{x} b LEFT JOIN (SELECT review_month AS month, feature_drift_score, prediction_drift_score, model_drift_score,
  retraining_alert FROM model_drift{x}) m ON m.month = b.review_month"""),
        f"decided{x}": ((f"joined{x}",), f"SELECT *, least(1e0, {total(fv.DECISION_WEIGHTS)}) AS decision_score FROM joined{x}"),
        f"decisions{x}": ((f"decided{x}",), f"""
SELECT *, decision_score >= {n(fv.DECISION_THRESHOLD)} OR (suspicious_review_density >= 0.25e0 AND review_count >= 3)
  OR (max_anomaly_score >= 0.90e0 AND behavioral_drift_score >= 0.35e0) AS route_to_moderation FROM decided{x}"""),
        f"queue{x}": ((f"decisions{x}",), f"SELECT {', '.join(fv.QUEUE_COLUMNS)} FROM decisions{x} WHERE route_to_moderation"),
    }


CTES["baseline"] = (("training",), baseline_cte("training"))
CTES |= month_ctes("", "scored", "baseline")

folded = f"lower(trim(regexp_replace(text, '{S}+', ' ', 'g')))"
present = " OR ".join(f"{c} >= {n(v)}" for c, v in fv.MANIPULATION_SIGNALS)
absent = " AND ".join(f"{c} < {n(v)}" for c, v in fv.MANIPULATION_SIGNALS)


def case_ctes(x: str) -> dict:
    """From scored reviews and queue (both with the suffix ``x``) to the strongest reviews of each case."""
    return {
        f"copies{x}": ((f"scored{x}",), f"""
SELECT *, count(*) OVER (PARTITION BY business_id, review_month, {folded}) AS near_duplicate_review_count FROM scored{x}"""),
        f"signals1{x}": ((f"copies{x}", f"queue{x}"), f"""
SELECT c.*, q.review_count, q.extreme_rating_share, q.suspicious_review_density, q.review_volume_change,
  {flag('stars = 5 AND word_count <= 12')} AS very_short_five_star_signal,
  {flag('stars >= 4 AND word_count <= 20')} AS high_rating_short_text_signal,
  least(rating_deviation_from_business_average / 3e0, 1e0) AS extreme_deviation_signal,
  {flag('near_duplicate_review_count > 1 AND word_count >= 4')} AS duplicate_text_signal,
  least(abs(review_volume_change) / 2e0, 1e0) AS burst_signal, least(extreme_rating_share / 0.75e0, 1e0) AS extreme_cluster_signal,
  least(suspicious_review_density / 0.5e0, 1e0) AS density_signal,
  {flag('stars >= 4 AND verified_purchase = false')} AS unverified_high_rating_signal,
  least(reviewer_extreme_rating_share / 0.9e0, 1e0) AS reviewer_extreme_signal,
  least(repeated_character_flag + text_formatting_anomaly_flag + generic_praise_flag + no_space_ratio, 1e0) AS bot_text_signal,
  {flag('synthetic_templated_language_score >= 0.35e0')} AS synthetic_language_signal,
  CASE WHEN review_length >= 900 AND word_count >= 140 THEN 0.15e0 ELSE 0e0 END AS long_detailed_review_discount
FROM copies{x} c JOIN queue{x} q ON q.business_id = c.business_id AND q.review_month = c.review_month"""),
        f"signals2{x}": ((f"signals1{x}",), f"""
SELECT *, {flag(present)} AS low_star_manipulation_signal,
  CASE WHEN stars <= 2 AND {absent} THEN 0.25e0 ELSE 0e0 END AS complaint_only_discount,
  {' + '.join(flag(f'{c} >= {n(v)}') for c, v in fv.COUNTED_SIGNALS)} AS fraud_signal_count FROM signals1{x}"""),
        f"signals{x}": ((f"signals2{x}",), f"SELECT *, {clip(total(fv.FRAUD_WEIGHTS))} AS fraud_like_score FROM signals2{x}"),
        f"surfaced{x}": ((f"signals{x}",), f"""
SELECT * FROM signals{x} WHERE fraud_signal_count >= 2 AND fraud_like_score >= 0.60e0
  AND (stars > 2 OR low_star_manipulation_signal = 1)"""),
        f"top{x}": ((f"surfaced{x}",), f"""
SELECT *, clean AS review_text, clean AS review_text_preview FROM surfaced{x}
QUALIFY row_number() OVER (PARTITION BY business_id, review_month ORDER BY fraud_like_score DESC, fraud_signal_count DESC,
  anomaly_score DESC, review_id, stars, useful, review_title, verified_purchase) <= {fv.TOP_REVIEWS_PER_CASE}"""),
    }


CTES |= case_ctes("")
for name, source, key, text in (("documents_t", "documents", "doc_id", "text"), ("pages_t", "pages", "page_id", "html"),
                                ("conversations_t", "conversations", "conv_id, turn", "text")):
    CTES[f"{name}0"] = ((), f"SELECT {key}, {text} AS text, 5e0 AS stars FROM {source}")
    CTES |= text_ctes(name, f"{name}0", key, (f"{name}0",))

# ---- sampling and forest ---------------------------------------------------
SLOTS, TREES, DEEPEST = 211, fv.FOREST_TREES, 8  # 211: the smallest prime >= 200; 2 ** 8 rows per tree
SAMPLE_ROWS, SAMPLE_SEED = 2000, 7


def uniform(seed: int, *parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(parts)})), 1, 8))::BIGINT / 4294967296e0)"


vector = ", ".join(fv.MODEL_FEATURES)
CTES["sampled"] = (("training", "cutoff"), f"""
SELECT review_id, stars, word_count, unnest(range(kept)) AS copy FROM (
  SELECT *, floor(copies * least(1e0, {SAMPLE_ROWS}e0 / training_rows) + {uniform(SAMPLE_SEED, "'sample'", 'review_id')})::BIGINT AS kept
  FROM (SELECT review_id, stars, word_count, count(*) AS copies FROM training GROUP BY ALL), cutoff)""")
CTES["plan"] = (("cutoff",), f"""
SELECT n, size, needed, least(1e0, needed::DOUBLE / n) AS share, least({SLOTS}, ceil(needed::DOUBLE / greatest(least(n, needed), 1)))::BIGINT AS per_row
FROM (SELECT n, size, ceil(1.5 * {SLOTS} * size)::BIGINT AS needed
      FROM (SELECT training_rows AS n, least({fv.FOREST_SUBSAMPLE}, training_rows) AS size FROM cutoff))""")
SEED = fv.FOREST_SEED
CTES["drawn"] = (("training", "plan"), f"""
SELECT review_id, {vector}, per_row, size, unnest(range(1, kept + 1)) AS copy FROM (
  SELECT *, floor(copies * share + {uniform(SEED, "'sample'", 'review_id')})::BIGINT AS kept
  FROM (SELECT review_id, {vector}, count(*) AS copies FROM training GROUP BY ALL), plan)""")
CTES["dealt"] = (("drawn",), f"""
SELECT *, floor({uniform(SEED, "'slot'", 'review_id', 'copy')} * {SLOTS})::BIGINT AS first_slot,
  floor({uniform(SEED, "'step'", 'review_id', 'copy')} * {SLOTS - 1})::BIGINT + 1 AS step, unnest(range(per_row)) AS turn FROM drawn""")
CTES["grown0"] = (("dealt",), f"""
SELECT tree, 1 AS node, [{vector}] AS v FROM (SELECT *, (first_slot + turn * step) % {SLOTS} AS tree FROM dealt)
WHERE tree < {TREES}
QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {uniform(SEED, "'rank'", 'tree', 'review_id', 'copy')}, copy, review_id, {vector}) <= size""")
WIDTH = len(fv.MODEL_FEATURES)
for depth in range(DEEPEST + 1):
    low = ", ".join(f"min(v[{i + 1}])" for i in range(WIDTH))
    high = ", ".join(f"max(v[{i + 1}])" for i in range(WIDTH))
    CTES[f"split{depth}"] = ((f"grown{depth}",), f"""
SELECT tree, node, size, feature, CASE WHEN cut >= high[feature + 1] THEN low[feature + 1] ELSE cut END AS threshold FROM (
  SELECT *, low[feature + 1] + {uniform(SEED, 'tree', 'node', "'cut'")} * (high[feature + 1] - low[feature + 1]) AS cut FROM (
    SELECT *, CASE WHEN {depth} = {DEEPEST} OR len(varying) = 0 THEN -1
      ELSE varying[floor({uniform(SEED, 'tree', 'node', "'feature'")} * len(varying))::BIGINT + 1] END AS feature FROM (
      SELECT *, list_filter(range({WIDTH}), lambda i: high[i + 1] > low[i + 1]) AS varying FROM (
        SELECT tree, node, count(*) AS size, [{low}] AS low, [{high}] AS high FROM grown{depth} GROUP BY tree, node))))""")
    CTES[f"grown{depth + 1}"] = ((f"split{depth}",), f"""
SELECT g.tree, 2 * g.node + (CASE WHEN v[feature + 1] <= threshold THEN 0 ELSE 1 END) AS node, v
FROM grown{depth} g JOIN split{depth} s ON s.tree = g.tree AND s.node = g.node WHERE feature >= 0""")
EXPECTED = f"(CASE WHEN size <= 1 THEN 0e0 WHEN size = 2 THEN 1e0 ELSE 2 * (ln(size - 1e0) + {fv.EULER_GAMMA!r}e0) - 2 * (size - 1e0) / size END)"
CTES["nodes"] = (tuple(f"split{d}" for d in range(DEEPEST + 1)), f"""
SELECT tree, node, depth, size, feature, CASE WHEN feature >= 0 THEN threshold END AS threshold,
  CASE WHEN feature < 0 THEN depth + {EXPECTED} END AS path_length
FROM ({' UNION ALL '.join(f'SELECT *, {d} AS depth FROM split{d}' for d in range(DEEPEST + 1))})""")


def forest_score(source: str) -> str:
    """Each row walks down each tree."""
    walk = f"SELECT row, t.tree, 1::BIGINT AS node, v FROM rows_of CROSS JOIN (SELECT DISTINCT tree FROM nodes) t"
    for _ in range(DEEPEST):
        walk = (f"SELECT w.row, w.tree, CASE WHEN feature < 0 THEN w.node ELSE 2 * w.node + (CASE WHEN v[feature + 1] <= threshold "
                f"THEN 0 ELSE 1 END) END AS node, v FROM ({walk}) w JOIN nodes n ON n.tree = w.tree AND n.node = w.node")
    return f"""WITH rows_of AS MATERIALIZED (SELECT row_number() OVER () AS row, * , [{vector}] AS v FROM {source})
SELECT r.* EXCLUDE (row, v), raw FROM rows_of r JOIN (
  SELECT w.row, pow(2e0, -avg(path_length) / (SELECT {EXPECTED} FROM plan)) AS raw
  FROM ({walk}) w JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY w.row) s ON s.row = r.row"""


CTES["training_raw"] = (("training", "nodes", "plan"), forest_score(f"(SELECT * EXCLUDE (anomaly_score, is_suspicious_review) FROM training)"))
CTES["bounds"] = (("training_raw",), "SELECT quantile_cont(raw, 0.01) AS lo, quantile_cont(raw, 0.99) AS hi FROM training_raw")
CTES["training_f"] = (("training_raw", "bounds"), f"SELECT t.*, {clip('(raw - lo) / greatest(hi - lo, 1e-9)')} AS anomaly_score FROM training_raw t, bounds")
CTES["scored_raw"] = (("scored", "nodes", "plan"), forest_score("(SELECT * EXCLUDE (anomaly_score, is_suspicious_review) FROM scored)"))
CTES["scored_f"] = (("scored_raw", "bounds"), f"""
SELECT *, {flag(f'anomaly_score >= {n(fv.SUSPICIOUS_SCORE)}')} AS is_suspicious_review FROM (
  SELECT s.*, {clip('(raw - lo) / greatest(hi - lo, 1e-9)')} AS anomaly_score FROM scored_raw s, bounds)""")
CTES["baseline_f"] = (("training_f",), baseline_cte("training_f"))
CTES |= month_ctes("_f", "scored_f", "baseline_f") | case_ctes("_f")

# ---- moderators -----------------------------------------------------------
CTES["label_log"] = ((), """
SELECT 'D' || doc_id AS review_id, CASE WHEN toxic = 0 THEN (CASE WHEN quality = 0 THEN 'suspicious' ELSE 'not suspicious' END)
  ELSE 'unsure' END AS label FROM labels""")
arms = " UNION ALL ".join(f"SELECT {i} AS arm, {n(t)} AS threshold" for i, t in enumerate(fv.ARM_THRESHOLDS))
CTES["arms"] = (("label_log",), f"""
SELECT a.arm, a.threshold, count(o.label) AS trials, count(o.label) FILTER (o.label = 'suspicious')::DOUBLE AS reward,
  count(o.label) FILTER (o.label = 'suspicious')::DOUBLE / greatest(count(o.label), 1) AS mean_reward
FROM ({arms}) a LEFT JOIN (SELECT substr(review_id, 2)::BIGINT % {len(fv.ARM_THRESHOLDS)} AS arm, label FROM label_log) o
  ON o.arm = a.arm GROUP BY a.arm, a.threshold""")

BLANK = r"[\s\x0B\p{Z}\x1C-\x1F\x{85}]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def displayed(source: str, key: str, text: str) -> str:
    ingredients = " OR ".join(f"contains(lower(shown), {q(t)})" for t in fv.INGREDIENT_TERMS)
    return f"""WITH a AS (SELECT {key}, CASE WHEN {text} IS NULL OR lower({strip(text)}) IN ('', 'nan', 'none', 'null') THEN ''
  ELSE regexp_replace(regexp_replace({text}, '<br{S}*/?>', chr(10), 'gi'), '\\n{{3,}}', chr(10) || chr(10), 'g') END AS body FROM {source}),
b AS (SELECT {key}, {strip(f"CASE WHEN length(body) > 20 AND length(body) - length(replace(body, chr(10), '')) > length(body) * 0.35e0 THEN replace(body, chr(10), ' ') ELSE body END")} AS shown FROM a)
SELECT {key}, md5(shown) AS shown_md5, length(shown)::INTEGER AS shown_length,
  ({ingredients}) OR length(shown) - length(replace(shown, ',', '')) >= 18 AS ingredient_list FROM b"""


def explained_review() -> str:
    r = {k: q(v) for k, v in fv.REVIEW_REASONS.items()}
    body = displayed_text = strip("regexp_replace(clean, '\\n{3,}', chr(10) || chr(10), 'g')")
    body = f"(CASE WHEN lower({strip('clean')}) IN ('', 'nan', 'none', 'null') THEN '' ELSE {displayed_text} END)"
    praise = " OR ".join(f"contains(lower(body), {q(p)})" for p in fv.PRAISE_IN_EXPLANATION)
    ingredients = " OR ".join(f"contains(lower(body), {q(t)})" for t in fv.INGREDIENT_TERMS)
    d = "rating_deviation_from_product_average"
    cases = [
        f"CASE WHEN stars >= 5 AND word_count <= 12 THEN {r['short_five']} WHEN stars <= 1 AND word_count <= 12 THEN {r['short_one']} END",
        f"CASE WHEN {d} > 0.25e0 THEN {r['above_usual']} WHEN {d} < -0.25e0 THEN {r['below_usual']} END",
        f"CASE WHEN reviewer_review_count <> 0 AND reviewer_review_count <= 2 THEN {r['few_reviews']} END",
        f"CASE WHEN reviewer_average_rating >= 4.5e0 THEN {r['rates_high']} WHEN reviewer_average_rating BETWEEN 0 AND 2 THEN {r['rates_low']} END",
        f"CASE WHEN generic_praise_flag >= 1 OR {praise} THEN {r['praise']} END",
        f"CASE WHEN synthetic_templated_language_score >= 0.5e0 THEN {r['templated']} END",
        f"CASE WHEN repeated_character_flag >= 1 THEN {r['repeated']} END",
        f"CASE WHEN text_formatting_anomaly_flag >= 1 THEN {r['formatting']} END",
        f"CASE WHEN uppercase_share > 0.45e0 THEN {r['capitals']} END",
        f"CASE WHEN length(body) > 20 AND NOT contains(substr(body, 1, 80), ' ') THEN {r['unspaced']} END",
        f"CASE WHEN {ingredients} OR length(body) - length(replace(body, ',', '')) >= 18 THEN {r['ingredients']} END",
    ]
    return f"""SELECT review_id, concat_ws(' ', CASE WHEN found = '' THEN {r['fallback']} ELSE found END, {r['closing']}) AS explanation
FROM (SELECT review_id, concat_ws(' ', {', '.join(cases)}) AS found FROM (SELECT *, {body} AS body FROM surfaced))"""


def explained_case() -> str:
    r = {k: q(v) for k, v in fv.CASE_REASONS.items()}
    cases = [
        f"CASE WHEN max_anomaly_score >= 0.8e0 THEN {r['max_anomaly_score']} END",
        f"CASE WHEN suspicious_review_density >= 0.25e0 THEN {r['suspicious_review_density']} END",
        f"CASE WHEN abs(review_volume_change) >= 1 THEN {r['review_volume_change']} END",
        f"CASE WHEN abs(rating_shift) >= 1 THEN {r['rating_shift']} END",
        f"CASE WHEN abs(extreme_rating_share_shift) >= 0.25e0 THEN {r['extreme_rating_share_shift']} END",
        f"CASE WHEN model_drift_score >= 0.65e0 THEN {r['model_drift_score']} END",
    ]
    return f"""SELECT business_id, strftime(review_month, '%Y-%m-%d') AS review_month,
  coalesce(business_name, business_id) || ' was flagged for ' || strftime(review_month, '%Y-%m-%d') || ' because '
  || CASE WHEN found = '' THEN {r['fallback']} ELSE found END || '.' AS explanation
FROM (SELECT *, concat_ws('; ', {', '.join(cases)}) AS found FROM queue)"""


# ---- registered texts -----------------------------------------------------
BASIC_TEXT = ("review_length", "word_count", "avg_word_length", "uppercase_share", "no_space_ratio")
SENTENCES = ("word_count", "sentence_count", "avg_sentence_length", "sentence_length_variability")
FLAGS = ("repeated_character_flag", "generic_praise_flag", "first_person_flag", "concrete_detail_flag",
         "balanced_pros_cons_flag", "specific_experience_flag", "repeated_promotional_language_flag")
FORMATTING = ("html_break_count", "text_formatting_anomaly_flag")
ALL_TEXT = tuple(dict.fromkeys((*BASIC_TEXT, *SENTENCES, *FLAGS, *FORMATTING)))
MONTH_DOUBLES = ("avg_rating", "extreme_rating_share", "avg_review_length", "avg_anomaly_score", "max_anomaly_score",
                 "suspicious_review_density")
MONTH_COLUMNS = ("business_id", "review_month", "business_name", "product_title", "city", "state", "review_count", *MONTH_DOUBLES)
SHIFTS = ("prev_avg_rating", "prev_extreme_rating_share", "prev_avg_review_length", "review_volume_change", "rating_shift",
          "extreme_rating_share_shift", "review_length_shift", "behavioral_drift_score")
DRIFT_COLUMNS = (*MONTH_COLUMNS, "prev_review_count", *SHIFTS)
DRIFTS = ("feature_drift_score", "prediction_drift_score", "model_drift_score")
DECISION_DOUBLES = (*MONTH_DOUBLES, *SHIFTS, *DRIFTS, "decision_score")
SIGNAL_COLUMNS = (
    "very_short_five_star_signal", "high_rating_short_text_signal", "extreme_deviation_signal", "duplicate_text_signal",
    "burst_signal", "extreme_cluster_signal", "density_signal", "unverified_high_rating_signal", "reviewer_extreme_signal",
    "bot_text_signal", "synthetic_language_signal", "low_star_manipulation_signal", "complaint_only_discount",
    "long_detailed_review_discount", "fraud_signal_count", "fraud_like_score")
NOT_DOUBLE_TOP = {"business_id", "business_name", "product_title", "product_id", "review_month", "review_id", "user_id",
                  "review_date", "review_title", "verified_purchase", "near_duplicate_review_count", "review_text",
                  "review_text_preview"}


def texts(cte: str, key, columns) -> str:
    return build(cte, final=f"SELECT {', '.join(key)}, {shown(columns, columns)} FROM {cte}")


def select(cte: str, columns, doubles=(), dates=(), tail="") -> str:
    return build(cte, final=f"SELECT {shown(columns, doubles, dates)} FROM {cte} {tail}")


stamp = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
review_columns = ["review_id", "user_id", "business_id", "product_id", "category", "asin", "parent_asin", "stars", "useful",
                  "funny", "cool", "text", "review_title", "verified_purchase"]
POPULATION = ("anomaly_score_mean", "anomaly_score_p95", *[f"{c}_mean" for c in fv.MODEL_FEATURES])
FEATURE_DOUBLES = ("rating_deviation_from_product_average", "synthetic_templated_language_score", *fv.MODEL_FEATURES)
label_reviews = "CASE WHEN verified_purchase THEN CASE WHEN stars = 5 THEN 'suspicious' ELSE 'unsure' END END"

ORACLE_SQL: dict[str, str] = {
    "ingest_normalised": build("reviews", final=f"SELECT {', '.join(review_columns)}, {stamp.format('review_timestamp')}, "
                                                f"{stamp.format('review_datetime')} FROM reviews"),
    "review_id_hash": build("reviews", final=f"SELECT review_id, business_id, {stamp.format('review_timestamp')} FROM reviews"),
    "json_path_fields": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, "
                        "json_extract_string(props, '$.absent') AS absent FROM events",
    "metadata_latest": build("metadata", final="SELECT asin, product_title FROM metadata"),
    "product_dim": select("products", ("business_id", "product_id", "listed_business_stars", "listed_review_count",
                                       "product_title", "category", "average_rating", "business_name", "city", "state",
                                       "categories"), ("listed_business_stars", "average_rating")),
    "text_basic": texts("texts", ["review_id"], BASIC_TEXT),
    "text_sentences": texts("texts", ["review_id"], SENTENCES),
    "text_flags": texts("texts", ["review_id"], FLAGS),
    "html_breaks": texts("texts", ["review_id"], FORMATTING),
    "synthetic_score": texts("texts", ["review_id"], ("synthetic_templated_language_score",)),
    "document_text_features": texts("documents_t", ["doc_id"], ALL_TEXT),
    "page_text_features": texts("pages_t", ["page_id"], ALL_TEXT),
    "conversation_text_features": texts("conversations_t", ["conv_id", "turn"], ALL_TEXT),
    "business_average": build("reviews", final=f"SELECT business_id, round(avg(stars), {DIGITS}) + 0e0 AS "
                              "business_average_stars, count(*) AS business_rows FROM reviews GROUP BY business_id"),
    "reviewer_profile": select("reviewers", ("user_id", *REVIEWER), REVIEWER),
    "review_features": select("features", ("review_id", "business_id", "user_id", "review_date", "review_month",
                                           "product_title", *FEATURE_DOUBLES), FEATURE_DOUBLES, ("review_date", "review_month")),
    "review_features_as_of": select(
        "features_as_of", ("review_id", "business_id", "user_id", "review_date", "review_month", "product_title",
                           "rating_deviation_from_product_average", *fv.MODEL_FEATURES),
        ("rating_deviation_from_product_average", *fv.MODEL_FEATURES), ("review_date", "review_month")),
    "monthly_counts": select("months", ("review_month", "count"), (), ("review_month",)),
    "training_cutoff": select("cutoff", ("cutoff_date", "training_rows", "total_rows", "by_months"), (), ("cutoff_date",)),
    "baseline_stats": select("baseline", ("feature", "mean", "std", "p05", "p50", "p95", "p99"),
                             ("mean", "std", "p05", "p50", "p95", "p99")),
    "score_normalise": build("training", final=f"""SELECT review_id, round({clip('(anomaly_score - lo) / greatest(hi - lo, 1e-9)')}, {DIGITS}) + 0e0
  AS normalised_score FROM training, (SELECT quantile_cont(anomaly_score, 0.01) AS lo, quantile_cont(anomaly_score, 0.99) AS hi FROM training)"""),
    "imputed_scaled": build("documents_t", final=f"""
SELECT doc_id, {', '.join(f"round((coalesce({c}, m_{c}) - avg(coalesce({c}, m_{c})) OVER ()) / coalesce(nullif(stddev_pop(coalesce({c}, m_{c})) OVER (), 0), 1e0), {DIGITS}) + 0e0 AS {c}" for c in ("stars", "review_length", "uppercase_share"))}
FROM (SELECT *, {', '.join(f"quantile_cont({c}, 0.5) OVER () AS m_{c}" for c in ("stars", "review_length", "uppercase_share"))}
  FROM (SELECT d.doc_id, l.quality * 4e0 + 1e0 AS stars, review_length, uppercase_share FROM documents_t d LEFT JOIN labels l ON l.doc_id = d.doc_id))"""),
    "stored_by_month": build("scored", final=f"SELECT review_id, business_id, strftime(review_month, '%Y-%m-%d') AS review_month, "
                             f"'reviews' AS dataset, {shown(fv.MODEL_FEATURES, fv.MODEL_FEATURES)} FROM scored"),
    "stored_categories": build("reviews", final="""SELECT * FROM (SELECT review_id, business_id, stars, useful,
  CASE WHEN verified_purchase THEN 'kept' WHEN useful > 0 THEN 'returned' ELSE 'other' END AS category FROM reviews)
WHERE category = 'kept' OR category = 'returned' AND stars < 5"""),
    "rejected_records": build("raw", final="""SELECT rejection,
  CASE WHEN rejection NOT IN ('malformed', 'no product') THEN coalesce(parent_asin, asin) END AS business_id, count(*) AS records
FROM (SELECT *, CASE review_title WHEN '1-URGENT' THEN 'malformed' WHEN '2-HIGH' THEN 'no rating' WHEN '3-MEDIUM' THEN 'no time'
  WHEN '4-NOT SPECIFIED' THEN 'no product' ELSE 'accepted' END AS rejection FROM raw) GROUP BY ALL"""),
    "business_month": select("business_month", MONTH_COLUMNS, MONTH_DOUBLES, ("review_month",)),
    "replay_month_signals": select("business_month", MONTH_COLUMNS, MONTH_DOUBLES, ("review_month",)),
    "replay_forest_months": select("business_month_f", MONTH_COLUMNS, MONTH_DOUBLES, ("review_month",)),
    "behavioral_drift": select("drift", DRIFT_COLUMNS, (*MONTH_DOUBLES, *SHIFTS), ("review_month",)),
    "replay_behavioral_drift": select("drift", DRIFT_COLUMNS, (*MONTH_DOUBLES, *SHIFTS), ("review_month",)),
    "model_drift": select("model_drift", ("review_month", "scored_review_count", *POPULATION, *DRIFTS, "retraining_alert"),
                          (*POPULATION, *DRIFTS), ("review_month",)),
    "decisions": select("decisions", (*DRIFT_COLUMNS, *DRIFTS, "retraining_alert", "decision_score", "route_to_moderation"),
                        DECISION_DOUBLES, ("review_month",)),
    "moderation_queue": select("queue", fv.QUEUE_COLUMNS, DECISION_DOUBLES, ("review_month",),
                               "ORDER BY queue.decision_score DESC, review_count DESC, business_id, queue.review_month"),
    "queue_places": build("queue", final=f"""SELECT business_id, strftime(review_month, '%Y-%m-%d') AS review_month,
  round(decision_score, {DIGITS}) + 0e0 AS decision_score, review_count,
  row_number() OVER (ORDER BY round(decision_score, {DIGITS}) DESC, review_count DESC, business_id, queue.review_month) AS place
FROM queue"""),
    "queue_explained": build("queue", final=explained_case()),
    "duplicate_reviews": build("copies", final="SELECT review_id, near_duplicate_review_count FROM copies"),
    "fraud_signals": select("signals", ("review_id", "business_id", "review_month", "near_duplicate_review_count",
                                        *SIGNAL_COLUMNS), SIGNAL_COLUMNS, ("review_month",)),
    "top_suspicious_reviews": select("top", fv.TOP_REVIEW_COLUMNS, set(fv.TOP_REVIEW_COLUMNS) - NOT_DOUBLE_TOP,
                                     ("review_month", "review_date")),
    "review_explanations": build("surfaced", final=explained_review()),
    "document_display": displayed("documents", "doc_id", "text"),
    "page_display": displayed("pages", "page_id", "html"),
    "display_names": build("queue", final="""SELECT business_id, strftime(review_month, '%Y-%m-%d') AS month_key,
  strftime(review_month, '%b %Y') AS month_label, coalesce(product_title, 'Unknown product (ASIN ' || substr(business_id, 1, 12) || ')') AS display_name,
  CASE WHEN max_anomaly_score >= 0.9e0 THEN 'Highly unusual' WHEN max_anomaly_score >= 0.7e0 THEN 'Unusual' ELSE 'Lower priority' END AS anomaly_band
FROM queue"""),
    "review_backed_cases": build("queue", "top", final=f"""SELECT business_id, strftime(review_month, '%Y-%m-%d') AS review_month,
  business_id AS product_key, strftime(review_month, '%Y-%m-%d') AS month_key, round(decision_score, {DIGITS}) + 0e0 AS decision_score
FROM queue q WHERE EXISTS (SELECT 1 FROM top t WHERE t.business_id = q.business_id AND t.review_month = q.review_month)"""),
    "case_reviews": build("queue", "top", final=f"""SELECT t.business_id AS product_key, strftime(t.review_month, '%Y-%m-%d') AS month_key,
  review_id, round(decision_score, {DIGITS}) + 0e0 AS decision_score, round(fraud_like_score, {DIGITS}) + 0e0 AS fraud_like_score, fraud_signal_count
FROM top t JOIN queue q ON t.business_id = q.business_id AND t.review_month = q.review_month"""),
    "synthetic_top200": build("top", final=f"""SELECT review_id, business_id, round(s, {DIGITS}) + 0e0 AS synthetic_templated_language_score
FROM (SELECT review_id, business_id, synthetic_templated_language_score AS s FROM top ORDER BY s DESC, review_id LIMIT {fv.SYNTHETIC_BROWSE_LIMIT})"""),
    "latest_labels": build("label_log", final="SELECT review_id, label FROM label_log"),
    "labelled_top_reviews": build("top", final=f"SELECT review_id, business_id, stars, {label_reviews} AS moderator_label FROM top"),
    "precision_by_threshold": build("documents_t", "label_log", final=f"""
SELECT threshold, count(*) FILTER (hit AND s >= threshold) AS true_positives, count(*) FILTER (miss AND s >= threshold) AS false_positives,
  count(*) FILTER (hit AND s < threshold) AS missed,
  round(count(*) FILTER (hit AND s >= threshold)::DOUBLE / nullif(count(*) FILTER ((hit OR miss) AND s >= threshold), 0), {DIGITS}) + 0e0 AS precision
FROM (SELECT synthetic_templated_language_score AS s, label = 'suspicious' AS hit, label = 'not suspicious' AS miss
      FROM documents_t JOIN label_log ON review_id = 'D' || doc_id),
  (VALUES (0.05e0), (0.1e0), (0.15e0), (0.2e0)) t(threshold) GROUP BY threshold"""),
    "arm_stats": build("arms", final=f"SELECT arm, threshold, trials, reward, round(mean_reward, {DIGITS}) + 0e0 AS mean_reward FROM arms"),
    "hash_sample": build("sampled", final=f"SELECT review_id, {shown(('stars', 'word_count'), ('stars', 'word_count'))} FROM sampled"),
    "forest_nodes": build("nodes", final=f"SELECT tree, node, depth, size, feature, round(threshold, 6) + 0e0 AS threshold, {shown(('path_length',), ('path_length',))} FROM nodes"),
    "forest_scores": build("training_raw", final=f"SELECT review_id, round(raw, {DIGITS}) + 0e0 AS raw_score FROM training_raw"),
    "forest_top_reviews": select("top_f", fv.TOP_REVIEW_COLUMNS, set(fv.TOP_REVIEW_COLUMNS) - NOT_DOUBLE_TOP,
                                 ("review_month", "review_date")),
    "forest_cases": select("queue_f", fv.QUEUE_COLUMNS, DECISION_DOUBLES, ("review_month",)),
    "threshold_choice": build("arms", final="SELECT threshold, false AS explored FROM arms ORDER BY mean_reward DESC, arm LIMIT 1"),
}
