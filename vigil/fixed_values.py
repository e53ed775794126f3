"""Fixed values.

Every constant below must have exactly this value for results to be right:
thresholds, word lists, patterns, weights, message texts and column lists.
"""

# ---- thresholds ----------------------------------------------------------
SUSPICIOUS_SCORE = 0.70
DECISION_THRESHOLD = 0.70
RETRAINING_ALERT = 0.65
CONTAMINATION = 0.03
MIN_TRAINING_ROWS = 1_000
MIN_TRAINING_MONTHS = 24
TRAINING_MONTHS = 12
TOP_REVIEWS_PER_CASE = 10
SYNTHETIC_BROWSE_LIMIT = 200
MILLISECOND_EPOCH_ABOVE = 9_999_999_999
FOREST_TREES = 200
FOREST_SUBSAMPLE = 256
FOREST_SEED = 42
EULER_GAMMA = 0.5772156649015329
TINY = 1e-9

# ---- text patterns -------------------------------------------------------
HTML_BREAK = r"(?i)<br\s*/?>"
WHITESPACE_RUN = r" \s+|[\t\n\x0B\f\r]\s*"
SENTENCE_BREAK = r"[.!?|]+"
NOT_UPPER = r"[^A-Z]+"
NOT_LETTER = r"[^A-Za-z]+"
REPEATED_CHARACTER = r"(.)\1{4,}"
BLANK_LINES = r"\n\s*\n\s*\n"

# ---- word lists ----------------------------------------------------------
GENERIC_PRAISE = (
    "great product", "love it", "works great", "highly recommend",
    "excellent product", "perfect", "five stars",
)
FIRST_PERSON = ("i", "me", "my", "mine", "we", "our", "ours")
CONCRETE_DETAIL = (
    "skin", "hair", "face", "scent", "smell", "bottle", "package", "packaging",
    "color", "size", "shade", "brush", "cream", "lotion", "shampoo", "makeup",
    "mascara", "used", "using", "week", "weeks", "month", "months", "morning",
    "night", "dry", "oily", "sensitive",
)
BALANCED = ("but", "however", "although", "pros", "cons", "downside", "except")
EXPERIENCE = (
    "used", "using", "bought", "purchased", "tried", "after", "before",
    "for my", "on my", "arrived",
)
PROMOTIONAL = (
    "amazing product", "must buy", "best product", "buy it",
    "worth every penny", "five stars", "highly recommend",
)
PRAISE_IN_EXPLANATION = ("great product", "love it", "works great", "highly recommend")
INGREDIENT_TERMS = (
    "ingredient list", "ingredients:", "full ingredient", "butylene glycol",
    "glycerin", "hyaluronic acid", "ceramide", "disodium edta", "chlorphenesin",
)
MISSING_WORDS = ("", "nan", "none", "null")
LABELS = ("suspicious", "not suspicious", "unsure")
ARM_THRESHOLDS = (0.60, 0.70, 0.80)
EXPLORE_SHARE = 0.10

# ---- score weights, in summation order -----------------------------------
TEMPLATED_WEIGHTS = (
    ("generic_praise_flag", 0.20),
    ("short_five_star", 0.15),
    ("repeated_promotional_language_flag", 0.15),
    ("lacks_detail", 0.15),
    ("even_sentences", 0.10),
    ("text_formatting_anomaly_flag", 0.10),
    ("repeated_character_flag", 0.05),
    ("no_space_ratio", 0.05),
    ("first_person_flag", -0.10),
    ("concrete_detail_flag", -0.15),
    ("balanced_pros_cons_flag", -0.10),
    ("specific_experience_flag", -0.10),
)
# (shift, size at which the term saturates, weight)
BEHAVIOUR_WEIGHTS = (
    ("review_volume_change", 2.0, 0.30),
    ("rating_shift", 2.0, 0.25),
    ("extreme_rating_share_shift", 0.50, 0.25),
    ("review_length_shift", 1.0, 0.20),
)
MODEL_DRIFT_WEIGHTS = (("feature_drift_score", 0.55), ("prediction_drift_score", 0.45))
DECISION_WEIGHTS = (
    ("max_anomaly_score", 0.35),
    ("suspicious_review_density", 0.25),
    ("behavioral_drift_score", 0.25),
    ("model_drift_score", 0.15),
)
FRAUD_WEIGHTS = (
    ("very_short_five_star_signal", 0.20),
    ("high_rating_short_text_signal", 0.15),
    ("extreme_deviation_signal", 0.20),
    ("duplicate_text_signal", 0.15),
    ("burst_signal", 0.10),
    ("extreme_cluster_signal", 0.10),
    ("density_signal", 0.10),
    ("unverified_high_rating_signal", 0.10),
    ("reviewer_extreme_signal", 0.10),
    ("bot_text_signal", 0.15),
    ("synthetic_templated_language_score", 0.05),
    ("anomaly_score", 0.10),
    ("long_detailed_review_discount", -1.0),
    ("complaint_only_discount", -1.0),
)
# (signal, value from which it counts as present)
COUNTED_SIGNALS = (
    ("very_short_five_star_signal", 1.0),
    ("high_rating_short_text_signal", 1.0),
    ("extreme_deviation_signal", 0.50),
    ("duplicate_text_signal", 1.0),
    ("burst_signal", 0.50),
    ("extreme_cluster_signal", 0.75),
    ("density_signal", 0.75),
    ("unverified_high_rating_signal", 1.0),
    ("reviewer_extreme_signal", 0.75),
    ("bot_text_signal", 0.50),
    ("synthetic_language_signal", 1.0),
)
MANIPULATION_SIGNALS = (
    ("duplicate_text_signal", 1.0),
    ("burst_signal", 0.50),
    ("reviewer_extreme_signal", 0.75),
    ("bot_text_signal", 0.50),
    ("synthetic_language_signal", 1.0),
)

# ---- message texts -------------------------------------------------------
CASE_REASONS = {
    "max_anomaly_score": "one or more reviews have unusually high anomaly scores",
    "suspicious_review_density": "a high share of reviews in this month are suspicious",
    "review_volume_change": "review volume changed sharply versus the prior month",
    "rating_shift": "average rating shifted materially versus the prior month",
    "extreme_rating_share_shift": "the share of extreme ratings changed materially",
    "model_drift_score": "model monitoring indicates drift in the scored population",
    "fallback": "combined anomaly and drift signals crossed the moderation threshold",
}
REVIEW_REASONS = {
    "short_five": "This is a very short 5-star review, which can resemble low-detail promotional activity.",
    "short_one": "This is a very short 1-star review, which can indicate low-detail extreme feedback.",
    "above_usual": "The rating is higher than this product's usual rating.",
    "below_usual": "The rating is lower than this product's usual rating.",
    "few_reviews": "This reviewer has limited review history in the observed data.",
    "rates_high": "This reviewer usually gives high ratings.",
    "rates_low": "This reviewer usually gives low ratings.",
    "praise": "The wording includes generic praise that can appear in templated reviews.",
    "templated": "The language appears generic, templated, overly promotional, or low-specificity.",
    "repeated": "The text contains repeated characters that may indicate unnatural formatting.",
    "formatting": "The text has formatting irregularities such as broken spacing or excessive line breaks.",
    "capitals": "The review has unusually high capitalization.",
    "unspaced": "The text has little normal spacing, which can be a bot-like formatting signal.",
    "ingredients": "The review includes a long ingredient-list style block, which can be a copied "
                   "product-detail or promotional-content signal rather than normal customer language.",
    "fallback": "This review was prioritized because multiple fraud-like signals are elevated for this case.",
    "closing": "This is not a final fraud verdict. It is a reason to review.",
}

# ---- column lists --------------------------------------------------------
MODEL_FEATURES = (
    "stars", "review_length", "word_count", "useful", "funny", "cool",
    "is_extreme_rating", "rating_deviation_from_business_average",
    "reviewer_average_rating", "reviewer_review_count",
    "reviewer_extreme_rating_share", "reviewer_five_star_share",
    "reviewer_one_star_share", "uppercase_share", "repeated_character_flag",
    "avg_word_length", "generic_praise_flag", "html_break_count",
    "text_formatting_anomaly_flag",
)
ZERO_FILLED_FEATURES = (
    "useful", "funny", "cool", "review_length", "word_count", "avg_word_length",
    "uppercase_share", "repeated_character_flag", "generic_praise_flag",
    "html_break_count", "text_formatting_anomaly_flag", "no_space_ratio",
    "is_extreme_rating", "rating_deviation_from_product_average",
    "rating_deviation_from_business_average", "reviewer_average_rating",
    "reviewer_review_count", "reviewer_extreme_rating_share",
    "reviewer_five_star_share", "reviewer_one_star_share", "sentence_count",
    "avg_sentence_length", "sentence_length_variability", "first_person_flag",
    "concrete_detail_flag", "balanced_pros_cons_flag",
    "specific_experience_flag", "repeated_promotional_language_flag",
    "synthetic_templated_language_score",
)
ZERO_FILLED_DECISION_INPUTS = (
    "feature_drift_score", "prediction_drift_score", "model_drift_score",
    "suspicious_review_density", "behavioral_drift_score",
    "avg_anomaly_score", "max_anomaly_score",
)
QUEUE_COLUMNS = (
    "business_id", "business_name", "product_title", "city", "state",
    "review_month", "review_count", "avg_rating", "extreme_rating_share",
    "avg_review_length", "avg_anomaly_score", "max_anomaly_score",
    "suspicious_review_density", "review_volume_change", "rating_shift",
    "extreme_rating_share_shift", "review_length_shift",
    "behavioral_drift_score", "feature_drift_score", "prediction_drift_score",
    "model_drift_score", "retraining_alert", "decision_score",
)
TOP_REVIEW_COLUMNS = (
    "business_id", "business_name", "product_title", "product_id",
    "review_month", "review_id", "user_id", "review_date", "review_title",
    "verified_purchase", "stars", "anomaly_score", "fraud_like_score",
    "review_length", "word_count", "useful", "funny", "cool",
    "is_extreme_rating", "rating_deviation_from_business_average",
    "rating_deviation_from_product_average", "reviewer_average_rating",
    "reviewer_review_count", "reviewer_extreme_rating_share",
    "reviewer_five_star_share", "reviewer_one_star_share", "uppercase_share",
    "repeated_character_flag", "avg_word_length", "no_space_ratio",
    "generic_praise_flag", "html_break_count", "text_formatting_anomaly_flag",
    "sentence_count", "avg_sentence_length", "sentence_length_variability",
    "first_person_flag", "concrete_detail_flag", "balanced_pros_cons_flag",
    "specific_experience_flag", "repeated_promotional_language_flag",
    "synthetic_templated_language_score", "synthetic_language_signal",
    "low_star_manipulation_signal", "near_duplicate_review_count",
    "very_short_five_star_signal", "high_rating_short_text_signal",
    "extreme_deviation_signal", "duplicate_text_signal", "burst_signal",
    "extreme_cluster_signal", "density_signal", "unverified_high_rating_signal",
    "reviewer_extreme_signal", "bot_text_signal", "complaint_only_discount",
    "fraud_signal_count", "review_text", "review_text_preview",
)
