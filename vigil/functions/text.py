"""Per-review text features.

Measures over all characters come from Arrow batches, the formulas over them are SQL, one layer
at a time; the whole chain stays one map-only stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigil import fixed_values as fv
from vigil.functions import text_kernels as kernels
from vigil.functions.sql import at_least_one, capped, clip01, derive, flag, num, text, weighted_sum

WORD_FLAGS = {
    "generic_praise_flag": fv.GENERIC_PRAISE,
    "first_person_flag": fv.FIRST_PERSON,
    "concrete_detail_flag": fv.CONCRETE_DETAIL,
    "balanced_pros_cons_flag": fv.BALANCED,
    "specific_experience_flag": fv.EXPERIENCE,
    "repeated_promotional_language_flag": fv.PROMOTIONAL,
}


def without_breaks(value: str, instead: str) -> str:
    """Line-break tags replaced; text without any tag skips the regular expression."""
    return (f"CASE WHEN contains({value}, '<') THEN regexp_replace({value}, {text(fv.HTML_BREAK)}, {instead}) "
            f"ELSE {value} END")


def clean_text(value: str) -> str:
    """The text as it is measured and shown: NULL is empty, line-break tags are newlines."""
    return without_breaks(f"coalesce({value}, '')", r"'\n'")


def flat_text(value: str) -> str:
    """Runs of white space made one space, and none at the ends. Single spaces are not touched."""
    return f"trim(regexp_replace({value}, {text(fv.WHITESPACE_RUN)}, ' '))"


def comparison_text(value: str) -> str:
    """Case- and space-folded raw text: equal values are copies of one another."""
    return f"lower({flat_text(value)})"


def templated_score() -> str:
    return clip01(weighted_sum(fv.TEMPLATED_WEIGHTS, {
        "short_five_star": flag("stars = 5 AND word_count <= 12"),
        "lacks_detail": "1.0D - concrete_detail_flag",
        "even_sentences": flag(f"sentence_count >= 2 AND sentence_length_variability <= {num(0.10)}"),
    }))


def with_text_features(reviews: DataFrame) -> DataFrame:
    """Text features of the columns ``text`` and ``stars``.

    What looks at every character is measured in Arrow batches (``text_kernels``); a measure that nobody asks for is not taken.
    """
    whole = derive(reviews, {"_raw": "coalesce(text, '')"})
    clean = derive(whole, {
        "clean_review_text": clean_text("text"),
        # tags are measured in units of the four characters of <br>
        "html_break_count": f"(length(_raw) - length({without_breaks('_raw', repr(''))})) / 4.0D",
    })
    measured = clean.withColumns({
        "word_count": kernels.words("clean_review_text"),
        "_sentences": kernels.sentences("clean_review_text"),
        "_capitals": kernels.capitals("clean_review_text"),
        "_repeats": kernels.repeats("clean_review_text"),
        "_blank_lines": kernels.blank_lines("clean_review_text"),
        **{f"_{name}": kernels.whole_words(entries)("clean_review_text") for name, entries in WORD_FLAGS.items()},
    })
    counted = derive(measured, {
        "review_length": "CAST(length(clean_review_text) AS DOUBLE)",
        "sentence_count": "_sentences.sentences",
    })
    flagged = derive(counted, {
        "avg_word_length": f"review_length / {at_least_one('word_count')}",
        "uppercase_share": f"_capitals.upper / {at_least_one('_capitals.letters')}",
        "repeated_character_flag": flag("_repeats"),
        **{name: flag(f"_{name}") for name in WORD_FLAGS},
    })
    shaped = derive(flagged, {
        "avg_sentence_length": f"word_count / {at_least_one('sentence_count')}",
        "no_space_ratio": capped("avg_word_length", 25.0),
        "text_formatting_anomaly_flag": flag(
            "html_break_count >= 4 OR (avg_word_length >= 18 AND review_length >= 60) OR _blank_lines"),
    })
    varied = derive(shaped, {
        "sentence_length_variability":
            f"CASE WHEN sentence_count < 2 THEN 0.0D ELSE least(sqrt(_sentences.squares / {at_least_one('sentence_count')}) "
            f"/ {at_least_one('avg_sentence_length')}, 1.0D) END",
    })
    scored = derive(varied, {"synthetic_templated_language_score": templated_score()})
    return scored.drop("_raw", "_sentences", "_capitals", "_repeats", "_blank_lines", *[f"_{name}" for name in WORD_FLAGS])
