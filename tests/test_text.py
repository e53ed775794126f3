import pytest

from vigil.functions.text import with_text_features


def features(spark, *texts):
    df = spark.createDataFrame([(i, t, 5.0) for i, t in enumerate(texts)], "id int, text string, stars double")
    return [r.asDict() for r in with_text_features(df).orderBy("id").collect()]


def test_breaks_are_measured_in_characters(spark):
    row, = features(spark, "a<br />b<BR>c")
    assert row["html_break_count"] == 2.5
    assert row["word_count"] == 3
    assert row["clean_review_text"] == "a\nb\nc"


def test_sentences_split_at_pipes_too(spark):
    row, = features(spark, "x | y. z")
    assert (row["word_count"], row["sentence_count"]) == (4, 3)


def test_empty_and_punctuation_only(spark):
    empty, blank, dots, missing = features(spark, "", "   ", " . ", None)
    for row in (empty, blank, missing):
        assert row["word_count"] == 0 and row["sentence_count"] == 0
    assert dots["sentence_count"] == 1


def test_repeated_characters(spark):
    yes, no, lines = features(spark, "soooooo good", "soooo good", "a\n\n\n\n\n\nb")
    assert (yes["repeated_character_flag"], no["repeated_character_flag"], lines["repeated_character_flag"]) == (1, 0, 0)
    assert lines["text_formatting_anomaly_flag"] == 1


def test_vertical_tab_is_white_space(spark):
    row, = features(spark, "one\x0btwo  three four")
    assert row["word_count"] == 3


@pytest.mark.parametrize("text,flag,expected", [
    ("A GREAT   product!", "generic_praise_flag", 1),
    ("great, product", "generic_praise_flag", 0),
    ("imperfect", "generic_praise_flag", 0),
    ("perfect.", "generic_praise_flag", 1),
    ("été my", "first_person_flag", 1),
    ("theme mymy", "first_person_flag", 0),
    ("émyé", "first_person_flag", 1),
    ("laundry", "concrete_detail_flag", 0),
    ("so dry!", "concrete_detail_flag", 1),
    ("for my cat", "specific_experience_flag", 1),
    ("for mystery", "specific_experience_flag", 0),
    ("buy it_", "repeated_promotional_language_flag", 0),
    ("buy it", "repeated_promotional_language_flag", 1),
    ("tribute", "balanced_pros_cons_flag", 0),
])
def test_whole_words(spark, text, flag, expected):
    row, = features(spark, text)
    assert row[flag] == expected


def test_capitals_are_ascii(spark):
    row, = features(spark, "ABcd éÉ 12")
    assert row["uppercase_share"] == 0.5


def test_templated_score_is_bounded_and_additive(spark):
    praise, detail = features(
        spark, "Great product! Love it", "I used this cream for two weeks, but my skin is dry. It arrived late.")
    # praise, short five-star, no detail, and two even sentences, plus the share of missing spaces
    assert praise["synthetic_templated_language_score"] == pytest.approx(0.20 + 0.15 + 0.15 + 0.10 + 0.05 * 22 / 4 / 25)
    assert detail["synthetic_templated_language_score"] == 0


def test_variability_of_sentence_lengths(spark):
    row, = features(spark, "one two three. four.")
    assert row["avg_sentence_length"] == 2
    assert row["sentence_length_variability"] == pytest.approx(0.5)
