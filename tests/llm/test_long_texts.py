"""Texts of 10^5 repetitions of what an operator looks at, and rows that many verdicts fall on."""

import time

import pytest

import corpus_pipeline
from vigil.llm import licenses, line_quality, surrogates
from vigil.llm.rows import beside, numbered

N = 100_000
REPEATED = {
    "labels": "mail x@a" + ".bc" * N + " end", "mailbox": "a." * N + "b@mail.example.com", "ats": "a@" * N, "dots": "." * N,
    "groups": "2001" + ":db8" * N + " and ::1", "octets": "1." * N, "titles": "Dr " * N + "Anna", "letters": "Frau A" + "b" * N,
    "hyphens": "Frau A" + "-b" * N, "digits": "+49 " + "1 " * N, "iban": "DE89" + " 3704" * N, "capitals": "Frau Anna Schmidt " + "Anna " * 3000,
}


def test_surrogates_in_long_texts(spark):
    df = spark.createDataFrame(list(enumerate(REPEATED.values())), "doc_id long, text string").repartition(8)
    found = {r["doc"]["doc_id"]: r["text"] for r in surrogates.pseudonymised(df, "key").collect()}
    new = dict(zip(REPEATED, [found[k] for k in range(len(REPEATED))]))
    assert new["labels"].startswith("mail ") and new["labels"].endswith(".example end") and len(new["labels"]) < 100
    assert new["mailbox"].endswith(".example") and "b@mail.example.com" not in new["mailbox"]
    assert new["ats"] == REPEATED["ats"] and new["octets"] == REPEATED["octets"] and "Anna" not in new["capitals"]


def test_many_short_lines(spark):
    """A text of 10^5 lines, a tenth of them shared, loses just these, in a time that grows with the lines."""
    own = [f"l{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)} x" for k in range(N)]
    shared = [own[k] for k in range(0, N, 10)]
    rows = [(i, "\n".join(shared) + f"\nown words of text number {chr(97 + i)} stand here with some others " * 9, "s") for i in range(12)]
    rows.append((99, "\n".join(own), "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    began = time.time()
    found = {r["doc_id"]: r for r in line_quality.line_quality(df).collect()}
    assert sorted(found[99]["removed"]) == list(range(0, N, 10)) and found[99]["kept"]
    marked = spark.createDataFrame([(rows[-1][1], found[99]["removed"])], "t string, r array<int>")
    shown = line_quality.without_lines(marked, "t", "r").first()["shown"]
    assert shown == "\n".join(x for k, x in enumerate(own) if k % 10)
    assert time.time() - began < 120


def test_a_line_of_a_third_of_all_documents(spark, monkeypatch):
    """One line in a third of the rows: attached by a broadcast and by shares alike."""
    rows = [(i, f"the same line of words\nown text {chr(97 + i % 26)}{chr(97 + i // 26)} with ten or more words in it for good" if i % 3 else
             f"quite other text {chr(97 + i % 26)}{chr(97 + i // 26)} with ten or more words in it for good", "s") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    plain = sorted(map(tuple, line_quality.line_quality(df).drop("row").collect()))
    assert sum(r[8] > 0 for r in plain) == 400 and all(r[-1] for r in plain)
    monkeypatch.setattr(line_quality.attach_by_key, "__defaults__", (False, 50, 0))
    assert sorted(map(tuple, line_quality.line_quality(df).drop("row").collect())) == plain


@pytest.mark.parametrize("ids", [1000, 0])
def test_verdicts_beside_rows(spark, tmp_path, ids):
    """Numbers of a table as read are unique and stay; few changes are broadcast, more pass a filter."""
    frame = spark.range(2000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS row", "id % 7 AS _metadata").repartition(5)
    frame.write.parquet(str(tmp_path / "t"))
    rows = numbered(spark.read.parquet(str(tmp_path / "t")))
    assert rows.select("row").distinct().count() == 2000
    again = numbered(spark.read.parquet(str(tmp_path / "t")).where("doc_id >= 0"))  # not a table as read: a copy
    assert again.select("row").distinct().count() == 2000 and again.select("doc.*").columns == ["doc_id", "row", "_metadata"]
    changes = rows.where("doc.doc_id % 10 = 3").selectExpr("row", "doc.doc_id AS seen", "array(1) AS list")
    found = beside(rows, changes, ids=ids).select("doc.doc_id", "seen", "list").collect()
    assert sorted((r["doc_id"], r["seen"], r["list"]) for r in found) == [(i, i, [1]) if i % 10 == 3 else (i, None, None) for i in range(2000)]
    assert beside(rows, changes.limit(0), ids=ids).count() == 2000


def test_stages_leave_only_their_verdicts(spark, tmp_path):
    """What an operator writes on its way is gone once its stage is returned."""
    import os

    from vigil.session import shared_folder
    rows = [(i, f"text number {i} with " + " ".join(f"w{i * k % 97}" for k in range(30)), "en", "s", 5) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "nowhere to be found")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, folder = spark.read.parquet(str(tmp_path / "documents.parquet")), shared_folder(spark)
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = set(os.listdir(folder))
        assert stage(spark, docs, str(tmp_path)).count()
        assert len(set(os.listdir(folder)) - before) == 2, name  # numbers of the files, and the verdicts
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, str(tmp_path)).count()
    assert [f for f in set(os.listdir(folder)) - before if not f.startswith("tokens-")] == []


def test_many_notice_words(spark):
    """20,000 notice words in one text are looked at one by one; windows are those of a plain loop."""
    headers = spark.createDataFrame([("A", "licensed under the apache license version 2 of all rights"), ("B", "permission is granted free of charge")],
                                    "license string, text string").selectExpr("xxhash64(license) AS passage", "license", f"{licenses.parts('text')} AS parts")
    rows = [(1, "license of version 2 " * 20_000), (2, "x the apache license version 2 of all rights reserved"), (3, None), (4, "permission is"), (5, "")]
    scanned = spark.createDataFrame(rows, "row long, text string").selectExpr("row", f"{licenses.parts('text')} AS parts")
    began = time.time()
    found = {tuple(r) for r in licenses._windows(scanned, headers).collect()}
    assert time.time() - began < 60
    expected = set()
    for row, parts in scanned.collect():
        for passage, own in [(h["passage"], h["parts"]) for h in headers.collect()]:
            for i, word in enumerate(parts or []):
                for at, term in enumerate(own):
                    if word == term and any(a in word for a in licenses.ANCHOR.split("|")):
                        words = parts[max(i - at, 0):i - at + len(own)]
                        if {t for t in own if any(c.isdigit() for c in t)} <= set(words):
                            expected.add((row, passage, " ".join(sorted(words))))
    assert found == expected and len(found) > 3
