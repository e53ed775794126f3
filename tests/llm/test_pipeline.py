"""Every stage of the pipeline against a brute-force version over its own input."""

import collections
import re

import pytest
import sentencepiece
from test_operators_llm import brute_contamination, brute_groups

import corpus_pipeline
from vigil.llm import line_quality, pieces, surrogates

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, doc string, removed string, kept int, grp int"
SENTENCE = " ".join(f"alpha{i} beta{i % 13} gamma{i * 7}" for i in range(40))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts = [None, "", "too short", SENTENCE, SENTENCE, SENTENCE.replace("alpha3 ", "other "), SENTENCE + " bob@mail.example.com",
             *[f"one line of many documents here\nown words of text {c} with a mail to user{c}.x@host{c}.org and +1 (017) 555-771{c % 10} now"
               for c in range(25)],
             *["\n".join(f"line {chr(97 + i)} of a copied page with some words" for i in range(6))] * 15,
             "the benchmark says that stone and river and cloud run over all of the land at night", "word " * 40]
    rows = [(i, t, "en", f"src{i % 2}" if i % 11 else None, len(t or ""), 1, "d", "r", 0, 9) for i, t in enumerate(texts)]
    rows += rows[8:10]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(path / "documents.parquet"))
    items = [(1, "stone and river and cloud run over all of the land"), (2, None), (3, "nowhere to be found in any of the documents at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def quality(rows):
    """doc_id and text of what stays: the rules of one text, then lines over the limit go; of depleted copies the first one stays whole."""
    def normal(line):
        return re.sub(r"[0-9\x09-\x0D ]+", " ", line).strip(" ").lower()
    judged = []
    for number, r in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        runs = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        again = {i + k for i in range(len(words) - 4) if runs[tuple(words[i:i + 5])] > 1 for k in range(5)}
        judged.append((len(words) < 10 or 100 * len(again) > 20 * len(words), r["doc_id"], number))
    holders = collections.defaultdict(set)
    for turn, r in zip(judged, rows):
        for line in (r["text"] or "").split("\n"):
            if normal(line):
                holders[r["source"] or "", normal(line)].add(turn)
    def chars(lines):
        return sum(len(normal(x)) for x in lines)
    def over(r):
        return [x for x in (r["text"] or "").split("\n") if len(holders[r["source"] or "", normal(x)]) > line_quality.LIMIT]
    depleted = {turn for turn, r in zip(judged, rows) if not turn[0] and 100 * (
        chars((r["text"] or "").split("\n")) - chars(over(r))) < line_quality.LEAST_SHARE * chars((r["text"] or "").split("\n"))}
    out = []
    for turn, r in zip(judged, rows):
        gone = over(r)
        first = [x for x in gone if turn == min(holders[r["source"] or "", normal(x)] & depleted, default=None)]
        if turn in depleted and 2 * chars(first) >= chars(gone):
            out.append((r["doc_id"], r["text"]))
        elif not turn[0] and turn not in depleted:
            out.append((r["doc_id"], "\n".join(x for x in (r["text"] or "").split("\n") if x not in gone)))
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        after[name] = (docs.collect(), stage(spark, docs, folder))
        docs = spark.createDataFrame(after[name][1].collect(), after[name][1].schema)
        assert name == "tokens" or docs.columns == columns

    before, found = after["quality"]
    # repeated rows are equal, so which of them counts first does not matter
    assert sorted((r["doc_id"], r["text"]) for r in found.collect()) == sorted(quality(before))
    assert all(r["n_chars"] == len(r["text"]) for r in found.collect())

    before, found = after["near_dedup"]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in before], size=5)
    kept = [r["doc_id"] for r in found.collect()]
    assert sorted(kept) == sorted({eval(g)[2] for g in groups}) and len(kept) < len(before)

    before, found = after["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [eval(r)[0] for r in brute_contamination([(r["doc_id"], r["text"]) for r in before], items) if not eval(r)[-1]]
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(clean) and len(clean) == len(before) - 1

    before, found = after["private"]
    new = {r["doc_id"]: r["text"] for r in found.collect()}
    assert len(new) == len(before)
    pattern = re.compile(surrogates.PATTERNS["email"].replace("++", "+") + "|" + r"\+1 \(\d{3}\) \d{3}-\d{4}")
    original = {m for r in before for m in pattern.findall(r["text"])}
    assert original and not original & {m for t in new.values() for m in pattern.findall(t)}
    assert all(pattern.sub("#", r["text"]) == pattern.sub("#", new[r["doc_id"]]) for r in before)

    before, found = after["tokens"]
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert sorted((r["doc_id"], r["ids"], r["n_pieces"]) for r in found.collect()) == sorted(
        (r["doc_id"], ids := model.encode(r["text"]), len(ids)) for r in before)


def test_no_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
