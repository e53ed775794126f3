"""Operators 11 to 13: edge rows, equality with SQL, brute-force versions and round trips."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators_llm import docs, none, same_as_sql  # noqa: F401  (fixtures)
from tokenizers import Tokenizer

from vigil.llm import hard_negatives, manifest, queries, token_files

# 11 manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """{(doc_id, leaf): sorted results} by plain trees, for rows whose ids are unique in their language."""
    def leaf(r, more=0):
        values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            out.append((i % 2, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
            i //= 2
        return out
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, own = {}, {}
    for lang in langs:
        own[lang] = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in own[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(own[lang]):
            steps = path(trees[lang], i) + path(top, k)
            h = leaf(r, int(r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0))
            for side, sibling in steps:
                h = H(h) if sibling is None else H(sibling, h) if side else H(h, sibling)
            out.append((r["doc_id"], leaf(r), trees[lang][-1][0], top[-1][0], H(*[s for _, s in steps if s]), h, h == top[-1][0]))
    return sorted(out, key=repr)


def test_manifest(spark, docs, none):  # noqa: F811
    shown = same_as_sql(manifest.manifest(docs), manifest.ORACLE, documents=docs)
    assert len(shown) == docs.count() and not shown["verified"].all()
    assert manifest.manifest(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_small_trees(spark, monkeypatch, n):
    """Few levels in a bucket, so that proofs pass several; languages of one leaf, null and non-ASCII ones."""
    monkeypatch.setattr(manifest, "LEVELS", 2)
    langs = ["en"] * n + [None, None, "ñ", "Z", ""]
    rows = [(i * 3, f"text {i}" if i % 4 else None, lang, None, None if i % 5 == 1 else i, "x", 1, "k", "l", 2, 3)
            for i, lang in enumerate(langs)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, row string, tree int, leaf string, part string, "
              "lo int, id int")
    df = spark.createDataFrame(rows, schema).repartition(4)
    found = sorted(map(tuple, manifest.manifest(df).collect()), key=repr)
    assert found == brute_manifest([r.asDict() for r in df.collect()])
    single = manifest.manifest(df.where("doc_id = 0")).collect()
    assert len(single) == 1 and single[0]["leaf"] == single[0]["subroot"] == single[0]["root"] and single[0]["proof_sha256"] == H()


def test_one_language_and_one_id_over_all_ranges(spark):
    """A third of the rows are one document; ranks stay consecutive, and each copy has a proof that verifies."""
    rows = [(7 if i % 3 == 0 else i, "same text" if i % 3 == 0 else f"text {i}", "en", "s", None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    found = manifest.manifest(df).collect()
    assert sorted(map(tuple, found), key=repr) == brute_manifest([r.asDict() for r in df.collect()])
    ranks = manifest.ranked(manifest.leaves(df), ["id", "leaf", "row"]).select("lo", "n").collect()
    assert sorted(r["lo"] for r in ranks) == list(range(3000)) and {r["n"] for r in ranks} == {3000}


# 12 hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, row int, q string, ab int, cap string, score int"


def vectors(n=260, d=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=d)], int(rng.integers(0, 4))) for i in range(n)]
    rows += [(1000, rows[0][1], 2), (1000, rows[0][1], 1), (None, rows[0][1], rows[0][2]), (300, None, 1), (301, [1.0, None], 1), (400, [], 3),
             (302, [float("nan")] * d, 1), (303, [float("inf")] * d, 1), (500, [1.0, 2.0], None), (600, [0.5] * (d + 2), 1), (700, [0.0] * d, 9)]
    rows += [(2000 + i, rows[100][1], i % 2) for i in range(120)] + rows[100:103]  # one very common vector, repeated rows
    return [(*r, 1, "q", 2, "c", 3) for r in rows]


def test_hard_negatives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    monkeypatch.setattr(hard_negatives, "ROWS", 256)
    df = spark.createDataFrame(vectors(), VECTORS)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    shown = same_as_sql(queries.op12_hard_negatives(spark, str(tmp_path)), hard_negatives.ORACLE, embeddings=df.select("vec_id", "embedding", "label"))
    assert len(shown) and shown["rank"].max() == 5
    empty = spark.createDataFrame([], VECTORS)
    empty.write.parquet(str(tmp_path / "none/embeddings.parquet"))
    assert queries.op12_hard_negatives(spark, str(tmp_path / "none")).count() == 0


def test_large_components_count_exactly(spark):
    """Scores beyond 2^53 are exact; what may not fit 64 bits takes no part."""
    big = [(100, [2.0**21, 1.0], 1), (1, [2.0**20, 3.0], 1), (2, [2.0**20 - 0.125, 3.0], 2), (3, [2.0**20, 2.5], 2), (4, [2.0**30, 1.0], 2)]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    found = hard_negatives.hard_negatives(hard_negatives.prepared(df), "vec_id % 100 = 0").collect()
    scores = {i: sum(int(256 * a // 1) * int(256 * b // 1) for a, b in zip(big[0][1], v)) for i, v, _ in big}
    assert [(r["negative_id"], r["negative_score"], r["positive_score"]) for r in sorted(found)] == [
        (3, scores[3], scores[1]), (2, scores[2], scores[1])] and scores[1] > 2**53


def test_bounds_leave_out_no_row_and_save_work():
    """In tight clusters few rows are scored; every row in a window is among them, with its exact score."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16)) * 300
    points = np.floor(centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 16)) * 4).astype(int)
    table = pa.table({"row": np.arange(900), "vec_id": np.arange(900), "label": np.zeros(900, dtype=int), "q": [list(map(int, p)) for p in points]})
    anchors, rows = hard_negatives.Block(table.slice(0, 144)), hard_negatives.Block(table)
    anchors.fit(rows)
    exact = anchors.matrix @ rows.matrix.T
    low = np.sort(exact, axis=1)[:, -40]
    high = np.sort(exact, axis=1)[:, -5]
    scored = 0
    for a, places, scores in hard_negatives.met(hard_negatives.spanning_tree(anchors.matrix), anchors, rows, slice(0, 900), low, high):
        assert (scores == exact[a, places]).all()
        assert set(np.flatnonzero((exact[a] >= low[a]) & (exact[a] <= high[a]))) <= set(places.tolist())
        scored += len(places)
    assert scored < exact.size / 3


# 13 token files

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1200), st.integers(0, 1300), st.integers(0, 1300),
       st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_payloads_come_back(ids, a, b, share):
    ids = np.array(ids, dtype=np.uint32)
    payload = token_files.packed(ids, share)
    assert token_files.unpacked(payload).tolist() == ids.tolist()
    assert token_files.unpacked(payload, min(a, b), max(a, b)).tolist() == ids[min(a, b):max(a, b)].tolist()


def test_outliers_are_patched():
    ids = np.full(1024, 9, dtype=np.uint32)
    ids[::100] = 40_000
    assert len(token_files.packed(ids)) < 200 and (token_files.unpacked(token_files.packed(ids)) == ids).all()
    with pytest.raises(ValueError):
        token_files.unpacked(b"XXXX" + token_files.packed(ids)[4:])


AWKWARD = [0x20, 0x0A, 0x09, 0x1C, 0x85, 0xA0, 0x301, 0x300, 0x3A3, 0x130, 0x41, 0x61, 0x4B, 0x212A, 0x27, 0x73, 0x1100, 0x1161, 0x11A8, 0x3C,
           0x7C, 0x2E, 0x2C, 0x31, 0x661, 0x65E5, 0x2028, 0x1F600]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(11)
    vocabulary = token_files.vocabulary_text()
    library, encoder = Tokenizer.from_str(vocabulary), token_files.Encoder(vocabulary)
    texts = ["".join(map(chr, rng.choice(AWKWARD, rng.integers(0, 90)))) for _ in range(400)]
    texts += ["a<|endoftext|>b <|ENDOFTEXT|>. it's <|startoftext|>", None, "", " \n", "z" * 20_000, "w. W, x.́ y" * 3000]
    for known, step in ((1 << 19, 500), (50, 7)):  # also with little remembered
        monkeypatch.setattr(token_files, "KNOWN_WORDS", known)
        for k in range(0, len(texts), step):
            ids, lengths = encoder.encoded(pa.array(texts[k:k + step], pa.string()), 2)
            ends = np.cumsum(lengths)
            for t, a, b in zip(texts[k:k + step], ends - lengths, ends, strict=True):
                assert ids[a:b].tolist() == [*library.encode(t or "", add_special_tokens=False).ids, 2]


def brute_tokens(rows):
    library, start, out = Tokenizer.from_str(token_files.vocabulary_text()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, docs, none, tmp_path):  # noqa: F811
    token_files.write_token_files(docs, str(tmp_path / "ids"), size=500)
    files = token_files.token_files(spark, str(tmp_path / "ids"))
    found = sorted(map(tuple, token_files.digests(files).collect()), key=lambda r: r[1])
    assert found == brute_tokens([(r["doc_id"], r["text"]) for r in docs.collect()])
    whole = [i for r in token_files.documents(files).orderBy("start").collect() for i in r["ids"]]
    assert len(whole) == sum(r[2] for r in found) and files.count() > 5
    for a, b in ((0, 1), (490, 1700), (len(whole) - 3, len(whole) + 9), (5, 5)):
        assert [r["id"] for r in token_files.ids_between(files, a, b).orderBy("position").collect()] == whole[a:b]
    token_files.write_token_files(none, str(tmp_path / "none"))
    assert token_files.digests(token_files.token_files(spark, str(tmp_path / "none"))).count() == 0


def test_one_id_in_a_third_of_the_rows(spark, tmp_path):
    rows = [(None if i % 3 == 0 else 5000 - i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), str(tmp_path / "ids"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "ids"))
    found = token_files.digests(token_files.token_files(spark, str(tmp_path / "ids"))).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == brute_tokens(rows)
    assert files.where("doc_ids[0] IS NULL").select("part").distinct().count() > 1


def test_encoders_are_handed_on_whole():
    """Every task read the vocabulary and asked the library for all its words again."""
    vocabulary = token_files.vocabulary_text()
    token_files._handed_on(b"another vocabulary", None)
    key, encoder = token_files._taken(vocabulary)
    assert isinstance(encoder, token_files.Encoder)
    texts = pa.array(["some words, some <|endoftext|> signs", None, "more words"])
    first = [a.tolist() for a in encoder.encoded(texts, 2)]
    token_files._handed_on(key, encoder)
    _, again = token_files._taken(vocabulary)
    assert again is encoder and "words" in again.numbers and [a.tolist() for a in again.encoded(texts, 2)] == first
    assert token_files._taken(vocabulary)[1] is not encoder  # taken and not handed back, as by a task that breaks off
