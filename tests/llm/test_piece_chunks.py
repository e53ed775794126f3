"""Pieces encoded a few characters at a time."""

from __future__ import annotations

import corpus_pipeline
from vigil.llm import pieces


def test_smaller_chunks_give_the_same_ids(spark):
    texts = ["", None, "one  two three " * 40, "\u4e2d\u6587 text\nwith lines " * 9, "x" * 300, "   ", "a b", "last one\n\n"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    whole = {r["doc_id"]: r["ids"] for r in pieces.encoded(docs).collect()}
    for chunk in (16, 100, 1 << 18):
        assert {r["doc_id"]: r["ids"] for r in pieces.encoded(docs, chunk=chunk).collect()} == whole


def test_tokens_stage_encodes_less_at_once(spark, monkeypatch):
    seen, plain = [], pieces.encoded
    monkeypatch.setattr(pieces, "encoded", lambda *a, **k: seen.append(k.get("chunk", pieces.CHUNK)) or plain(*a, **k))
    docs = spark.createDataFrame([(1, "some text", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.tokens(spark, docs, "").first()["n_pieces"] > 0
    assert seen[0] <= pieces.CHUNK // 4
