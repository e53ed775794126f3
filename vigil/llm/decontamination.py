"""Benchmark passages inside documents: a prefix-filtered set join over item windows, every hit verified on the words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.words import ALPHANUMERIC, Words, mixed, row_groups
from vigil.session import written_table

WINDOW = 10      # words of an item window
TOKEN = 3        # words of the shingles that are ordered by rarity; a shorter window is one token
FILTER_BITS = 22  # the filter that travels to the tasks has 2^FILTER_BITS flags, whatever the tables hold
BROADCAST_WINDOWS = 100_000


def token_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = mixed(out + hashes[k:len(hashes) - size + 1 + k])
    return out


def _item_tokens(window: int, size: int):
    """Per item: its windows as texts, with the tokens of each and their places in it."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        words = Words(ALPHANUMERIC)
        for batch in batches:
            rows = []
            data, starts, ends, hashes, offsets = words.of_texts(batch.column("text"))
            for k, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = int(offsets[k]), int(offsets[k + 1])
                spelled = [words.lower[data[s:e]].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])]
                length = min(window, b - a)
                for first in range(b - a - length + 1 if length else 0):
                    run_length = min(size, length)
                    tokens = token_hashes(hashes[a + first:a + first + length], run_length).view(np.int64).tolist()
                    rows.append((item, " ".join(spelled[first:first + length]), length, run_length, tokens))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int32(),
                                                          pa.list_(pa.int64())), strict=True)],
                names=["item_id", "words", "length", "size", "tokens"])
    return run


def _probed(flags, sizes: list[int], window: int, count_only: bool):
    """Per document: its number of words and the places whose token passes the filter, with the words around them."""
    packed, shift = flags

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        words = Words(ALPHANUMERIC)
        table = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).view(bool)
        around = pa.struct([("token", pa.int64()), ("place", pa.int64()), ("from", pa.int64()), ("near", pa.string())])
        for batch in batches:
            for first, last in row_groups(batch.column("text")):
                part = batch.slice(first, last - first)
                data, starts, ends, hashes, offsets = words.of_texts(part.column("text"))
                where, tokens = [], []
                for size in sizes:
                    found = token_hashes(hashes, size)
                    at = np.flatnonzero(table[(found >> np.uint64(shift)).astype(np.int64)])
                    inside = np.searchsorted(offsets, at, side="right") == np.searchsorted(
                        offsets, at + size - 1, side="right")  # a token of two texts is none
                    where.append(at[inside])
                    tokens.append(found[at[inside]])
                where, tokens = np.concatenate(where), np.concatenate(tokens)
                if count_only:
                    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], names=["token"])
                    continue
                order = np.argsort(where, kind="stable")
                where, tokens = where[order], tokens[order]
                text_of = np.searchsorted(offsets, where, side="right") - 1
                low = np.maximum(where - window + 1, offsets[text_of])
                high = np.minimum(where + window, offsets[text_of + 1])
                near = [" ".join(words.lower[data[s:e]].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b]))
                        for a, b in zip(low, high)]
                items = pa.StructArray.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(where - offsets[text_of]),
                     pa.array(low - offsets[text_of]), pa.array(near, pa.string())], fields=list(around))
                cuts = np.searchsorted(text_of, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), items)],
                    names=["row", "doc_id", "n_words", "probes"])
    return run


def _flags(tokens: DataFrame, bits: int):
    """The filter: one flag for each leading ``bits`` bits of a token; at most 2^bits short rows reach the driver."""
    shift = 64 - bits
    places = tokens.select(F.expr(f"shiftrightunsigned(token, {shift})").alias("p")).distinct().toPandas()["p"]
    flags = np.zeros(1 << bits, dtype=bool)
    flags[places.to_numpy(dtype=np.int64)] = True
    return np.packbits(flags).tobytes(), shift


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", row: str | None = None,
                  window: int = WINDOW, token: int = TOKEN, bits: int = FILTER_BITS) -> DataFrame:
    """Which windows of which items stand in which documents.

    One row per input row: row, doc_id, n_words, n_hit (words inside an occurring
    window), item_ids (items with an occurring window, sorted as strings). A window is
    ``window`` consecutive words of an item; an item with fewer words, but not
    none, is one window. A-Z are lower-cased, words are runs of letters, digits and
    characters outside ASCII. A null text has no words; a null item id counts as
    no item but its words are hit. Empty tables give no rows or no hits; repeated rows are rows of
    their own; other columns are not looked at.

    A document with all words of a window must hold each of its tokens (runs of
    ``token`` words), so it is enough to look for one: the window's rarest, by count
    over all documents. Places where a rarest token stands are joined to the
    windows, checked for room before and after, and then compared word by word.
    """
    spark = docs.sparkSession
    number = F.col(row) if row else F.monotonically_increasing_id()
    source = docs.select(number.cast("bigint").alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"),
                         F.col(text).cast("string").alias("text"))
    cut = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    windows = written_table(spark, cut.mapInArrow(
        _item_tokens(window, token), "item_id long, words string, length int, size int, tokens array<long>"), "windows")
    distinct = windows.select("words", "length", "size", "tokens").distinct()
    sizes = sorted(r["size"] for r in windows.select("size").distinct().toLocalIterator()) or [token]
    placed = written_table(spark, distinct.select(
        "words", "length", "size", F.posexplode("tokens").alias("place", "token")), "placed")
    every = _flags(placed.select("token"), bits)
    counted = source.select("text").mapInArrow(
        _probed(every, sizes, window, True), "token long").groupBy("token").count()
    rare = placed.join(counted, "token", "left").selectExpr(
        "words", "length", "token", "place", "coalesce(count, 0L) AS rarity").groupBy("words", "length").agg(
        F.expr("min(struct(rarity, token, place))").alias("first")).selectExpr(
        "words", "length", "first.token", "first.place AS offset", "first.rarity")
    needed = written_table(spark, rare.where("rarity > 0").drop("rarity"), "needed")
    probes = written_table(spark, source.mapInArrow(
        _probed(_flags(needed.select("token"), bits), sizes, window, False),
        "row long, doc_id long, n_words long, "
        "probes array<struct<token: long, place: long, from: long, near: string>>"), "probes")
    if needed.count() <= BROADCAST_WINDOWS:  # a window has ten words: some 20 MB; beyond, both sides are shuffled
        needed = F.broadcast(needed)
    places = probes.select("row", "n_words", F.explode("probes").alias("p")).selectExpr("row", "n_words", "p.*")
    hits = written_table(spark, places.join(needed, "token").where(
        "place >= offset AND place - offset + length <= n_words").where(
        "array_join(slice(split(near, ' '), CAST(place - offset - from AS INT) + 1, length), ' ') = words").selectExpr(
        "row", "place - offset AS start", "length", "words").distinct(), "hits")
    # each start once with its longest window: at most one entry per word of the text
    spans = hits.groupBy("row", "start").agg(F.max("length").alias("length")).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("s"))
    covered = spans.selectExpr("row", """aggregate(s, named_struct('n', 0L, 'upto', 0L), (a, x) -> named_struct(
        'n', a.n + greatest(0L, x.end - greatest(a.upto, x.start)), 'upto', greatest(a.upto, x.end)), a -> a.n) AS n_hit
        """)
    found = hits.select("row", "words").distinct().join(
        windows.select("words", "item_id").distinct(), "words").groupBy("row").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    return probes.select("row", "doc_id", "n_words").join(covered, "row", "left").join(found, "row", "left").selectExpr(
        "row", "doc_id", "n_words", "coalesce(n_hit, 0L) AS n_hit", "coalesce(item_ids, array()) AS item_ids")


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the query."""
    return found.selectExpr(
        "doc_id", "n_words", "n_hit", "CAST(size(item_ids) AS BIGINT) AS n_items",
        "sha2(array_join(item_ids, ','), 256) AS items_sha256", "n_hit > 0 AS contaminated")


_NEXT = ", ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, WINDOW)]])
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS r, item_id, regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT r, item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM b),
bl AS (SELECT item_id, n, i, list_filter([{_NEXT}], lambda x: x IS NOT NULL) AS l FROM bw WINDOW o AS (PARTITION BY r ORDER BY i)),
windows AS (SELECT DISTINCT item_id, array_to_string(l, ' ') AS words, len(l) AS length FROM bl WHERE len(l) = least(n, 10)),
dw AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
dl AS (SELECT row, i, list_filter([{_NEXT}], lambda x: x IS NOT NULL) AS l FROM dw WINDOW o AS (PARTITION BY row ORDER BY i)),
k AS MATERIALIZED (SELECT row, i, length, array_to_string(l[1:length], ' ') AS words
      FROM dl JOIN (SELECT DISTINCT length FROM windows) ON len(l) >= length),
h AS (SELECT row, i, item_id, k.length FROM k JOIN windows ON k.words = windows.words),
c AS (SELECT row, count(DISTINCT i + k) AS n_hit FROM h JOIN (SELECT unnest(range(0, 10)) AS k) ON k < length GROUP BY row),
t AS (SELECT row, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT row, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN t USING (row)
"""
