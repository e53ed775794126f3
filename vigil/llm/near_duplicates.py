"""Near duplicates by tensored MinHash banding, every link confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.components import components
from vigil.llm.rows import beside, numbered
from vigil.llm.words import NOT_SPACE, Words, mixed, powers, row_groups, shingles
from vigil.session import written_table

SIZE = 4          # words in a shingle
PERCENT = 80      # similarity of a link, in hundredths
TABLES = 16       # keys in each of the two collections: TABLES squared tables in all
ROWS = 3          # minhashes in a half key: a table key holds twice as many
BLOCK_ROWS, BLOCK_SHINGLES = 400, 400_000  # rows and shingles that a task compares with as many at once


def distinct_shingles(texts, size: int, words: Words):
    """(distinct shingle hashes, sorted within each text; offsets by text) of an Arrow string array."""
    _, _, _, hashes, offsets = words.of_texts(texts)
    found, cuts = shingles(hashes, offsets, size)
    sets = [np.unique(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    lengths = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate(sets) if sets else found, np.concatenate([[0], np.cumsum(lengths)])


def half_keys(found: np.ndarray, starts: np.ndarray, tables: int, rows: int) -> np.ndarray:
    """Keys of both collections for each set, as a matrix of 2 * tables columns; the lowest bit tells the collection.

    ``2 * tables * rows`` minhashes serve ``tables`` squared tables of ``2 * rows`` minhashes each.
    """
    n = 2 * tables * rows
    factors = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    shifts = mixed(np.arange(n + 1, 2 * n + 1, dtype=np.uint64))
    weights = powers(0xA24BAED4963EE407, rows)
    keys = np.empty((len(starts), 2 * tables), dtype=np.uint64)
    work = np.empty_like(found)
    for t in range(2 * tables):
        key = np.full(len(starts), t + 1, dtype=np.uint64)
        for r in range(rows):
            f = t * rows + r
            np.multiply(found, factors[f], out=work)
            np.add(work, shifts[f], out=work)
            key += np.minimum.reduceat(work, starts) * weights[r]
        keys[:, t] = mixed(key) & ~np.uint64(1) | np.uint64(t >= tables)
    return keys


def _sketched(size: int, tables: int, rows: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        words = Words(NOT_SPACE)
        for batch in batches:
            for first, last in row_groups(batch.column("text")):
                part = batch.slice(first, last - first)
                found, cuts = distinct_shingles(part.column("text"), size, words)
                counts = np.diff(cuts)
                full = np.flatnonzero(counts)
                d1, d2 = np.zeros(len(counts), dtype=np.uint64), np.zeros(len(counts), dtype=np.uint64)
                keys = np.zeros((0, 2 * tables), dtype=np.uint64)
                if len(full):
                    starts = cuts[full]
                    d1[full] = np.add.reduceat(mixed(found ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    d2[full] = np.bitwise_xor.reduceat(mixed(found + np.uint64(0x14057B7EF767814F)), starts)
                    keys = half_keys(found, starts, tables, rows)
                lengths = np.where(counts > 0, 2 * tables, 0)
                halves = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                    pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(counts), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), halves],
                    names=["row", "doc_id", "n", "d1", "d2", "halves"])
    return run


def _full_sets(size: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        words = Words(NOT_SPACE)
        for batch in batches:
            for first, last in row_groups(batch.column("text")):
                part = batch.slice(first, last - first)
                found, cuts = distinct_shingles(part.column("text"), size, words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("c"), pa.array(np.diff(cuts)),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(found.view(np.int64)))],
                    names=["c", "n", "shingles"])
    return run


def _buckets(reps: DataFrame) -> DataFrame:
    """(key, c) of all tables in which a class meets another one.

    A table key pairs one key of each collection, so only classes that share
    keys of both with someone are expanded to pairs at all.
    """
    halves = reps.select("c", F.explode("halves").alias("h"))
    shared = halves.groupBy("h").count().where("count > 1").select("h")
    mine = halves.join(shared, "h", "left_semi").groupBy("c").agg(F.collect_list("h").alias("hs"))
    pairs = mine.select("c", F.explode(F.expr("filter(hs, h -> h & 1 = 0)")).alias("a"),
                        F.expr("filter(hs, h -> h & 1 = 1)").alias("bs"))
    keyed = pairs.select("c", "a", F.explode("bs").alias("b")).selectExpr("xxhash64(a, b) AS key", "c")
    keys = keyed.groupBy("key").count().where("count > 1").select("key")
    return keyed.join(keys, "key", "left_semi")


def _unshared(sets: DataFrame, members: DataFrame) -> DataFrame:
    """(c, n, most): ``most`` shingles of a member stand in some other member's set as well.

    A link needs that many in common, so this bounds every similarity from above.
    """
    own = sets.join(members, "c", "left_semi")
    single = (own.select("c", F.explode("shingles").alias("s")).groupBy("s")
              .agg(F.count("*").alias("k"), F.min("c").alias("c")).where("k = 1")
              .groupBy("c").agg(F.count("*").alias("alone")))
    return own.select("c", "n").join(single, "c", "left").selectExpr("c", "n", "n - coalesce(alone, 0L) AS most")


def _linkable(members: DataFrame, percent: int) -> DataFrame:
    """Rows (key, c, n, most, label) of buckets with several components that can still link with some row there.

    A link of x and y needs (100 + percent) * most >= percent * (n of x + n of y) for either's ``most``: so
    x bounds the size of its partner, and the partner bounds the size of x.
    """
    rows = members.withColumn("widest", F.expr(f"{100 + percent} * most / {percent} - n"))
    keys = rows.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("n").alias("least"),
                                   F.max("widest").alias("reach")).where("a <> b").drop("a", "b")
    return rows.join(keys, "key").where("widest >= least AND reach >= n").select("key", "c", "n", "most", "label")


def _round(spark, buckets: DataFrame, sets: DataFrame, links: DataFrame | None, pivots: int, percent: int):
    """(links, members): a few pivots of each bucket compared with all its members of another component.

    Pivots are the members that share most of their set. They then leave their bucket, and
    what returns as members are the rows (key, c, n, most, label) that may still have a link.
    """
    members = written_table(spark, _open_members(buckets, sets, links, percent), "members")
    leading = members.withColumn("place", F.expr(
        "row_number() OVER (PARTITION BY key ORDER BY most / n DESC, c)")).where(f"place <= {pivots}").selectExpr(
        "key", "c AS p", "n AS pn", "most AS pmost", "label AS plabel")
    leading = written_table(spark, leading, "pivots")
    pairs = members.join(leading, "key").where(
        f"label <> plabel AND {100 + percent} * least(most, pmost) >= {percent} * (n + pn)").selectExpr(
        "least(c, p) AS u", "greatest(c, p) AS v").distinct()
    left = sets.selectExpr("c AS u", "n AS un", "shingles AS us")
    right = sets.selectExpr("c AS v", "n AS vn", "shingles AS vs")
    found = pairs.join(left, "u").join(right, "v").selectExpr(
        "u", "v", "un + vn AS both", "CAST(size(array_intersect(us, vs)) AS BIGINT) AS common").where(
        f"100 * common >= {percent} * (both - common)").select("u", "v")
    links = written_table(spark, found if links is None else links.union(found), "links")
    return links, members.select("key", "c").join(leading.selectExpr("key", "p AS c"), ["key", "c"], "left_anti")


def _open_members(buckets: DataFrame, sets: DataFrame, links: DataFrame | None, percent: int) -> DataFrame:
    """Rows (key, c, n, most, label) of buckets that can still gain a link."""
    spark = buckets.sparkSession
    bounds = _unshared(sets, buckets.select("c").distinct()).where(f"100 * most >= {percent} * n")
    if links is None:
        members = buckets.join(bounds, "c").selectExpr("key", "c", "n", "most", "c AS label")
    else:
        members = buckets.join(bounds, "c").join(components(links).withColumnRenamed("node", "c"), "c", "left").selectExpr(
            "key", "c", "n", "most", "coalesce(label, c) AS label")
    return _linkable(_linkable(written_table(spark, members, "bounded"), percent), percent)


def _compared(percent: int):
    """All pairs of two blocks of a bucket, or of one block: links (u, v) between different components."""
    def run(table):
        import pyarrow as pa
        rows = {name: table.column(name).to_numpy() for name in ("c", "label", "block")}
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        lists = table.column("shingles").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        cuts = np.concatenate([[0], np.cumsum(counts)])
        vocabulary, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        first, second = np.flatnonzero(rows["block"] == low), np.flatnonzero(rows["block"] == high)
        flag, us, vs = np.zeros(len(vocabulary), dtype=np.int64), [], []
        others = np.concatenate([codes[cuts[k]:cuts[k + 1]] for k in second]) if len(second) else codes[:0]
        starts = np.concatenate([[0], np.cumsum(counts[second])[:-1]]) if len(second) else counts[:0]
        for k in first if len(second) else ():
            own = codes[cuts[k]:cuts[k + 1]]
            flag[own] = 1
            common = np.add.reduceat(flag[others], starts)
            flag[own] = 0
            linked = ((100 + percent) * common >= percent * (counts[k] + counts[second])) & (
                rows["label"][second] != rows["label"][k])
            us.append(np.full(linked.sum(), rows["c"][k]))
            vs.append(rows["c"][second[linked]])
        none = np.zeros(0, dtype=np.int64)
        return pa.table({"u": np.concatenate([*us, none]), "v": np.concatenate([*vs, none])})
    return run


def _in_blocks(spark, buckets: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """All links of what the rounds left open: each bucket is cut into blocks of bounded size, each pair of
    blocks is a task's group, and the pairs inside are compared there without becoming rows."""
    members = written_table(spark, _open_members(buckets, sets, links, percent), "open-members")
    sizes = members.groupBy("key").agg(F.expr(
        f"CAST(greatest(ceil(count(*) / {BLOCK_ROWS}), ceil(sum(n) / {BLOCK_SHINGLES})) AS INT)").alias("blocks"))
    dealt = members.join(sizes, "key").selectExpr(
        "key", "c", "label", "blocks", "CAST(pmod(xxhash64(c, key), blocks) AS INT) AS block").join(
        sets.select("c", "shingles"), "c")
    groups = dealt.select("key", "c", "label", "block", "shingles", F.explode(F.expr(
        "transform(sequence(0, blocks - 1), k -> struct(least(k, block) AS low, greatest(k, block) AS high))")).alias("g"))
    found = groups.selectExpr("key", "g.low", "g.high", "c", "label", "block", "shingles").groupBy(
        "key", "low", "high").applyInArrow(_compared(percent), "u long, v long")
    return written_table(spark, links.union(found.distinct()), "links")


def _links(spark, reps: DataFrame, sets: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (u, v) that connect the same classes as all links between classes of a common table key.

    First one pivot of every table key, so that copies of one text cost one
    comparison each. What is left is looked at by the keys of the first collection alone,
    which hold every pair of a table key: a few pivots each, which settles all small ones, then blocks.
    """
    links, rest = _round(spark, buckets, sets, None, 1, percent)
    halves = reps.select("c", F.explode(F.expr("filter(halves, h -> h & 1 = 0)")).alias("key"))
    links, rest = _round(spark, halves.join(rest.select("c").distinct(), "c", "left_semi"), sets, links, 4, percent)
    return _in_blocks(spark, rest, sets, links, percent)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None,
                    size: int = SIZE, percent: int = PERCENT, tables: int = TABLES, rows: int = ROWS) -> DataFrame:
    """Groups documents whose sets of distinct word shingles have a Jaccard similarity of ``percent`` or more.

    One row per input row: row, doc_id, n_shingles, component_id (smallest doc_id
    reachable over links), kept (doc_id = component_id), grp (one value per component).
    ``row`` names a unique long column that stays the same when it is computed again; without it rows are numbered here.

    A-Z are lower-cased; words are runs without ASCII white space. A text with
    fewer words than a shingle has is one shingle; null, empty and blank texts
    have none and link with nothing. Repeated rows and copies are one class. A
    null doc_id is larger than any other and kept only if no member has one.
    Other columns are not looked at. An empty table gives an empty result.

    A link at similarity s is missed only if one collection has no common key:
    1 - (1 - (1 - s^rows)^tables)^2, that is 2 in 100,000 at 0.8 by default.
    """
    spark = docs.sparkSession
    rows_of = docs.selectExpr(f"`{row}` AS row", f"`{doc_id}` AS id", f"`{text}` AS t") if row else numbered(
        docs.selectExpr(f"`{doc_id}` AS id", f"`{text}` AS t")).selectExpr("row", "doc.id", "doc.t")
    texts_of = rows_of.selectExpr("CAST(row AS BIGINT) AS row", "CAST(id AS BIGINT) AS doc_id", "CAST(t AS STRING) AS text")
    sketches = written_table(spark, texts_of.mapInArrow(
        _sketched(size, tables, rows),
        "row long, doc_id long, n long, d1 long, d2 long, halves array<long>"), "sketches")
    classes = written_table(spark, sketches.where("n > 0").groupBy("d1", "d2").agg(
        F.min("row").alias("c"), F.min("doc_id").alias("first_id"), F.count("*").alias("members")), "classes")
    reps = sketches.join(classes.select(F.col("c").alias("row")), "row", "left_semi").withColumnRenamed("row", "c")
    buckets = written_table(spark, _buckets(reps), "buckets")
    # Few texts meet another one: by their stable numbers only these are taken, the others stay where they are.
    wanted = buckets.selectExpr("c AS row", "true AS wanted").distinct()
    texts = beside(texts_of, written_table(spark, wanted, "wanted")).where("wanted").selectExpr("row AS c", "text")
    sets = written_table(spark, texts.mapInArrow(_full_sets(size), "c long, n long, shingles array<long>"), "sets")
    links = _links(spark, reps, sets, buckets, percent)
    labelled = classes.join(
        components(links).withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    labelled = written_table(spark, labelled, "labelled")
    first = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"), F.sum("members").alias("total"))
    grouped = labelled.join(first.where("total > 1"), "label").select("d1", "d2", "label", "component_id")
    grouped = grouped.withColumnsRenamed({"d1": "_d1", "d2": "_d2"})
    found = sketches.join(grouped, F.expr("n > 0 AND d1 = _d1 AND d2 = _d2"), "left")
    whole = found.selectExpr("row", "doc_id", "n AS n_shingles", "coalesce(component_id, doc_id) AS component_id",
                             "coalesce(label, row) AS grp")
    return whole.selectExpr("row", "doc_id", "n_shingles", "component_id", "doc_id <=> component_id AS kept", "grp")


def one_of_each(found: DataFrame) -> DataFrame:
    """The rows (column row) that stay: of each component the first row that carries its smallest doc_id."""
    return found.where("kept").groupBy("grp").agg(F.min("row").alias("row")).select("row")


# Every link by counting common shingles of every pair that has one.
_NEXT = ", ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, SIZE)]])
ORACLE = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+'), lambda x: x <> '') AS w FROM documents),
e AS (SELECT row, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
l AS (SELECT row, n, list_filter([{_NEXT}], lambda x: x IS NOT NULL) AS l FROM e WINDOW o AS (PARTITION BY row ORDER BY i)),
s AS (SELECT DISTINCT row, hash(array_to_string(l, ' ')) AS shingle FROM l WHERE len(l) = least(n, {SIZE})),
z AS (SELECT row, count(*) AS size FROM s GROUP BY row),
p AS (SELECT a.row AS a, b.row AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY ALL),
k AS (SELECT a, b FROM p JOIN z x ON x.row = a JOIN z y ON y.row = b WHERE 100 * common >= {PERCENT} * (x.size + y.size - common)),
r AS (SELECT row AS a, row AS b FROM d UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
m AS (SELECT r.a AS row, min(doc_id) AS component_id FROM r JOIN d ON d.row = r.b GROUP BY r.a)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN m USING (row) LEFT JOIN z USING (row)
"""
