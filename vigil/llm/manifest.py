"""A Merkle tree over a dataset: nodes with intervals of leaf ranks, ancestors by containment, siblings by interval difference."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10            # levels of a bucket: a task's group is one node at its top with at most 2^LEVELS nodes below
SMALL = 200_000        # rows of first ranks that are broadcast
STEP = 33              # bytes of a step of a proof: its side, and the sibling's digest
ALONE, LEFT, RIGHT = 0, 1, 2  # side on which the sibling stands


def digest(*parts: str) -> str:
    """SQL: lower-case hex SHA-256 of the parts, one after the other."""
    return f"sha2(CAST(concat({', '.join(parts)}) AS BINARY), 256)"


def framed(value: str) -> str:
    """SQL: a value with its length in UTF-8 bytes before it, - for null."""
    return f"coalesce(concat(octet_length({value}), ':', {value}), '-')"


def leaves(docs: DataFrame, tree: str = "lang", order: str = "doc_id", tampered: str = "pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 7) = 0") -> DataFrame:
    """(tree, id, row, leaf, other) of documents: ``other`` is the leaf after tampering with n_chars, null where there is none."""
    texts = docs.selectExpr(*[f"CAST(`{c}` AS STRING) AS {c}" for c in FIELDS], f"CAST(`{order}` AS BIGINT) AS _id",
                            f"CAST(`{tree}` AS STRING) AS _tree", "CAST(CAST(n_chars AS DECIMAL(20, 0)) + 1 AS STRING) AS _more",
                            f"{tampered} AS _tampered", "monotonically_increasing_id() AS _row")
    whole = [framed(c) for c in FIELDS]
    changed = [framed("_more" if c == "n_chars" else c) for c in FIELDS]
    return texts.selectExpr("coalesce(concat('=', _tree), '') AS tree", "_id AS id", "_row AS row", f"unhex({digest(*whole)}) AS leaf",
                            f"CASE WHEN _tampered AND n_chars IS NOT NULL THEN unhex({digest(*changed)}) END AS other")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds lo and hi = lo + 1, the rank of each row in its tree by ``order`` (unique in a tree), and n, the rows of its tree.

    Rows are dealt into ranges over all trees at once, so a tree with most of the rows is spread as well; ranks are places in
    a range plus the rows of the tree in the ranges before.
    """
    spark = rows.sparkSession
    ranges = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = written_table(spark, ranges.selectExpr(
        "*", "spark_partition_id() AS part", "monotonically_increasing_id() & 8589934591L AS at"), "ranges")
    shares = placed.groupBy("tree", "part").agg(F.min("at").alias("begin"), F.count("*").alias("rows")).selectExpr(
        "tree", "part", "sum(rows) OVER (PARTITION BY tree ORDER BY part) - rows - begin AS shift", "sum(rows) OVER (PARTITION BY tree) AS n")
    shares = written_table(spark, shares, "shares")
    size = shares.agg(F.count("*"), F.coalesce(F.max(F.length("tree")), F.lit(0))).first()
    found = placed.join(F.broadcast(shares) if size[0] <= SMALL and size[1] <= 200 else shares, ["tree", "part"])
    return found.selectExpr(*rows.columns, "at + shift AS lo", "at + shift + 1 AS hi", "n")


def hashed(parts: Iterator[bytes]) -> bytes:
    """H of digests, each as hex text."""
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


def _bucket(bucket: int):
    """All levels of a bucket above the nodes of one group: every node with its proof up to the top, and the top itself."""
    def run(table):
        import pyarrow as pa
        table = table.sort_by("lo")
        n = table.column("n")[0].as_py()
        steps = max(0, min(LEVELS, (n - 1).bit_length() - LEVELS * bucket))
        lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        own_lo, own_hi = lo, hi
        digests = table.column("digest").to_pylist()
        proofs = np.zeros((len(lo), steps, STEP), dtype=np.uint8)
        for k in range(steps):
            above_lo, above_hi = lo[::2], hi[1::2] if len(hi) % 2 == 0 else np.append(hi[1::2], hi[-1])
            # The interval of a parent holds the rank of a node below it; what it covers besides is the sibling.
            level = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)
            mine = np.searchsorted(lo, own_lo, side="right") - 1
            parent = np.searchsorted(above_lo, own_lo, side="right") - 1
            before, after = above_lo[parent] < lo[mine], hi[mine] < above_hi[parent]
            proofs[before, k, 0], proofs[after, k, 0] = LEFT, RIGHT
            proofs[before, k, 1:] = level[np.searchsorted(lo, above_lo[parent[before]])]
            proofs[after, k, 1:] = level[np.searchsorted(lo, hi[mine[after]])]
            digests = [hashed(digests[i:i + 2]) for i in range(0, len(digests), 2)]
            lo, hi = above_lo, above_hi
        proof = pa.array([p.tobytes() for p in proofs], pa.binary())
        rows = {name: table.column(name).combine_chunks() for name in ("tree", "lo", "hi", "n", "digest", "id", "other")}
        below = pa.table({**rows, "proof": proof, "top": pa.array([False] * len(proof))})
        top = pa.table({"tree": rows["tree"][:1], "lo": pa.array(own_lo[:1]), "hi": pa.array(own_hi[-1:]), "n": pa.array([n]),
                        "digest": pa.array(digests, pa.binary()), "id": pa.nulls(1, pa.int64()), "other": pa.nulls(1, pa.binary()),
                        "proof": pa.nulls(1, pa.binary()), "top": pa.array([True])})
        return pa.concat_tables([below, top.cast(below.schema)])
    return run


NODES = "tree string, lo long, hi long, n long, digest binary, id long, other binary, proof binary, top boolean"


def climbed(ranks: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Nodes by bucket of levels, each with its proof inside the bucket; and (tree, lo, hi, n, digest) of the roots of all trees.

    ``ranks`` has tree, lo, hi, n, digest, id and other. A bucket's groups are LEVELS levels high; the tops of its groups are
    the nodes of the next bucket, until the largest tree has one left.
    """
    spark = ranks.sparkSession
    largest = ranks.agg(F.max("n")).first()[0] or 1
    nodes, buckets = ranks, []
    for bucket in range(max(1, -(-(largest - 1).bit_length() // LEVELS))):
        width = LEVELS * (bucket + 1)
        found = nodes.withColumn("block", F.expr(f"shiftright(lo, {width})")).groupBy("tree", "block").applyInArrow(_bucket(bucket), NODES)
        found = written_table(spark, found, f"level-{bucket}")
        buckets.append(found.where("NOT top").drop("top"))
        nodes = found.where("top").drop("proof", "top")
    return buckets, nodes


def attached(buckets: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The lowest nodes with the whole proof up to what ``roots`` (tree, lo, hi, path, and what else is to be attached) ends with.

    From the top down, the nodes of a bucket are joined with the ancestors at its top: equal tree and block of ranks, the
    interval of the ancestor around theirs. Each ancestor has at most 2^LEVELS of them.
    """
    more = [c for c in roots.columns if c not in ("tree", "lo", "hi", "path")]
    above = roots
    for bucket in range(len(buckets) - 1, -1, -1):
        width = LEVELS * (bucket + 1)
        ancestors = above.selectExpr("tree", f"shiftright(lo, {width}) AS block", "lo AS from", "hi AS to", "path AS rest", *more)
        own = buckets[bucket].withColumn("block", F.expr(f"shiftright(lo, {width})"))
        above = own.join(ancestors, ["tree", "block"]).where("from <= lo AND hi <= to").selectExpr(
            "tree", "lo", "hi", "digest", "id", "other", "concat(proof, rest) AS path", *more)
    return above


def folded(leaf: bytes, path: bytes) -> tuple[bytes, bytes]:
    """(root that a leaf and the steps of its proof lead to, H of the siblings)."""
    siblings = []
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1:at + STEP]
        if side == ALONE:
            leaf = hashed([leaf])
            continue
        siblings.append(sibling)
        leaf = hashed([sibling, leaf] if side == LEFT else [leaf, sibling])
    return leaf, hashed(siblings)


def _verified(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("digest", "other", "path")]
        found = [folded(leaf if other is None else other, path) for leaf, other, path in zip(*columns, strict=True)]
        roots, proofs = pa.array([r for r, _ in found], pa.binary()), pa.array([p for _, p in found], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("id", "digest", "subroot", "root")] + [proofs, roots],
            names=["id", "digest", "subroot", "root", "proof", "folded"])


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and text, each with its length. The leaves of a language ascend by
    doc_id (null first, then by digest and row), pairs of nodes become their digest until one is left, the subroot; the subroots
    ascend by language (null first) and become the root alike. The proof of a leaf has its siblings up to the root; folded_root
    is what they lead to from the leaf, or from the leaf after tampering (documents chosen by their id; n_chars one more).

    Null values, empty and very long texts are values like others. Repeated rows are leaves of their own; which of them has
    which place is of no effect on the set of rows. A null doc_id is not tampered with. Other columns are not looked at. An
    empty table gives an empty result. Texts are read once; what is shuffled of a document is its digest and its proof.
    """
    spark = docs.sparkSession
    first = written_table(spark, leaves(docs), "leaves")
    ranks = ranked(first, ["id", "leaf", "row"]).withColumnRenamed("leaf", "digest")
    buckets, subroots = climbed(ranks.select("tree", "lo", "hi", "n", "digest", "id", "other"))
    tops = derive(subroots, {"lang": "tree", "tree": "''", "id": "CAST(NULL AS BIGINT)", "other": "encode(tree, 'UTF-8')"})
    over, roots = climbed(ranked(tops.drop("lo", "hi", "n"), ["lang"]).select("tree", "lo", "hi", "n", "digest", "id", "other"))
    ends = attached(over, roots.selectExpr("tree", "lo", "hi", "digest AS root", "X'' AS path"))
    known = ends.selectExpr("decode(other, 'UTF-8') AS tree", "path", "root", "digest AS subroot")
    whole = attached(buckets, subroots.select("tree", "lo", "hi").join(known, "tree"))
    shown = whole.select("id", "digest", "other", "path", "subroot", "root").mapInArrow(
        _verified, "id long, digest binary, subroot binary, root binary, proof binary, folded binary")
    return shown.selectExpr("id AS doc_id", "lower(hex(digest)) AS leaf", "lower(hex(subroot)) AS subroot", "lower(hex(root)) AS root",
                            "lower(hex(proof)) AS proof_sha256", "lower(hex(folded)) AS folded_root", "folded = root AS verified")


_FRAMED = {c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS}
_MORE = _FRAMED | {"n_chars": "coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-')"}
# crc32 bit by bit; then each level from the one below, siblings by place, and each leaf folded up level by level.
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({' || '.join(_FRAMED.values())}) AS leaf,
    sha256({' || '.join(_MORE.values())}) AS other, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda k: ascii(CAST(doc_id AS VARCHAR)[k])::BIGINT)), lambda c, b: list_reduce(
        list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc FROM documents),
l AS (SELECT *, row_number() OVER () AS row, doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0 AS tampered,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
t AS (SELECT tree, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM l UNION ALL
    SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY tree, level, i // 2),
s AS (SELECT tree, level AS height, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM t WHERE n = 1),
u AS (SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM s UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY level, i // 2),
q AS (SELECT row, r.level, (l.i >> r.level) & 1 AS side, t.h AS sibling FROM l JOIN s USING (tree), range(64) r(level)
    LEFT JOIN t ON t.tree = l.tree AND t.level = r.level AND t.i = xor(l.i >> r.level, 1) WHERE r.level < s.height UNION ALL
    SELECT row, s.height + r.level, (s.i >> r.level) & 1, u.h FROM l JOIN s USING (tree), range(64) r(level)
    LEFT JOIN u ON u.level = r.level AND u.i = xor(s.i >> r.level, 1) WHERE r.level < (SELECT max(level) FROM u)),
f AS (SELECT row, 0 AS level, CASE WHEN tampered THEN other ELSE leaf END AS h FROM l UNION ALL
    SELECT row, level + 1, sha256(CASE WHEN sibling IS NULL THEN h WHEN side = 1 THEN sibling || h ELSE h || sibling END) FROM f JOIN q USING (row, level)),
g AS (SELECT row, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof FROM l LEFT JOIN q USING (row) GROUP BY row),
e AS (SELECT row, arg_max(h, level) AS folded_root FROM f GROUP BY row)
SELECT doc_id, leaf, subroot, u.h AS root, proof AS proof_sha256, folded_root, folded_root = u.h AS verified
FROM l JOIN s USING (tree) JOIN g USING (row) JOIN e USING (row), u WHERE u.n = 1
"""
