"""Hard negatives of anchors: bounds along a spanning tree of the anchors, exact scores where a bound meets a window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

SCALE = 256            # a component x counts as floor(SCALE * x)
POSITIVES, NEGATIVES = 5, 5
LEAST, MOST = 80, 100  # score of a negative in percent of the positive's
ANCHORS = 1 << 17      # components of a block of anchors
ROWS = 1 << 19         # components of a block of rows
STEP = 2048            # rows that are bounded at once while the best are sought
NO_ID = np.iinfo(np.int64).max


def prepared(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(row, vec_id, label, q) of the rows that take part; q has whole numbers.

    Rows with a null label, a null vector, a null or non-finite component, or a squared length of 2^62 or more (their scores
    may not fit 64 bits) take no part.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("bigint").alias("vec_id"),
                          F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
    sound = rows.where("label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) "
                       "AND abs(x) < double('Infinity'))")
    whole = derive(sound, {"q": f"transform(vector, x -> floor({SCALE}D * CAST(x AS DOUBLE)))"})
    return whole.where("aggregate(q, 0D, (s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE)) < 4611686018427387904D").select(
        "row", "vec_id", "label", F.expr("transform(q, x -> CAST(x AS INT))").alias("q"))


class Block:
    """Rows of a tile in the order of their ids: matrix (shorter vectors end in zeros), norms, row, id and label."""

    def __init__(self, table):
        ids = table.column("vec_id")
        table = table.take(np.lexsort((ids.fill_null(NO_ID).to_numpy(), ids.is_null().to_numpy())))
        self.row, self.label = table.column("row").to_numpy(), table.column("label").to_numpy()
        self.id = table.column("vec_id")
        self.table = table
        lists = table.column("q").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        self.matrix = np.zeros((len(counts), int(counts.max(initial=0))))
        self.matrix[np.arange(self.matrix.shape[1]) < counts[:, None]] = lists.flatten().to_numpy()
        self.squares = np.einsum("ij,ij->i", self.matrix, self.matrix)

    def fit(self, other: Block) -> None:
        """Both to one width, and to numbers in which scores are exact."""
        width = max(self.matrix.shape[1], other.matrix.shape[1])
        small = max(self.squares.max(initial=0), other.squares.max(initial=0)) < 2.0 ** 52
        for block in (self, other):
            block.matrix = np.pad(block.matrix, ((0, 0), (0, width - block.matrix.shape[1]))).astype(np.float64 if small else np.int64)
            block.norms = np.sqrt(block.squares.astype(np.float64 if small else np.longdouble))


def spanning_tree(points: np.ndarray):
    """(groups, edges): a tree two levels deep below the first point, as lists of a pivot and its children.

    Pivots lie far from one another: each is the point farthest from those before; every other point is a child of the nearest.
    ``edges`` has the distance of each point to its pivot, rounded up.
    """
    points = points.astype(np.float64)
    nearest, owner = np.full(len(points), np.inf), np.zeros(len(points), dtype=np.int64)
    pivot = 0
    for k in range(int(np.ceil(np.sqrt(len(points))))):
        gap = points - points[pivot]
        distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        closer = distance < nearest
        nearest[closer], owner[closer] = distance[closer], pivot
        nearest[pivot], owner[pivot] = 0, pivot
        pivot = int(nearest.argmax())
        if nearest[pivot] == 0:
            break
    groups = [(int(p), np.setdiff1d(np.flatnonzero(owner == p), [p])) for p in np.unique(owner)]
    return groups, nearest * (1 + 1e-9)


def met(tree, anchors: Block, rows: Block, at: slice, low: np.ndarray, high: np.ndarray) -> Iterator:
    """(anchor, places among ``rows``, exact scores) of all rows in ``at`` whose score may lie in the anchor's window.

    The score at a pivot, plus or minus the edge times the norm of the row, bounds the score at a child; rows whose bounds
    miss the window from ``low`` to ``high`` are not scored.
    """
    groups, edges = tree
    matrix, norms, first = rows.matrix[at], rows.norms[at], at.start
    for pivot, children in groups:
        base = matrix @ anchors.matrix[pivot]
        near = np.flatnonzero((base >= low[pivot]) & (base <= high[pivot]))
        yield pivot, near + first, base[near].astype(np.int64)
        base = base.astype(norms.dtype)
        for k in range(0, len(children), 64):
            some = children[k:k + 64]
            slack = edges[some, None] * norms + 1
            overlap = (base + slack >= low[some, None]) & (base - slack <= high[some, None])
            columns = np.flatnonzero(overlap.any(axis=0))
            if not len(columns):
                continue
            exact = anchors.matrix[some] @ matrix[columns].T
            for i, child in enumerate(some.tolist()):
                mine = overlap[i, columns]
                yield child, columns[mine] + first, exact[i, mine].astype(np.int64)


def best(scores: np.ndarray, places: np.ndarray, k: int):
    """The k first by falling score; equal scores by rising place."""
    if len(scores) > k:
        least = np.partition(scores, -k)[-k]
        strong, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        equal = equal[np.argsort(places[equal], kind="stable")[:k - len(strong)]] if len(equal) > k - len(strong) else equal
        scores, places = scores[np.concatenate([strong, equal])], places[np.concatenate([strong, equal])]
    order = np.lexsort((places, -scores))
    return scores[order], places[order]


def _tile(work):
    """``work`` on the anchors and rows of one tile; nothing if either is missing."""
    def run(left, right):
        import pyarrow as pa
        if not len(left) or not len(right):
            return pa.table({c: pa.array([], pa.int64()) for c in ("anchor", "cap", "id", "score")})
        anchors, rows = Block(left), Block(right.rename_columns([c.removeprefix("row_") for c in right.column_names]))
        anchors.fit(rows)
        found = [(a, cap, places, scores) for a, cap, places, scores in work(anchors, rows, spanning_tree(anchors.matrix)) if len(places)]
        counts = [len(places) for _, _, places, _ in found]
        none = np.zeros(0, dtype=np.int64)
        return pa.table({
            "anchor": pa.array(np.repeat(np.array([anchors.row[a] for a, *_ in found], dtype=np.int64), counts)),
            "cap": pa.array(np.repeat(np.array([cap for _, cap, *_ in found], dtype=np.int64), counts)),
            "id": rows.id.take(np.concatenate([none, *[places for *_, places, _ in found]])).combine_chunks(),
            "score": pa.array(np.concatenate([none, *[scores for *_, scores in found]]))})
    return run


def _best_alike(anchors: Block, rows: Block, tree) -> Iterator:
    """The best rows of each anchor's label in the tile: the window is above the worst of the best so far."""
    low, high = np.full(len(anchors.row), -np.inf), np.full(len(anchors.row), np.inf)
    none = np.zeros(0, dtype=np.int64)
    held = [(none, none)] * len(anchors.row)
    for start in range(0, len(rows.row), STEP):
        for a, places, scores in met(tree, anchors, rows, slice(start, start + STEP), low, high):
            alike = (rows.label[places] == anchors.label[a]) & (rows.row[places] != anchors.row[a])
            held[a] = best(np.concatenate([held[a][0], scores[alike]]), np.concatenate([held[a][1], places[alike]]), POSITIVES)
            if len(held[a][0]) == POSITIVES:
                low[a] = held[a][0][-1]
    for a, (scores, places) in enumerate(held):
        yield a, 0, places, scores


def _best_unlike(least: int, most: int, k: int):
    def work(anchors: Block, rows: Block, tree) -> Iterator:
        """For each window of an anchor the best rows of other labels in it."""
        caps = [sorted(c) for c in anchors.table.column("caps").to_pylist()]
        windows = [[(-(-least * c // 100), most * c // 100) for c in own] for own in caps]
        low = np.array([min(w[0] for w in own) for own in windows])
        high = np.array([max(w[1] for w in own) for own in windows])
        for a, places, scores in met(tree, anchors, rows, slice(0, len(rows.row)), low, high):
            unlike = (rows.label[places] != anchors.label[a]) & (scores >= low[a]) & (scores <= high[a])
            places, scores = places[unlike], scores[unlike]
            for cap, (lowest, highest) in zip(caps[a], windows[a], strict=True):
                inside = (scores >= lowest) & (scores <= highest)
                found = best(scores[inside], places[inside], k)
                yield a, cap, found[1], found[0]
    return work


def _tiles(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], work) -> DataFrame:
    """(anchor, cap, id, score): every block of anchors meets every block of rows in one group of bounded size."""
    a, r = blocks
    left = derive(anchors, {"ab": f"CAST(pmod(xxhash64(row), {a}L) AS INT)", "rb": f"explode(sequence(0, {r - 1}))"})
    # Both sides come from one table: without names of its own the second one would lose its columns in the group.
    right = derive(rows.select(*[F.col(c).alias(f"row_{c}") for c in rows.columns]), {"rb": f"CAST(pmod(xxhash64(row_row), {r}L) AS INT)", "ab": f"explode(sequence(0, {a - 1}))"})
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(
        _tile(work), "anchor long, cap long, id long, score long")


def _first(found: DataFrame, keys: str, k: int) -> DataFrame:
    return found.withColumn("rank", F.expr(
        f"row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, id ASC NULLS LAST)")).where(f"rank <= {k}")


def hard_negatives(rows: DataFrame, is_anchor: str, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least: int = LEAST, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for rows as ``prepared`` gives them.

    Anchors are the rows with ``is_anchor`` (SQL over vec_id and label). The score of a row is its inner product with the
    anchor, missing components counting as zero; higher scores come first, then smaller vec_ids, null last. Positives of an
    anchor are its first other rows of the same label; for each, the first rows of another label follow whose score is
    ``least`` to ``most`` percent of the positive's (a negative score has none). Anchors without positives, and positives
    without negatives, give no rows. Repeated rows, and rows that share a vec_id, are rows of their own. An empty table gives
    an empty result.

    Every anchor is compared with every row, in tiles of bounded size: blocks of anchors by blocks of rows, dealt by a hash
    of the row, so that no label and no vector gathers in one task. A tile returns a few rows for each anchor.
    """
    spark = rows.sparkSession
    rows = written_table(spark, rows, "vectors")
    n, anchors_n, width = rows.agg(F.count("*"), F.count_if(F.expr(is_anchor)), F.max(F.size("q"))).first()
    per = [max(1, size // max(1, width or 0)) for size in (ANCHORS, ROWS)]
    blocks = (max(1, -(-anchors_n // per[0])), max(1, -(-n // per[1])))
    anchors = rows.where(is_anchor)
    alike = _tiles(anchors, rows, blocks, _best_alike)
    known = written_table(spark, _first(alike, "anchor", positives).selectExpr(
        "anchor", "id AS positive_id", "score AS positive_score"), "positives")
    caps = known.groupBy("anchor").agg(F.collect_set("positive_score").alias("caps")).withColumnRenamed("anchor", "row")
    unlike = _tiles(anchors.join(caps, "row"), rows, blocks, _best_unlike(least, most, negatives))
    ranks = _first(unlike, "anchor, cap", negatives).selectExpr(
        "anchor", "cap AS positive_score", "rank", "id AS negative_id", "score AS negative_score")
    ids = anchors.selectExpr("row AS anchor", "vec_id AS anchor_id")
    return known.join(ranks, ["anchor", "positive_score"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = f"""
WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS a, b.row AS b, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, coalesce(list_sum(list_transform(
    list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.row <> b.row),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST) <= {POSITIVES})
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id NULLS LAST))::INTEGER AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.alike AND {LEAST} * p.score <= 100 * n.score AND 100 * n.score <= {MOST} * p.score
QUALIFY rank <= {NEGATIVES}
"""
