"""Hard negatives of anchors among all rows, by a multiway hyperplane tree with distance ranges.

Rows are vectors whose components x count as floor(256 x); the score of a row for an anchor is their
integer inner product. An anchor's positives are its ``POSITIVES`` best other rows of its label. For
each positive with score s the negatives are the ``NEGATIVES`` best rows of another label with
80 s <= 100 score <= 100 s. Ties go to the smaller id.

Distances. With one more component sqrt(M - |row|^2) for a row (M: the largest squared norm) and 0 for
an anchor, |anchor - row|^2 = |anchor|^2 + M - 2 score, so a window of scores is an annulus around the
anchor, and rows keep a metric among themselves.

The tree. Split points are chosen from a bounded sample of rows (``SAMPLE`` by the hash of their ids);
a node sends each row to its nearest split point, that is, cuts space by the hyperplanes between them,
level by level (``FANOUT`` each, as many levels as the number of rows asks for). Every row is put into its
leaf, and every split point stores the least and the largest distance of it to the rows of each sibling's
subtree, over all rows. A search asks at each node for the anchor's distances to the split points;
a subtree whose range around a split point has nothing in common with the annulus, as seen from there, is
left out. What is left are leaves whose rows are all scored exactly.

Two searches run over the same tree: the positives (an annulus from the nearest rows to the worst of five
rows of the label in the anchor's own leaf, a bound that is at hand), then the negatives (the annuli of the
positives). A leaf's rows lie in blocks of about ``BLOCK``, so a leaf of equal vectors is many blocks, and anchors
are dealt into parts of about ``ANCHOR_PART``; a block meets the anchors of a part that reach its leaf, and
their best rows are merged by Spark.

Sizes: the tree has at most ``FANOUT`` ** 2 leaves whatever the input and is all that is broadcast (in
the closures); anchors and rows are shuffled to (leaf, block, part). Scores are exact below 2^53.

Edge cases: rows with a null id, label or vector, with a null or non-finite component or an empty vector
take no part, nor do those of another length than the most frequent; rows with equal ids are one row, that
of the smallest label, then vector; an anchor without positives or negatives has no rows; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import python_ready, trimmed
from .components import stored

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
SCALE = 256
SAMPLE = 16384
FANOUT = 32  # at most, at each of up to two levels
LEAF_ROWS = 2048
BLOCK = 8192
ANCHOR_PART = 16384
ANCHORS = 1024  # scored at once
SLACK = 1e-6  # of a squared distance, far above the rounding of float64


class Node:
    """Split points (lifted) and their subtrees: nodes, or numbers of leaves."""

    def __init__(self, points: np.ndarray, below: list):
        self.points, self.below = points, below


class Tree:
    """Split points of a sample of lifted vectors, in two levels for more than ``FANOUT`` leaves."""

    def __init__(self, sample: np.ndarray, leaves: int):
        levels = 0 if leaves < 2 else 1 if leaves <= FANOUT else 2
        self.fanout = min(FANOUT, math.ceil(leaves ** (1 / levels))) if levels else 0
        self.nodes, self.paths = [], []  # of each leaf the nodes and children above it
        self.root = self._grow(sample, levels, ())

    def _grow(self, rows: np.ndarray, levels: int, path: tuple):
        points = spread_points(rows, self.fanout) if levels else rows[:0]
        if len(points) < 2:
            self.paths.append(path)
            return len(self.paths) - 1
        node = Node(points, [])
        node.number = len(self.nodes)
        self.nodes.append(node)
        near = distances2(rows, points).argmin(1)
        node.below = [self._grow(rows[near == k], levels - 1, (*path, (node.number, k))) for k in range(len(points))]
        return node

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        leaf = np.zeros(len(rows), np.int64)
        stack = [(self.root, np.arange(len(rows)))]
        while stack:
            node, which = stack.pop()
            if not isinstance(node, Node):
                leaf[which] = node
            elif len(which):
                near = distances2(rows[which], node.points).argmin(1)
                stack += [(below, which[near == k]) for k, below in enumerate(node.below)]
        return leaf

    def reached(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray, bounds: dict) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, leaf) pairs that may hold a row at a distance from inner to outer. bounds[node, child]: least and
        largest distance of the child's rows to the node's points; a child without rows has none."""
        pairs, stack = [], [(self.root, np.arange(len(anchors)))]
        while stack:
            node, which = stack.pop()
            if not isinstance(node, Node):
                pairs.append((which, np.full(len(which), node)))
                continue
            d = np.sqrt(distances2(anchors[which], node.points))
            # A row at distance r of the anchor is |d - r| to d + r from a point at distance d.
            near = np.maximum(0, np.maximum(d - outer[which, None], inner[which, None] - d))
            far = d + outer[which, None]
            for k, below in enumerate(node.below):
                if (node.number, k) in bounds:
                    low, high = bounds[node.number, k]
                    some = which[((far >= low) & (near <= high)).all(1)]
                    if len(some):
                        stack.append((below, some))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs])


def distances2(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    d = (rows * rows).sum(1)[:, None] + (points * points).sum(1) - 2 * rows @ points.T
    return np.maximum(d, 0)


def spread_points(rows: np.ndarray, many: int) -> np.ndarray:
    """Different rows far from each other: each the farthest from those chosen before."""
    if len(rows) == 0:
        return rows
    chosen = [0]
    d = distances2(rows, rows[:1])[:, 0]
    while len(chosen) < many and d.max() > 0.5:  # components are integers but for the last
        chosen.append(int(d.argmax()))
        d = np.minimum(d, distances2(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([vectors, np.sqrt(np.maximum(most - (vectors * vectors).sum(1), 0))])


def vectors_of(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64)


def quantized(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """id, label, vector (array<long>) of the rows that take part."""
    usable = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(
        "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = usable.where(F.forall("vector", lambda x: finite(x.cast("double"))))
    return usable.withColumn("vector", F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def _placed(tree: Tree, most: float, dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.place(lifted(vectors_of(b.column("vector"), dimension), most))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=[*b.schema.names, "leaf"])

    return run


def _ranges(tree: Tree, most: float, dimension: int):
    """Least and largest squared distances of the rows of a subtree to the points of the node above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = {}, {}
        for b in batches:
            rows, leaf = lifted(vectors_of(b.column("vector"), dimension), most), b.column("leaf").to_numpy()
            for one in np.unique(leaf):
                mine = rows[leaf == one]
                for at in tree.paths[one]:
                    d = distances2(mine, tree.nodes[at[0]].points)
                    low[at] = np.minimum(low.get(at, np.inf), d.min(0))
                    high[at] = np.maximum(high.get(at, 0), d.max(0))
        if low:
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([n for n, _ in low], pa.int32()), "child": pa.array([k for _, k in low], pa.int32()),
                "low": pa.array([x.tolist() for x in low.values()], pa.list_(pa.float64())),
                "high": pa.array([high[x].tolist() for x in low], pa.list_(pa.float64()))})

    return run


def _reach(tree: Tree, bounds: dict, most: float, dimension: int):
    """Anchors (with least and largest score) to the leaves that may hold rows with such scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ANCHORS):
                b = whole.slice(at, ANCHORS)
                v = vectors_of(b.column("vector"), dimension)
                square = (v * v).sum(1) + most
                low, high = (b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("low", "high"))
                edge = lambda s: np.sqrt(np.maximum(square - 2 * s, 0))
                slack = SLACK * np.sqrt(np.maximum(square, 1))
                which, leaf = tree.reached(np.column_stack([v, np.zeros(len(v))]), edge(high) - slack, edge(low) + slack, bounds)
                rows = b.select([c for c in b.schema.names if c not in ("low", "high")]).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(leaf)], names=[*rows.schema.names, "leaf"])

    return run


def _top(scores, ids, allowed, keep):
    """Per row of scores the places of its best allowed values, higher first, then by id."""
    for k in range(len(scores)):
        ok = np.flatnonzero(allowed[k])
        if len(ok) > keep:
            s = scores[k, ok]
            ok = ok[s >= np.partition(s, len(s) - keep)[len(s) - keep]]
        yield k, ok[np.lexsort((ids[ok], -scores[k, ok]))[:keep]]


def _score_positives(dimension: int, keep: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = {"anchor_id": [], "id": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            v = vectors_of(rows.column("vector"), dimension)
            for at in range(0, anchors.num_rows, ANCHORS):
                b = anchors.slice(at, ANCHORS)
                of, of_label = b.column("id").to_numpy(), b.column("label").to_numpy()
                scores = vectors_of(b.column("vector"), dimension) @ v.T
                ok = (labels == of_label[:, None]) & (ids != of[:, None])
                for k, best in _top(scores, ids, ok, keep):
                    found["anchor_id"].append(np.full(len(best), of[k]))
                    found["id"].append(ids[best])
                    found["score"].append(scores[k, best])
        return pa.table({c: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for c, x in found.items()})

    return trimmed(run)


def _score_negatives(dimension: int, keep: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = {"anchor_id": [], "positive_id": [], "id": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            v = vectors_of(rows.column("vector"), dimension)
            for at in range(0, anchors.num_rows, ANCHORS):
                b = anchors.slice(at, ANCHORS)
                of, of_label = b.column("id").to_numpy(), b.column("label").to_numpy()
                positives = b.column("positives").to_pylist()
                scores = vectors_of(b.column("vector"), dimension) @ v.T
                for k, (mine, other) in enumerate(zip(positives, labels != of_label[:, None])):
                    s = np.array([p["score"] for p in mine], np.float64)
                    ok = other & (HIGH * scores[k] >= LOW * s[:, None]) & (scores[k] <= s[:, None])
                    for j, best in _top(np.broadcast_to(scores[k], ok.shape), ids, ok, keep):
                        found["anchor_id"].append(np.full(len(best), of[k]))
                        found["positive_id"].append(np.full(len(best), mine[j]["id"]))
                        found["id"].append(ids[best])
                        found["score"].append(scores[k, best])
        return pa.table({c: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for c, x in found.items()})

    return trimmed(run)


def _best(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The best rows of each key with their rank; Spark cuts to them before the shuffle, too."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: id, label, vector (see ``quantized``); anchors: id of those rows that are anchors.
    """
    spark = rows.sparkSession
    python_ready(spark)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    plain = "id long, label long, vector array<long>"
    one = rows.groupBy(F.col("id").cast("long").alias("id")).agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "vector")).alias("r"))
    rows = stored(one.select("id", "r.label", "r.vector").where(F.size("vector") > 0), "rows")
    shape = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if shape is None:
        return spark.createDataFrame([], result)
    dimension, many = shape["n"], shape["count"]
    rows = rows.where(F.size("vector") == dimension)
    anchors = stored(rows.join(anchors.select(F.col("id").cast("long").alias("id")), "id", "left_semi"), "anchors")
    parts = math.ceil(anchors.count() / ANCHOR_PART)
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    most = float(rows.agg(F.max(square)).first()[0])

    # The tree, from a bounded sample; then every row's leaf, and the ranges over all rows.
    hashed = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    sampled = rows.where(hashed <= math.ceil(min(1.0, SAMPLE / many) * (1 << 20))).orderBy(hashed, "id").limit(SAMPLE)
    sample = vectors_of(sampled.select("vector").toArrow().column("vector"), dimension)
    tree = Tree(lifted(sample, most), math.ceil(many / LEAF_ROWS))
    placed = stored(rows.mapInArrow(_placed(tree, most, dimension), f"{plain}, leaf long"), "placed")
    ranges = placed.mapInArrow(_ranges(tree, most, dimension), "node int, child int, low array<double>, high array<double>")
    each = ranges.select("node", "child", F.posexplode(F.arrays_zip("low", "high")).alias("point", "r"))
    each = each.groupBy("node", "child", "point").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"))
    bounds: dict = {}
    for r in each.orderBy("node", "child", "point").collect():  # FANOUT ** 2 numbers a node of the tree
        low, high = bounds.setdefault((r["node"], r["child"]), ([], []))
        low.append(math.sqrt(r["low"]) * (1 - SLACK) - SLACK)
        high.append(math.sqrt(r["high"]) * (1 + SLACK) + SLACK)
    bounds = {k: (np.array(low), np.array(high)) for k, (low, high) in bounds.items()}

    sizes = stored(placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "sizes")
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    each_part = F.explode(F.sequence(F.lit(0), F.lit(max(parts, 1) - 1))).alias("part")
    blocks = placed.join(sizes, "leaf").select("id", "label", "vector", "leaf", block.alias("block"), each_part)
    meeting = ["leaf", "block", "part"]

    def met(queries: DataFrame, score, result: str) -> DataFrame:
        dealt = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(parts, 1))).cast("int"))
        return blocks.groupBy(*meeting).cogroup(dealt.groupBy(*meeting)).applyInArrow(score, result)

    def searched(queries: DataFrame, schema: str, score, result: str) -> DataFrame:
        reached = queries.mapInArrow(_reach(tree, bounds, most, dimension), f"{schema}, leaf long").join(sizes, "leaf")
        return met(reached.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks"),
                   score, result)

    # A bound of the worst positive: rows of the label in a block of the leaf that the anchor itself lies in.
    found, scored = "anchor_id long, id long, score long", _score_positives(dimension, POSITIVES)
    own = anchors.mapInArrow(_placed(tree, most, dimension), f"{plain}, leaf long").join(sizes, "leaf")
    near = met(own.withColumn("block", block).drop("blocks"), scored, found)
    bound = stored(near.groupBy("anchor_id").agg(F.min("score").alias("low"), F.count("*").alias("n")).where(
        F.col("n") >= POSITIVES), "bound")
    # Without a bound any row may be a positive; scores end at the product of the largest norms.
    length = F.sqrt(square.cast("double") * most) + 1
    queries = anchors.join(bound, F.col("id") == F.col("anchor_id"), "left").select(
        "id", "label", "vector", F.coalesce(F.col("low").cast("double"), -length).alias("low"), length.alias("high"))
    best = stored(_best(searched(queries, plain, scored, found), ["anchor_id"], POSITIVES), "positives")
    positives = best.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives"))

    # 80 s <= 100 score <= 100 s holds for no score if s < 0.
    open_ = anchors.join(positives, F.col("id") == F.col("anchor_id")).select(
        "id", "label", "vector", F.filter("positives", lambda p: p["score"] >= 0).alias("positives")).where(F.size("positives") > 0)
    scores = F.transform("positives", lambda p: p["score"].cast("double"))
    ranged = open_.withColumn("low", F.array_min(scores) * LOW / HIGH).withColumn("high", F.array_max(scores))
    negatives = searched(ranged, f"{plain}, positives array<struct<id:long,score:long>>",
                         _score_negatives(dimension, NEGATIVES), "anchor_id long, positive_id long, id long, score long")
    scored_positives = best.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return _best(negatives, ["anchor_id", "positive_id"], NEGATIVES).join(scored_positives, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
