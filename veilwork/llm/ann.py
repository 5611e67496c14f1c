"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veilwork.session import materialize

SAMPLE_ROWS = 50_000  # rows at most that the tree is fitted on
SAMPLE_LEAF = 32  # sampled rows per leaf at least, so that leaves are not fitted to single rows
LEAF_ROWS = 256  # rows per leaf aimed at
BRANCHES = 8
BLOCK_ROWS = 4096  # rows of a leaf, and queries, that one group of the search holds at most, about
CHUNK_QUERIES = 1 << 15
CALIBRATION_QUERIES = 400


@dataclass
class Tree:
    """centres: of all nodes but the root; children[n]: nodes below node n, root 0; leaf[n] or -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    leaves: int = 0
    rows: dict[int, int] = field(default_factory=dict)  # rows of the whole index by leaf
    pack: dict[int, tuple[int, int]] = field(default_factory=dict)  # (pack, its blocks) by leaf

    def pack_leaves(self, rows: dict[int, int], block_rows: int) -> None:
        """Neighbouring small leaves share a pack; a leaf of many rows is a pack of several blocks."""
        self.rows, number, held = rows, 0, 0
        for leaf in sorted(rows):
            if held and held + rows[leaf] > block_rows:
                number, held = number + 1, 0
            held += rows[leaf]
            self.pack[leaf] = (number, max(1, math.ceil(rows[leaf] / block_rows)))

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row, by the nearest child at each level."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            near = nearest(x[rows], self.centres[below])
            todo += [(child, rows[near == i]) for i, child in enumerate(below) if (near == i).any()]
        return out

    def order(self, q: np.ndarray) -> Iterator[int]:
        """Leaves best bin first: a queue holds the open nodes by the distance of their centres."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield self.leaf[node]
                continue
            gap = ((self.centres[below] - q) ** 2).sum(axis=1)
            for d, child in zip(gap.tolist(), below, strict=True):
                heapq.heappush(queue, (d, child))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)


def kmeans(x: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres drawn far apart, then moved to their rows' means."""
    centres = [x[draw.integers(len(x))]]
    gap = ((x - centres[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        if gap.sum() <= 0:
            break
        centres.append(x[draw.choice(len(x), p=gap / gap.sum())])
        gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(axis=1))
    at = np.array(centres)
    for _ in range(rounds):
        near = nearest(x, at)
        used = np.unique(near)
        moved = np.array([x[near == i].mean(axis=0) for i in used])
        if len(moved) == len(at) and np.allclose(moved, at):
            break
        at = moved
    return at


def fit_tree(x: np.ndarray, leaf_rows: int, branches: int = BRANCHES, seed: int = 1) -> Tree:
    """A tree over sample rows; a node splits while it has over `leaf_rows` of them that differ."""
    draw = np.random.default_rng(seed)
    tree = Tree(np.zeros((0, x.shape[1])), [[]], [-1])
    centres = [np.zeros(x.shape[1])]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) > leaf_rows:
            at = kmeans(x[rows], min(branches, math.ceil(len(rows) / leaf_rows)), draw)
            near = nearest(x[rows], at)
            parts = [(c, rows[near == i]) for i, c in enumerate(at) if (near == i).any()]
        if len(parts) < 2:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            continue
        for centre, own in parts:
            child = len(tree.children)
            tree.children.append([])
            tree.leaf.append(-1)
            tree.children[node].append(child)
            centres.append(centre)
            todo.append((child, own))
    tree.centres = np.array(centres)
    return tree


def calibrate(tree: Tree, x: np.ndarray, queries: np.ndarray, k: int, recall: float) -> int:
    """Leaf visits with which sample queries find the part `recall` of their k nearest sample rows.

    queries: numbers of rows of x, the lifted sample; a query's own row does not count.
    """
    leaf = tree.assign(x)
    ranks = []
    for i in queries.tolist():
        q = np.append(x[i, :-1], 0.0)
        score = x @ q
        score[i] = -np.inf
        top = np.argpartition(-score, min(k, len(score) - 1) - 1)[: min(k, len(score) - 1)]
        place = np.zeros(tree.leaves, dtype=np.int64)
        for rank, one in enumerate(tree.order(q)):
            place[one] = rank
        ranks.append(place[leaf[top]])
    ranks = np.sort(np.concatenate(ranks)) if ranks else np.zeros(0, dtype=np.int64)
    return int(ranks[math.ceil(recall * len(ranks)) - 1]) + 1 if len(ranks) else tree.leaves


def lift(x: np.ndarray, radius: float) -> np.ndarray:
    """One more component, so that all rows have length `radius`: then the nearest rows to a
    query lifted by 0 are those with the largest inner products."""
    rest = np.sqrt(np.maximum(0.0, radius * radius - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(v: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    recall: float = 0.96,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The k largest inner products found for each query among all other rows.

    Returns query_id, rank (from 1), vec_id, score: the exact inner product in double
    precision; ties to the smaller vec_id. `is_query` is a condition on `id_col`.

    The tree is fitted on the `sample_rows` rows with the smallest hashed ids, at most, and
    is no larger than they are. Every row is put in a leaf. A query visits leaves best bin
    first: as many as let sample queries find the part `recall` of their nearest rows, and
    on until k other rows have been seen. Neighbouring leaves are searched together, up to
    4096 rows, and a leaf that holds a third of all rows (one vector, many times) in blocks.

    Null, empty, zero or non-finite vectors take no part, nor do rows with a null id or of
    another length than most rows have (the smaller on ties). Rows with the same id count
    once, with the smallest vector. Without rows there is no result; fewer than k other rows
    are all returned.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = materialize(rows, "vectors")
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").head(1)
    result = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return vectors.sparkSession.createDataFrame([], result)
    width, total = widths[0]["width"], widths[0]["count"]
    rows = rows.where(F.size("v") == width)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    radius = math.sqrt(rows.agg(F.max(square)).first()[0])

    sample = rows.orderBy(F.xxhash64(F.lit(11), "vec_id"), "vec_id").limit(sample_rows).toArrow()
    x = lift(matrix(sample.column("v").combine_chunks(), width), radius)
    leaf = max(SAMPLE_LEAF, math.ceil(leaf_rows * len(x) / total))
    tree = fit_tree(x, leaf)
    asked = np.random.default_rng(2).permutation(len(x))[:CALIBRATION_QUERIES]
    visits = calibrate(tree, x, asked, k, recall)
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = shared.value.assign(lift(matrix(batch.column(1), width), radius))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], ["vec_id", "v", "leaf"])

    kind = rows.schema["v"].dataType.simpleString()
    index = materialize(rows.mapInArrow(place, f"vec_id long, v {kind}, leaf int"), "index")
    # One row per leaf: at most sample_rows / SAMPLE_LEAF.
    sizes = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    tree.pack_leaves({r["leaf"]: r["size"] for r in sizes.collect()}, BLOCK_ROWS)
    full = vectors.sparkSession.sparkContext.broadcast(tree)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = full.value
        for batch in batches:
            queries = matrix(batch.column(1), width) if len(batch) else np.zeros((0, width))
            owner, places = [], []
            for i, q in enumerate(queries):
                seen = 0
                wanted: dict[tuple[int, int], list[int]] = {}
                for n, leaf in enumerate(tree.order(np.append(q, 0.0))):
                    if n >= visits and seen > k:
                        break
                    seen += tree.rows.get(leaf, 0)
                    if leaf in tree.pack:
                        wanted.setdefault(tree.pack[leaf], []).append(leaf)
                places += [(pack, block, leaves) for (pack, blocks), leaves in wanted.items() for block in range(blocks)]
                owner += [i] * (len(places) - len(owner))
            at = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([p[0] for p in places], pa.int32()),
                 pa.array([p[1] for p in places], pa.int32()), pa.array([p[2] for p in places], pa.list_(pa.int32()))],
                ["query_id", "q", "pack", "block", "leaves"],
            )

    queries = index.where(is_query).select("vec_id", "v")
    chunks = max(1, math.ceil(queries.count() / CHUNK_QUERIES))
    asked = queries.mapInArrow(visit, f"query_id long, q {kind}, pack int, block int, leaves array<int>")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    packs = vectors.sparkSession.createDataFrame(
        [(leaf, pack, blocks) for leaf, (pack, blocks) in tree.pack.items()], "leaf int, pack int, blocks int"
    )
    stored = index.join(F.broadcast(packs), "leaf").select(
        "leaf", "pack", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), "vec_id", "v",
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    key = ["pack", "block", "chunk"]
    found = stored.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        lambda s, w: _best(s, w, k, width), "query_id long, vec_id long, score double"
    )
    order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _best(stored: pa.Table, wanted: pa.Table, k: int, width: int) -> pa.Table:
    """The k best rows, of the leaves it visits in one block, for each query."""
    empty = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    out = [empty]
    if len(stored) and len(wanted):
        ids = stored.column("vec_id").to_numpy()
        order = np.argsort(ids)
        ids, leaf = ids[order], stored.column("leaf").to_numpy()[order]
        x = matrix(stored.column("v").combine_chunks(), width)[order]
        asked = wanted.column("query_id").to_numpy()
        q = matrix(wanted.column("q").combine_chunks(), width)
        lists = wanted.column("leaves").combine_chunks()
        visitor = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
        visited = lists.flatten().to_numpy()
        for one in np.unique(leaf).tolist():
            rows, who = np.flatnonzero(leaf == one), visitor[visited == one]
            for a in range(0, len(who), 256):
                own = who[a : a + 256]
                # The same sum of products in the same order for every row, so that equal rows tie.
                score = np.einsum("qd,xd->qx", q[own], x[rows], optimize=False)
                score[asked[own][:, None] == ids[rows][None, :]] = -np.inf
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(score, top, axis=1)
                real = value > -np.inf
                out.append((np.broadcast_to(own[:, None], top.shape)[real], ids[rows][top][real], value[real]))
    who, near, value = (np.concatenate(c) for c in zip(*out, strict=True))
    # The k best of all leaves of the block.
    order = np.lexsort((near, -value, who))
    who, near, value = who[order], near[order], value[order]
    start = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else who
    keep = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who)))) < k
    ids = asked[who[keep]] if len(who) else who
    return pa.table(
        [pa.array(ids, pa.int64()), pa.array(near[keep], pa.int64()), pa.array(value[keep], pa.float64())],
        names=["query_id", "vec_id", "score"],
    )
