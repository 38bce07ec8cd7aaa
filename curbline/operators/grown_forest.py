"""Forests on many training rows.

Spark's forests add up the statistics of all nodes of a level in every partition, which for deep trees is more than the
rows themselves. Here the tops of all trees grow together, a level per pass over the rows, until a node holds at
most ``LOCAL_ROWS``. The rows of such a node then meet in one group, which grows the rest below it.

Trees are those of Spark's ``RandomForestRegressor`` in all but the random draws: at most ``BINS`` bins a feature, whose
bounds come from a sample, Poisson weights for the bootstrap, splits by the variance they remove, all features tried.
A child holds ``min_leaf`` rows or more. The draws depend on the values of the rows, the seed and the number of the tree only.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.prep import vector_stages
from curbline.session import copy_folder, settle

#: Bins of a feature, rows that their bounds come from, rows of a node that grows in one group, rows of a stored chunk, and
#: nodes of the trees and rows that meet in one task to predict.
BINS, SAMPLE, LOCAL_ROWS, CHUNK_ROWS, HELD_NODES, SLAB_ROWS = 32, 1 << 16, 1 << 16, 1 << 14, 1 << 20, 1 << 20
#: Training rows that are sent to every task, the trees that a task of a search grows then, and most tasks of one forest.
TABLE_ROWS, TREES_PER_TASK, WHOLE_TASKS = 1 << 17, 25, 100
#: Chances of a Poisson draw of mean 1 below 1, 2, ..
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(17)])
#: A split must remove more than this share of the squared labels, and a node with less variance is not split.
LEAST_GAIN = 1e-12


@dataclass
class Tree:
    """Per node the feature that is split, -1 for a leaf, the last bin that goes left, the number of the left child, which
    the right one follows, and the mean label; and per feature what its splits removed of the squared error."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gains: np.ndarray

    FIELDS = {"feature": np.int8, "cut": np.uint8, "left": np.int32, "value": np.float64, "gains": np.float64}

    def packed(self) -> list[bytes]:
        return [getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS.items()]

    @staticmethod
    def unpacked(row: dict) -> Tree:
        return Tree(*(np.frombuffer(row[name], kind) for name, kind in Tree.FIELDS.items()))

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row (column of ``bins``) ends."""
        node, rows = np.zeros(bins.shape[1], np.int32), np.arange(bins.shape[1])
        while rows.size:
            own = node[rows]
            feature = self.feature[own]
            inner = feature >= 0
            rows, own, feature = rows[inner], own[inner], feature[inner]
            node[rows] = self.left[own] + (bins[feature, rows] > self.cut[own])
        return node


_TREE_FIELDS = ", ".join(f"{name} binary" for name in Tree.FIELDS)


def bounds_of(values: np.ndarray) -> np.ndarray:
    """The upper bounds of all bins but the last: between neighbouring values, at about equal numbers of rows where there
    are more than ``BINS`` values."""
    distinct, counts = np.unique(values, return_counts=True)
    between = (distinct[1:] + distinct[:-1]) / 2
    if len(between) < BINS:
        return between
    found, target, so_far = [], len(values) / BINS, np.cumsum(counts)
    for i, (before, now) in enumerate(itertools.pairwise(so_far)):
        if abs(before - target) < abs(now - target):
            found.append(between[i])
            target += len(values) / BINS
    return np.array(found[: BINS - 1])


def best_splits(
    count: np.ndarray, total: np.ndarray, square: np.ndarray, sums: Callable[[int], tuple[np.ndarray, np.ndarray]],
    features: Sequence[int], min_leaf: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature or -1, last bin that goes left, what the split removes) of nodes with these rows, sums of labels and of their
    squares. ``sums`` gives the rows and sums of each bin of a feature."""
    alone = total * total / count
    best, least, every = alone + LEAST_GAIN * square, min_leaf, np.arange(len(count))
    feature, cut = np.full(len(count), -1), np.zeros(len(count), np.int64)
    for f in features:
        rows, labels = (np.cumsum(s, axis=1)[:, :-1] for s in sums(f))
        rest = count[:, None] - rows
        with np.errstate(divide="ignore", invalid="ignore"):
            score = labels * labels / rows + np.square(total[:, None] - labels) / rest
        score[(rows < least) | (rest < least)] = -np.inf
        at = score.argmax(axis=1)
        found = score[every, at]
        better = found > best
        best[better], feature[better], cut[better] = found[better], f, at[better]
    return feature, cut, np.where(feature >= 0, best - alone, 0.0)


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: Sequence[int], min_leaf: int, depth: int) -> Tree:
    """The tree of rows with these bins (feature by row), labels and weights, level by level."""
    width, w = len(sizes), w.astype(np.float64)
    features = [f for f in range(width) if sizes[f] > 1]
    most = 2 * int(w.sum() // max(1, min_leaf)) + 3
    tree = Tree(np.full(most, -1, np.int8), np.zeros(most, np.uint8), np.zeros(most, np.int32), np.zeros(most), np.zeros(width))
    wy = w * y
    wyy = wy * y
    node, ids, nodes = np.zeros(len(y), np.int64), np.array([0]), 1
    count, total, square = (np.array([v.sum()]) for v in (w, wy, wyy))
    tree.value[0] = total[0] / count[0]
    for _ in range(depth if _divisible(count, total, square, min_leaf).all() else 0):
        open_ = len(ids)

        def sums(f: int) -> tuple[np.ndarray, np.ndarray]:
            key = node * sizes[f] + bins[f]
            return tuple(np.bincount(key, v, open_ * sizes[f]).reshape(open_, sizes[f]) for v in (w, wy))

        feature, cut, gain = best_splits(count, total, square, sums, features, min_leaf)
        split = np.flatnonzero(feature >= 0)
        if not split.size:
            break
        tree.gains += np.bincount(feature[split], gain[split], width)
        tree.feature[ids[split]], tree.cut[ids[split]] = feature[split], cut[split]
        tree.left[ids[split]] = nodes + 2 * np.arange(len(split))
        child = np.full(open_, -1)
        child[split] = 2 * np.arange(len(split))
        side = child[node] + (bins[feature[node], np.arange(len(node))] > cut[node])
        inside = child[node] >= 0
        if not inside.all():
            side, bins, w, wy, wyy = side[inside], bins[:, inside], w[inside], wy[inside], wyy[inside]
        count, total, square = (np.bincount(side, v, 2 * len(split)) for v in (w, wy, wyy))
        tree.value[nodes : nodes + 2 * len(split)] = total / count
        more = _divisible(count, total, square, min_leaf)
        ids = nodes + np.flatnonzero(more)
        nodes += 2 * len(split)
        if not ids.size:
            break
        kept = more[side]
        node, bins, w, wy, wyy = (np.cumsum(more) - 1)[side[kept]], bins[:, kept], w[kept], wy[kept], wyy[kept]
        count, total, square = count[more], total[more], square[more]
    return Tree(tree.feature[:nodes], tree.cut[:nodes], tree.left[:nodes], tree.value[:nodes], tree.gains)


def _divisible(count: np.ndarray, total: np.ndarray, square: np.ndarray, min_leaf: int) -> np.ndarray:
    return (count >= 2 * max(1, min_leaf)) & (square - total * total / count > LEAST_GAIN * square)


def bag(seed: int, tree: int, chunk: int, rows: int, bootstrap: bool) -> np.ndarray:
    """How often each row of a chunk is drawn for a tree."""
    if not bootstrap:
        return np.ones(rows, np.uint8)
    draws = np.random.default_rng([seed % (1 << 32), tree, chunk]).random(rows)
    return np.searchsorted(POISSON, draws, side="right").astype(np.uint8)


@dataclass(frozen=True)
class Binned:
    """Stored chunks of training rows (``chunk n bins y``, labels without their mean), the bounds of the bins, and the mean."""

    chunks: DataFrame
    bounds: tuple[tuple[float, ...], ...]
    mean: float
    count: int

    @property
    def sizes(self) -> list[int]:
        return [len(b) + 1 for b in self.bounds]


def _binned(x: np.ndarray, bounds: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins, feature by row, of rows of numbers."""
    return np.stack([np.searchsorted(b, x[:, f], side="left").astype(np.uint8) for f, b in enumerate(bounds)])


def bin_rows(rows: DataFrame) -> Binned:
    """``label`` and ``features`` of training rows in chunks. A row's chunk follows from its values."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    mean, chunks = found["mean"], math.ceil(found["n"] / CHUNK_ROWS)
    listed = rows.select(F.col("label").cast("double").alias("y"), vector_to_array("features").alias("x"))
    placed = listed.withColumn("place", F.xxhash64("y", "x")).withColumn("chunk", F.pmod("place", F.lit(chunks)))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        x = table.column("x").combine_chunks().flatten().to_numpy()
        y = table.column("y").to_numpy() - mean
        return pa.table({"chunk": pa.array([key[0].as_py()]), "n": pa.array([len(y)]), "x": pa.array([x.tobytes()]), "y": pa.array([y.tobytes()])})

    packed = settle(placed.groupBy("chunk").applyInArrow(pack, "chunk long, n long, x binary, y binary"), "forest-rows")
    each = math.ceil(SAMPLE / chunks)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            x = np.frombuffer(row["x"]).reshape(row["n"], -1)
            if row["n"] > each:
                x = x[np.random.default_rng(row["chunk"]).choice(row["n"], each, replace=False)]
            yield pa.RecordBatch.from_pydict({"x": [x.tobytes()]})

    width = len(listed.select("x").first()[0])
    seen = np.concatenate([np.frombuffer(r["x"]).reshape(-1, width) for r in packed.select("chunk", "n", "x").mapInArrow(sample, "x binary").collect()])
    bounds = tuple(tuple(bounds_of(seen[:, f]).tolist()) for f in range(width))

    def bin_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = _binned(np.frombuffer(row["x"]).reshape(row["n"], width), bounds)
                yield pa.RecordBatch.from_pydict({"chunk": [row["chunk"]], "n": [row["n"]], "bins": pa.array([bins.tobytes()], pa.binary()), "y": pa.array([row["y"]], pa.binary())})

    binned = packed.mapInArrow(bin_, "chunk long, n long, bins binary, y binary")
    return Binned(settle(binned, "forest-bins"), bounds, mean, found["n"])


class _Top:
    """The first levels of a tree while they grow. Nodes without a feature are open, or leaves if they are not to be split."""

    def __init__(self, width: int) -> None:
        self.feature, self.cut, self.left, self.value, self.count, self.depth = [-1], [0], [0], [0.0], [math.inf], [0]
        self.done, self.gains = [False], np.zeros(width)

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int8), np.array(self.cut, np.uint8), np.array(self.left, np.int32), np.array(self.value), self.gains)

    def apply(self, found: dict, min_leaf: int, max_depth: int) -> None:
        """The best split of a node, or none."""
        node = found["node"]
        self.value[node], self.count[node] = found["total"] / found["count"], found["count"]
        if found["feature"] < 0 or self.depth[node] >= max_depth:
            self.done[node] = True
            return
        self.feature[node], self.cut[node], self.left[node] = found["feature"], found["cut"], len(self.feature)
        self.gains[found["feature"]] += found["gain"]
        sides = [(found["count_left"], found["total_left"]), (found["count"] - found["count_left"], found["total"] - found["total_left"])]
        for count, total in sides:
            depth = self.depth[node] + 1
            for values, value in zip((self.feature, self.cut, self.left, self.value, self.count, self.depth, self.done),
                                     (-1, 0, 0, total / count, count, depth, depth >= max_depth or count < 2 * min_leaf)):
                values.append(value)


def _bagged(chunks, tops: dict[int, Tree], asked: dict[int, np.ndarray], width: int, seed: int, bootstrap: bool):
    """For every chunk and tree, the drawn rows that lie in the asked nodes: (tree, nodes, bins, labels, weights)."""
    for row in chunks:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(width, row["n"])
        y = np.frombuffer(row["y"])
        for number, top in tops.items():
            w = bag(seed, number, row["chunk"], row["n"], bootstrap)
            drawn = np.flatnonzero(w)
            own = bins[:, drawn]
            node = top.place(own)
            inside = asked[number][node]
            if not inside.all():
                drawn, own, node = drawn[inside], own[:, inside], node[inside]
            if drawn.size:
                yield number, node, own, y[drawn], w[drawn]


def grow_forest(
    rows: DataFrame, folder: str, *, trees: int, min_leaf: int, max_depth: int, bootstrap: bool, seed: int
) -> tuple[str, Binned]:
    """Grows the trees on ``label`` and ``features`` and stores them in ``folder``: a row of node -1 for the top of each, and one
    for what grows below each of its open nodes."""
    spark, binned = rows.sparkSession, bin_rows(rows)
    width, sizes = len(binned.bounds), binned.sizes
    tops = {t: _Top(width) for t in range(trees)}
    for top in tops.values():
        top.count[0] = binned.count
    features = [f for f in range(width) if sizes[f] > 1]
    ends = np.concatenate([[0], np.cumsum(sizes)])

    def large(top: _Top) -> list[int]:
        return [i for i, f in enumerate(top.feature) if f < 0 and not top.done[i] and top.count[i] > LOCAL_ROWS]

    if binned.count <= TABLE_ROWS:
        _grow_whole(binned, tops, folder, min_leaf, max_depth, seed, bootstrap)
        return folder, binned

    while wide := {t: nodes for t, top in tops.items() if (nodes := large(top))}:
        grown = {t: tops[t].tree() for t in wide}
        sent = spark.sparkContext.broadcast((grown, wide))

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grown, wide = sent.value
            asked = {t: np.isin(np.arange(len(tree.feature)), wide[t]) for t, tree in grown.items()}
            place = {t: np.cumsum(a) - 1 for t, a in asked.items()}
            found = {t: np.zeros((len(nodes), 2 * ends[-1] + 1)) for t, nodes in wide.items()}
            chunks = itertools.chain.from_iterable(b.to_pylist() for b in batches)
            for t, node, bins, y, w in _bagged(chunks, grown, asked, width, seed, bootstrap):
                at, many, wy, out = place[t][node], len(wide[t]), w * y, found[t]
                for f in range(width):
                    key = at * sizes[f] + bins[f]
                    for start, v in ((0, w), (ends[-1], wy)):
                        out[:, start + ends[f] : start + ends[f + 1]] += np.bincount(key, v, many * sizes[f]).reshape(many, sizes[f])
                out[:, -1] += np.bincount(at, wy * y, many)
            for t, nodes in wide.items():
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int32()), "sums": [s.tobytes() for s in found[t]],
                })

        def best(key: tuple, table: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(s.as_py()) for s in table.column("sums"))
            rows, labels = (sums[start : start + ends[-1]] for start in (0, ends[-1]))
            of = lambda v, f: v[ends[f] : ends[f + 1]]
            count, total, square = of(rows, 0).sum(), of(labels, 0).sum(), sums[-1]
            feature, cut, gain = best_splits(
                np.array([count]), np.array([total]), np.array([square]), lambda f: (of(rows, f)[None], of(labels, f)[None]), features, min_leaf)
            f, c = int(feature[0]), int(cut[0])
            left = [float(of(v, f)[: c + 1].sum()) if f >= 0 else 0.0 for v in (rows, labels)]
            return pa.table({
                "tree": pa.array([key[0].as_py()], pa.int32()), "node": pa.array([key[1].as_py()], pa.int32()), "feature": pa.array([f], pa.int32()),
                "cut": pa.array([c], pa.int32()), "gain": [float(gain[0])], "count": [float(count)], "total": [float(total)],
                "count_left": [left[0]], "total_left": [left[1]],
            })

        level = binned.chunks.mapInArrow(histograms, "tree int, node int, sums binary").groupBy("tree", "node").applyInArrow(
            best, "tree int, node int, feature int, cut int, gain double, count double, total double, count_left double, total_left double"
        )
        for row in sorted(level.collect(), key=lambda r: (r["tree"], r["node"])):
            tops[row["tree"]].apply(row.asDict(), min_leaf, max_depth)
        sent.unpersist()

    grown = {t: top.tree() for t, top in tops.items()}
    asked = {t: np.array([f < 0 and not done for f, done in zip(top.feature, top.done)]) for t, top in tops.items()}
    depths = {(t, i): d for t, top in tops.items() for i, d in enumerate(top.depth) if asked[t][i]}
    sent = spark.sparkContext.broadcast((grown, asked))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, asked = sent.value
        chunks = itertools.chain.from_iterable(b.to_pylist() for b in batches)
        for t, node, bins, y, w in _bagged(chunks, grown, asked, width, seed, bootstrap):
            order = np.argsort(node, kind="stable")
            own, starts = np.unique(node[order], return_index=True)
            pieces = np.split(order, starts[1:])
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t] * len(own), pa.int32()), "node": pa.array(own, pa.int32()),
                "bins": [bins[:, p].tobytes() for p in pieces], "y": [y[p].tobytes() for p in pieces], "w": [w[p].tobytes() for p in pieces],
            })

    def below(key: tuple, table: pa.Table) -> pa.Table:
        t, node = (k.as_py() for k in key)
        y, w = (np.concatenate([np.frombuffer(v.as_py(), kind) for v in table.column(c)]) for c, kind in (("y", np.float64), ("w", np.uint8)))
        bins = np.concatenate([np.frombuffer(v.as_py(), np.uint8).reshape(width, -1) for v in table.column("bins")], axis=1)
        return _stored([(t, node, _grow_ordered(bins, y, w, sizes, min_leaf, max_depth - depths[t, node]))])

    dealt = binned.chunks.mapInArrow(deal, "tree int, node int, bins binary, y binary, w binary")
    dealt.groupBy("tree", "node").applyInArrow(below, f"tree int, node int, nodes int, {_TREE_FIELDS}").write.parquet(f"{folder}/trees")
    _add_tops(spark, grown, folder)
    sent.unpersist()
    return folder, binned


def _grow_ordered(bins: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: Sequence[int], min_leaf: int, depth: int) -> Tree:
    """The tree of rows that come in any order, on which sums of labels shall not depend."""
    order = np.lexsort((w, y, *bins))
    return grow(bins[:, order], y[order], w[order], sizes, min_leaf, depth)


def _grow_whole(binned: Binned, tops: dict[int, _Top], folder: str, min_leaf: int, max_depth: int, seed: int, bootstrap: bool) -> None:
    """Grows whole trees from ``TABLE_ROWS`` rows at most, which every task gets: the same trees without a shuffle."""
    spark, sizes = binned.chunks.sparkSession, binned.sizes
    roots = {t: top.tree() for t, top in tops.items()}
    sent = spark.sparkContext.broadcast([r.asDict() for r in binned.chunks.orderBy("chunk").collect()])  # bounded by TABLE_ROWS

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in itertools.chain.from_iterable(b.column(0).to_pylist() for b in batches):
            drawn = _bagged(sent.value, {t: roots[t]}, {t: np.ones(1, bool)}, len(sizes), seed, bootstrap)
            _, _, bins, y, w = zip(*drawn)
            tree = _grow_ordered(np.concatenate(bins, axis=1), np.concatenate(y), np.concatenate(w), sizes, min_leaf, max_depth)
            yield from _stored([(t, 0, tree)]).to_batches()

    trees = spark.range(0, len(tops), 1, min(len(tops), WHOLE_TASKS)).mapInArrow(whole, f"tree int, node int, nodes int, {_TREE_FIELDS}")
    trees.write.parquet(f"{folder}/trees")
    _add_tops(spark, roots, folder)


def _add_tops(spark: SparkSession, tops: dict[int, Tree], folder: str) -> None:
    top = _stored([(t, -1, tree) for t, tree in tops.items()])
    spark.createDataFrame(top).select("tree", "node", "nodes", *Tree.FIELDS).write.mode("append").parquet(f"{folder}/trees")


def _stored(trees: list[tuple[int, int, Tree]]) -> pa.Table:
    packed = list(zip(*(tree.packed() for _, _, tree in trees)))
    return pa.table({
        "tree": pa.array([t for t, _, _ in trees], pa.int32()), "node": pa.array([n for _, n, _ in trees], pa.int32()),
        "nodes": pa.array([len(tree.feature) for _, _, tree in trees], pa.int32()),
        **{name: pa.array(column, pa.binary()) for name, column in zip(Tree.FIELDS, packed)},
    })


def _joined(top: Tree, below: dict[int, Tree]) -> Tree:
    """One tree of its top and what grows below the open nodes, whose roots take the places of these nodes."""
    columns = {name: [getattr(top, name).copy()] for name in ("feature", "cut", "left", "value")}
    size = len(top.feature)
    for node, tree in sorted(below.items()):
        shifted = tree.left.astype(np.int64) + size - 1
        for name, values in (("feature", tree.feature), ("cut", tree.cut), ("left", shifted), ("value", tree.value)):
            columns[name][0][node] = values[0]
            columns[name].append(values[1:].astype(columns[name][0].dtype))
        size += len(tree.feature) - 1
    return Tree(*(np.concatenate(c) for c in columns.values()), top.gains)


@dataclass(frozen=True)
class GrownForest:
    """The folder of the trees, their number, the bounds of the bins, the mean label and the feature expressions."""

    folder: str
    trees: int
    bounds: tuple[tuple[float, ...], ...]
    mean: float
    expressions: tuple[str, ...]

    def first(self, trees: int) -> GrownForest:
        """The forest of the first trees."""
        if not 0 < trees <= self.trees:
            raise ValueError(f"no {trees} trees, only {self.trees}")
        return replace(self, trees=trees)

    def _groups(self, stored: DataFrame) -> dict[int, int]:
        """Tree to the number of its group, which has ``HELD_NODES`` nodes at most, or one larger tree."""
        groups: dict[int, int] = {}
        group = held = 0
        for row in stored.groupBy("tree").agg(F.sum("nodes").alias("n")).orderBy("tree").collect():
            if held and held + row["n"] > HELD_NODES:
                group, held = group + 1, 0
            groups[row["tree"]] = group
            held += row["n"]
        return groups

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``. A group of trees meets a slab of rows in one task, and the sums of a row over the groups
        are joined to it."""
        spark, bounds = df.sparkSession, self.bounds
        vectors = PipelineModel(stages=vector_stages(self.expressions)).transform(df)
        numbered = vectors.select(*df.columns, vector_to_array("features").alias("_x"), F.monotonically_increasing_id().alias("_row"))
        rows = settle(numbered, "forest-asked")
        stored = spark.read.parquet(f"{self.folder}/trees").where(F.col("tree") < self.trees)
        slabs = max(1, math.ceil(rows.count() / SLAB_ROWS))
        groups = self._groups(stored)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    row, x = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                    yield pa.RecordBatch.from_pydict({"chunk": row[:1], "ids": [row.tobytes()], "bins": [_binned(x, bounds).tobytes()]})

        def add(key: tuple, chunks: pa.Table, trees: pa.Table) -> pa.Table:
            found, own = sorted(trees.to_pylist(), key=lambda r: (r["tree"], r["node"])), key[0].as_py()
            sums = [0.0] * chunks.num_rows
            bins = [np.frombuffer(b.as_py(), np.uint8).reshape(len(bounds), -1) for b in chunks.column("bins")]
            for _, parts in itertools.groupby(found, key=lambda r: r["tree"]):
                top, *below = parts
                tree = _joined(Tree.unpacked(top), {r["node"]: Tree.unpacked(r) for r in below})
                sums = [so_far + tree.value[tree.place(b)] for so_far, b in zip(sums, bins)]
            ids = chunks.column("ids").to_pylist() if own == 0 else [b""] * len(sums)
            return pa.table({
                "chunk": chunks.column("chunk"), "part": pa.array([own] * len(sums), pa.int32()),
                "ids": pa.array(ids, pa.binary()), "sums": pa.array([v.tobytes() for v in sums], pa.binary()),
            })

        def total(table: pa.Table) -> pa.Table:
            table = table.sort_by("part")  # the first has the ids
            return pa.table({"_row": np.frombuffer(table.column("ids")[0].as_py(), np.int64),
                             "_sum": sum(np.frombuffer(v.as_py()) for v in table.column("sums"))})

        number = spark.createDataFrame(sorted(groups.items()), "tree int, part int")  # a row per tree
        parts = spark.range(max(groups.values()) + 1).select(F.col("id").cast("int").alias("part"))
        asked = rows.select("_row", "_x").mapInArrow(pack, "chunk long, ids binary, bins binary")
        asked = asked.withColumn("slab", F.pmod(F.xxhash64("chunk"), F.lit(slabs))).crossJoin(F.broadcast(parts))
        trees = stored.join(F.broadcast(number), "tree").crossJoin(F.broadcast(spark.range(slabs).withColumnRenamed("id", "slab")))
        sums = asked.groupBy("part", "slab").cogroup(trees.groupBy("part", "slab")).applyInArrow(add, "chunk long, part int, ids binary, sums binary")
        found = sums.groupBy("chunk").applyInArrow(total, "_row long, _sum double")
        predicted = rows.join(found, "_row").withColumn("prediction", F.col("_sum") / self.trees + F.lit(self.mean))
        return predicted.drop("_row", "_x", "_sum")

    def importances(self) -> np.ndarray:
        """Mean over the trees of each feature's share of the squared error removed."""
        total = np.zeros(len(self.bounds))
        stored = SparkSession.active().read.parquet(f"{self.folder}/trees").where(F.col("tree") < self.trees).select("tree", "gains")
        by_tree: dict[int, np.ndarray] = {}
        for row in stored.collect():
            by_tree[row["tree"]] = by_tree.get(row["tree"], 0) + np.frombuffer(row["gains"])
        for tree in sorted(by_tree):
            if by_tree[tree].any():
                total += by_tree[tree] / by_tree[tree].sum()
        return total / total.sum() if total.any() else total

    def save(self, folder: str, spark: SparkSession) -> None:
        copy_folder(spark, f"{self.folder}/trees", f"{folder}/trees")
        meta = {"count": self.trees, "bounds": self.bounds, "mean": self.mean, "expressions": self.expressions}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/meta")

    @staticmethod
    def of(meta: dict, folder: str) -> GrownForest:
        bounds = tuple(map(tuple, meta["bounds"]))
        return GrownForest(folder, meta["count"], bounds, meta["mean"], tuple(meta["expressions"]))


def prefix_errors(
    rows: DataFrame, *, fold: str, trees: Sequence[int], min_leaf: Sequence[int], max_depth: int, seed: int
) -> dict[tuple[int, int, int], dict[bool, float]]:
    """(trees, min_leaf, fold) to the mean squared error with the fold held out, on it and on the other rows, for ``label`` and
    ``features`` of ``TABLE_ROWS`` rows at most: every task gets all of them and grows some trees of one forest. The errors
    after fewer trees are those of the first trees."""
    spark = rows.sparkSession
    found = rows.select(F.col("label").cast("double").alias("y"), vector_to_array("features").alias("x"), F.col(fold).cast("int").alias("fold")).toArrow()
    x, y, folds = found.column("x").combine_chunks().flatten().to_numpy().reshape(found.num_rows, -1), found.column("y").to_numpy(), found.column("fold").to_numpy()
    order = np.lexsort((folds, y, *x.T))  # draws depend on the values of the rows, not on how they are read
    x, y, folds = x[order], (y - y.mean())[order], folds[order]
    some = np.random.default_rng(seed).permutation(len(y))[:SAMPLE]
    bounds = {f: [bounds_of(x[some[folds[some] != f], i]) for i in range(x.shape[1])] for f in np.unique(folds).tolist()}
    ends = sorted(trees)
    starts = [s for low, high in itertools.pairwise([0, *ends]) for s in range(low, high, TREES_PER_TASK)]
    tasks = [(least, f, s, e) for least in sorted(min_leaf) for f in bounds for s, e in itertools.pairwise([*starts, ends[-1]])]
    sent = spark.sparkContext.broadcast((x, y, folds))  # bounded by TABLE_ROWS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, folds = sent.value
        for task in itertools.chain.from_iterable(b.column(0).to_pylist() for b in batches):
            least, left_out, start, end = tasks[task]
            bins, sizes, out = _binned(x, bounds[left_out]), [len(b) + 1 for b in bounds[left_out]], np.zeros(len(y))
            for tree in range(start, end):
                w = bag(seed, tree, 0, len(y), True)
                drawn = np.flatnonzero((w > 0) & (folds != left_out))
                grown = grow(bins[:, drawn], y[drawn], w[drawn], sizes, least, max_depth)
                out += grown.value[grown.place(bins)]
            yield pa.RecordBatch.from_pydict({
                "least": pa.array([least], pa.int32()), "left_out": pa.array([left_out], pa.int32()), "last": pa.array([end], pa.int32()), "sums": [out.tobytes()],
            })

    def errors(key: tuple, table: pa.Table) -> pa.Table:
        _, y, folds = sent.value
        so_far, found, held = np.zeros(len(y)), [], folds == key[1].as_py()
        for row in table.sort_by("last").to_pylist():
            so_far += np.frombuffer(row["sums"])
            if row["last"] in ends:
                wrong = np.square(y - so_far / row["last"])
                found += [(row["last"], row["least"], row["left_out"], side, float(wrong[held == side].mean())) for side in (True, False) if (held == side).any()]
        kinds = {"trees": pa.int32(), "least": pa.int32(), "left_out": pa.int32(), "held": pa.bool_(), "mse": pa.float64()}
        return pa.table({name: pa.array(column, kind) for (name, kind), column in zip(kinds.items(), zip(*found))})

    parts = spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(sums, "least int, left_out int, last int, sums binary")
    scored = parts.groupBy("least", "left_out").applyInArrow(errors, "trees int, least int, left_out int, held boolean, mse double").collect()
    scores: dict[tuple[int, int, int], dict[bool, float]] = {}
    for r in scored:
        scores.setdefault((r["trees"], r["least"], r["left_out"]), {})[r["held"]] = r["mse"]
    return scores
