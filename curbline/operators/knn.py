"""K-nearest-neighbour regression, exact, through a k-d tree that fits on the driver.

The tree's cuts are medians of a sample of the rows, and every row is assigned once to its leaf. Leaves keep the box and
the number of their own rows, so the search is exact wherever the sample's medians lie. A query descends from the top:
the nodes it holds bound the distance of the k-th neighbour from above, and nodes that begin beyond that bound are
dropped before the rest is split. Only rows of the leaves left at the end meet the query: a small
multiple of k wherever the query and the rows lie, as long as ``MOST_LEAVES`` leaves are enough. Query vectors lying
together form a block, which gets the rows of all leaves near one of them, so no pair of query and row is stored.
Neighbours are ranked within the block, once for the largest k; running sums over the rank give the prediction for every
smaller k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.operators.prep import fit_scaler
from curbline.operators.spatial_join import spread_hot_keys
from curbline.session import settle

WEIGHTS = ("uniform", "distance")
#: Rows of a leaf at least; more where k is large, and where there are more rows than the most leaves hold.
LEAST_LEAF, MOST_LEAVES = 8, 1 << 17
#: Rows that the cuts are medians of, about, and queries that descend together.
SAMPLE, TOGETHER = 1 << 20, 1024
#: Training rows, about, below the node whose query vectors form a block, the bits of the most vectors of a block,
#: vectors of a stored partition, and distances in memory at once.
BLOCK_ROWS, BLOCK_BITS, PLACED_ROWS, TOGETHER_CELLS = 512, 9, 1 << 14, 1 << 20


@dataclass(frozen=True)
class KnnModel:
    """Training rows with scaled features ``f0..`` and their ``leaf``, the scaling, and the tree: per node (the root is
    1, the children of i are 2i and 2i + 1) the axis that is cut, -1 for a leaf, and where."""

    rows: DataFrame
    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    k_max: int
    cut_axes: tuple[int, ...] = ()
    cuts: tuple[float, ...] = ()

    @property
    def axes(self) -> list[str]:
        return [f"f{i}" for i in range(len(self.features))]

    def scaled(self, df: DataFrame) -> list[Column]:
        return [
            ((F.expr(c).cast("double") - F.lit(m)) / F.lit(d)).alias(axis)
            for c, m, d, axis in zip(self.features, self.means, self.deviations, self.axes)
        ]


def fit_knn(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    *,
    row_id: str,
    k_max: int,
    fold: str | None = None,
) -> KnnModel:
    """Standard-scale the features, given as column names or expressions (population deviation; 1
    for a constant feature) and keep, per identical feature vector and fold, the ``k_max`` rows
    with the smallest ids. That loses nothing: neighbours are ranked by distance and id, so no
    query can use more of them. Rows without a number for every feature and the target are refused."""
    scaler = fit_scaler(train, features)
    model = KnnModel(train, tuple(features), scaler.means, scaler.deviations, k_max)
    rows = train.select(
        F.col(row_id).alias("id"),
        F.col(target).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
        *model.scaled(train),
    )
    whole = _complete([*model.axes, "y"])
    counts = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(~whole).alias("bad")).collect()
    if incomplete := sum(r["bad"] for r in counts):
        raise ValueError(f"{incomplete} training rows have no number for some feature or {target!r}; fill or drop them first")
    per_fold = [r["n"] for r in counts]
    usable = sum(per_fold) - (max(per_fold) if fold and per_fold else 0)
    if usable < k_max:
        raise ValueError(f"{usable} training rows cannot give {k_max} neighbours")
    same = Window.partitionBy(*model.axes, "fold").orderBy("id")
    kept = settle(
        rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k_max).drop("n"), "knn-rows"
    )
    total = kept.count()
    share = min(1.0, SAMPLE / max(total, 1))
    place = F.pmod(F.xxhash64("id", *model.axes), F.lit(1 << 30)) / float(1 << 30)
    sample = kept.where(place < share).select(*model.axes).toArrow()
    points = np.column_stack([sample.column(a).to_numpy() for a in model.axes])
    leaf_rows = max(LEAST_LEAF, k_max // 4, total / MOST_LEAVES)
    axes, cuts = _grow(points, leaf_rows * share, math.ceil(math.log2(max(2.0, total / leaf_rows))) + 1)
    model = replace(model, cut_axes=tuple(axes.tolist()), cuts=tuple(cuts.tolist()))
    return replace(model, rows=settle(_with_leaf(kept, model), "knn-leaves"))


def _grow(points: np.ndarray, leaf_rows: float, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and place of each node's cut: the median of the axis along which its points spread most. The lower side
    holds what is not above the cut."""
    axes, cuts = np.full(2 << depth, -1), np.zeros(2 << depth)
    open_ = [(1, points)]
    while open_:
        node, own = open_.pop()
        if len(own) <= leaf_rows or node >= 1 << depth:
            continue
        axis = int(np.argmax(np.ptp(own, axis=0)))
        values = own[:, axis]
        cut, largest = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2], values.max()
        if cut == largest:
            lower = values[values < largest]
            if not len(lower):
                continue  # all points are equal
            cut = lower.max()
        axes[node], cuts[node] = axis, cut
        above = values > cut
        open_ += [(2 * node, own[~above]), (2 * node + 1, own[above])]
    return axes, cuts


def _with_leaf(rows: DataFrame, model: KnnModel) -> DataFrame:
    axes, cuts = np.array(model.cut_axes), np.array(model.cuts)
    names = model.axes

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.column_stack([batch.column(n).to_numpy() for n in names])
            node = np.ones(len(points), np.int64)
            while (inner := np.flatnonzero(axes[node] >= 0)).size:
                own = node[inner]
                node[inner] = 2 * own + (points[inner, axes[own]] > cuts[own])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node)], [*batch.schema.names, "leaf"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(assign, f"{fields}, leaf long")


def _complete(columns: Sequence[str]) -> Column:
    """No value is missing or not a number."""
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).isNotNull() & ~F.isnan(c)
    return test


def _neighbours(model: KnnModel) -> DataFrame:
    """The rows that may be neighbours: a row without a fold lies outside none."""
    return model.rows.where(F.col("fold").isNotNull())


@dataclass(frozen=True)
class Nodes:
    """Per node of the tree: the cut axis, the box of its rows, their number, and their number in each fold."""

    axes: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    total: np.ndarray
    folds: dict[int, np.ndarray]


def _tree(model: KnnModel) -> Nodes:
    """The nodes from the rows of the leaves, of which there are ``MOST_LEAVES`` at most, twice that where medians
    do not divide evenly."""
    size, d = len(model.cut_axes), len(model.axes)
    ends = [f(a).alias(f"{n}_{a}") for a in model.axes for n, f in (("lo", F.min), ("hi", F.max))]
    found = _neighbours(model).groupBy("leaf", "fold").agg(F.count(F.lit(1)).alias("n"), *ends).toArrow()
    leaf, fold, n = (found.column(c).to_numpy() for c in ("leaf", "fold", "n"))
    lows, highs, total = np.full((size, d), np.inf), np.full((size, d), -np.inf), np.zeros(size, np.int64)
    for i, a in enumerate(model.axes):
        np.minimum.at(lows[:, i], leaf, found.column(f"lo_{a}").to_numpy())
        np.maximum.at(highs[:, i], leaf, found.column(f"hi_{a}").to_numpy())
    folds = {}
    for f in np.unique(fold).tolist():
        folds[f] = np.zeros(size, np.int64)
        np.add.at(folds[f], leaf[fold == f], n[fold == f])
    np.add.at(total, leaf, n)
    width = size // 4
    while width:  # parents take what their children have, level by level
        own, left, right = slice(width, 2 * width), slice(2 * width, 4 * width, 2), slice(2 * width + 1, 4 * width, 2)
        lows[own] = np.minimum(lows[own], np.minimum(lows[left], lows[right]))
        highs[own] = np.maximum(highs[own], np.maximum(highs[left], highs[right]))
        for counts in (total, *folds.values()):
            counts[own] += counts[left] + counts[right]
        width //= 2
    return Nodes(np.array(model.cut_axes), lows, highs, total, folds)


def _descend(
    points: np.ndarray, folds: np.ndarray | None, nodes: Nodes, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the query, leaf, rows of other folds in it): the leaves that may hold one of the k nearest rows.
    Without ``folds``, one of the k nearest rows outside whichever fold; the rows are then those outside any one."""
    query, node = np.arange(len(points)), np.ones(len(points), np.int64)
    while True:
        usable = nodes.total[node]
        if folds is None:
            held = usable > 0
            usable = usable - np.max([counts[node] for counts in nodes.folds.values()], axis=0)
        else:
            for fold, counts in nodes.folds.items():
                usable = usable - np.where(folds[query] == fold, counts[node], 0)
            held = usable > 0
        query, node, usable = query[held], node[held], usable[held]
        own, low, high = points[query], nodes.lows[node], nodes.highs[node]
        near = np.square(np.maximum(0, np.maximum(low - own, own - high))).sum(axis=1)
        far = np.square(np.maximum(np.abs(own - low), np.abs(own - high))).sum(axis=1)
        order = np.lexsort((far, query))
        query, node, usable, near, far = (v[order] for v in (query, node, usable, near, far))
        # the k-th neighbour is not beyond the far end of the nodes that hold k rows together
        so_far = np.cumsum(usable)
        first = np.searchsorted(query, query, "left")
        so_far -= so_far[first] - usable[first]
        bound = np.full(len(points), np.inf)
        enough = so_far >= k
        np.minimum.at(bound, query[enough], far[enough])
        held = near <= bound[query] * (1 + 1e-9)
        query, node, usable = query[held], node[held], usable[held]
        inner = nodes.axes[node] >= 0
        if not inner.any():
            return query, node, usable
        below = node[inner]
        query = np.concatenate([query[~inner], query[inner], query[inner]])
        node = np.concatenate([node[~inner], 2 * below, 2 * below + 1])


def nearby_leaves(
    model: KnnModel, vectors: DataFrame, tree: Nodes, blocks: Sequence[str] = (), every_fold: bool = False
) -> DataFrame:
    """(query vector, fold, leaf, n): the leaves that may hold one of the ``k_max`` nearest rows. With ``blocks``, the
    columns that name a query's block, only (block, leaf); ``every_fold`` leaves out each fold in turn, not the query's."""
    names, k = [*model.axes, "fold"], model.k_max
    sent = vectors.sparkSession.sparkContext.broadcast(tree)  # bounded by MOST_LEAVES

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                points = np.column_stack([part.column(n).to_numpy() for n in names[:-1]])
                query, leaf, n = _descend(points, None if every_fold else part.column("fold").to_numpy(), sent.value, k)
                if blocks:
                    found = np.unique(np.column_stack([*(part.column(b).to_numpy()[query] for b in blocks), leaf]), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], [*blocks, "leaf"])
                    continue
                columns = [c.take(pa.array(query)) for c in part.columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(leaf), pa.array(n)], [*names, "leaf", "n"])

    if blocks:
        return vectors.select(*names, *blocks).mapInArrow(find, f"{', '.join(f'{b} long' for b in blocks)}, leaf long").distinct()
    fields = ", ".join(f"{a} double" for a in model.axes)
    return vectors.select(*names).mapInArrow(find, f"{fields}, fold int, leaf long, n long")


def _by_block(model: KnnModel, asked: DataFrame, tree: Nodes, every_fold: bool = False):
    """``asked`` (query vectors, ``fold`` and more) cogrouped by block with the training rows near a vector of the block.

    The vectors below one node form a block; where there are many, they form several.
    """
    leaves = np.count_nonzero((tree.axes < 0) & (tree.total > 0))
    levels = max(0, round(math.log2(BLOCK_ROWS * leaves / max(1, tree.total[1]))))
    placed = settle(_with_leaf(asked, model), "knn-asked")
    order, blocks = ["leaf", *model.axes], ["block", "part"]
    ordered = placed.repartitionByRange(max(1, math.ceil(placed.count() / PLACED_ROWS)), *order).sortWithinPartitions(*order)
    placed = settle(
        ordered.withColumns({
            "block": F.shiftright("leaf", levels), "part": F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS),
        }).drop("leaf"), "knn-blocks",
    )
    near = nearby_leaves(model, placed, tree, blocks, every_fold)
    rows = _neighbours(model).withColumnsRenamed({"fold": "row_fold"}).join(near, "leaf").drop("leaf")
    return placed.groupBy(*blocks).cogroup(rows.groupBy(*blocks))


def knn_predict(
    model: KnnModel,
    queries: DataFrame,
    *,
    query_id: str,
    ks: Sequence[int] | None = None,
    weights: Sequence[str] = WEIGHTS,
    fold: str | None = None,
) -> DataFrame:
    """``query_id k weights prediction``. With ``distance`` weights a neighbour counts 1/distance;
    neighbours at distance 0, if any, take all the weight. Equal query vectors are searched
    once. A query with a missing number gets NULL predictions."""
    ks = sorted(set(ks or [model.k_max]))
    unknown = set(weights) - set(WEIGHTS)
    if unknown or ks[-1] > model.k_max:
        raise ValueError(f"weights must be in {WEIGHTS} and k at most {model.k_max}")
    axes = model.axes
    key = [*axes, "fold"]
    asked = queries.select(
        F.col(query_id), *model.scaled(queries), (F.col(fold) if fold else F.lit(-2)).cast("int").alias("fold")
    )
    wanted, schemes = np.array(ks), list(weights)

    def predictions(own: pa.Table, rows: pa.Table) -> pa.Table:
        return _block_predictions(own, rows, axes, wanted, schemes)

    fields = ", ".join(f"{a} double" for a in axes)
    vectors = asked.select(*key).where(_complete(axes) & F.col("fold").isNotNull()).distinct()
    predicted = _by_block(model, vectors, _tree(model)).applyInArrow(
        predictions, f"{fields}, fold int, k int, weights string, prediction double"
    )
    spread, copied = spread_hot_keys(asked.where(_complete(axes)), predicted, key, [query_id])
    answered = spread.join(copied, [*key, "salt"]).select(query_id, "k", "weights", "prediction")
    blanks = F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights"), F.lit(None).cast("double").alias("prediction"))
        for k in ks for w in weights
    ])
    return answered.unionByName(asked.where(~_complete(axes)).select(query_id, F.inline(blanks)))


def knn_fold_errors(
    model: KnnModel, queries: DataFrame, target: str, *, fold: str, ks: Sequence[int], weights: Sequence[str] = WEIGHTS,
    scored: str | None = None,
) -> DataFrame:
    """``left_out k weights held n sse``: number and squared errors of the queries when the rows of one fold are left
    out, for the queries of that fold (``held``) and for the others.

    With ``scored``, a column of folds, each query is only asked with its own ``fold`` left out, and its error counts as
    ``held`` for the fold ``scored``. Only sums leave a block.
    """
    axes, tree, every_fold = model.axes, _tree(model), scored is None
    asked = queries.select(
        *model.scaled(queries), F.col(fold).cast("int").alias("fold"), F.col(scored or fold).cast("int").alias("scored"),
        F.col(target).cast("double").alias("y"),
    ).where(_complete(axes) if every_fold else _complete(axes) & F.col("fold").isNotNull())
    # equal vectors of a fold are searched once
    vectors = asked.groupBy(*axes, "fold", "scored").agg(
        F.count("y").alias("n"), F.avg("y").alias("mean"), F.var_pop("y").alias("spread")
    )
    folds, wanted, schemes = sorted(tree.folds) if every_fold else None, np.array(sorted(set(ks))), list(weights)

    def errors(own: pa.Table, rows: pa.Table) -> pa.Table:
        return _block_errors(own, rows, axes, folds, wanted, schemes)

    blocks = _by_block(model, vectors, tree, every_fold).applyInArrow(
        errors, "left_out int, k int, weights string, held boolean, n long, sse double"
    )
    return blocks.groupBy("left_out", "k", "weights", "held").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"))


def _block_neighbours(
    own: pa.Table, rows: pa.Table, axes: Sequence[str], folds: Sequence[int] | None, k: int
) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Some query vectors of a block at a time: these, the folds left out for each (its own, unless ``folds`` are given),
    and of the rows near them in order the distance, the label and the fold."""
    order = pc.sort_indices(rows, sort_keys=[("id", "ascending")], null_placement="at_start")  # ties go by the id
    rows = rows.take(order)
    y, row_fold = rows.column("y").to_numpy(), rows.column("row_fold").to_numpy()
    step = max(1, TOGETHER_CELLS // max(1, len(y)))
    for at in range(0, own.num_rows, step):
        part = own.slice(at, step)
        square = np.zeros((part.num_rows, len(y)))
        for a in axes:
            square += np.square(part.column(a).to_numpy()[:, None] - rows.column(a).to_numpy()[None, :])
        left_out = part.column("fold").to_numpy()[:, None] if folds is None else np.tile(folds, (part.num_rows, 1))
        picked, distance = _nearest(np.sqrt(square), row_fold, left_out, k)
        yield part, left_out, distance, y[picked], row_fold[picked]


def _block_predictions(own: pa.Table, rows: pa.Table, axes: Sequence[str], ks: np.ndarray, weights: Sequence[str]) -> pa.Table:
    """The predictions of one block of query vectors, from the rows near them."""
    key, parts = [*axes, "fold"], []
    for part, left_out, distance, y, row_fold in _block_neighbours(own, rows, axes, None, int(ks[-1])):
        asked = part.select(key).take(pa.array(np.repeat(np.arange(part.num_rows), len(ks))))
        for scheme, guess in _running_predictions(distance, y, row_fold != left_out, ks, weights).items():
            parts.append(asked.append_column("k", pa.array(np.tile(ks, part.num_rows), pa.int32())).append_column(
                "weights", pa.array([scheme] * asked.num_rows, pa.string())).append_column("prediction", pa.array(guess.ravel())))
    names = [("k", pa.int32()), ("weights", pa.string()), ("prediction", pa.float64())]
    return pa.concat_tables(parts) if parts else pa.schema([*own.select(key).schema, *(pa.field(*n) for n in names)]).empty_table()


def _block_errors(
    own: pa.Table, rows: pa.Table, axes: Sequence[str], folds: Sequence[int] | None, ks: np.ndarray, weights: Sequence[str]
) -> pa.Table:
    """The sums of ``knn_fold_errors`` over one block of query vectors and the rows near them."""
    found: dict[tuple[int, str, bool], list[np.ndarray]] = {}
    for part, left_out, distance, y, row_fold in _block_neighbours(own, rows, axes, folds, int(ks[-1])):
        scored, n, mean, spread = (part.column(c).to_numpy() for c in ("scored", "n", "mean", "spread"))
        for without in left_out.T:
            of = scored if folds is None else without
            for scheme, guess in _running_predictions(distance, y, row_fold != without[:, None], ks, weights).items():
                wrong = n[:, None] * (spread[:, None] + np.square(mean[:, None] - guess))
                for fold in np.unique(of).tolist():
                    for held in (True,) if folds is None else (True, False):
                        asked = (of == fold) & ((scored == fold) == held)
                        sums = found.setdefault((fold, scheme, held), [np.zeros(len(ks), np.int64), np.zeros(len(ks))])
                        sums[0] += n[asked].sum()
                        sums[1] += wrong[asked].sum(axis=0)
    keys = [key for key in found for _ in ks]
    return pa.table({
        "left_out": pa.array([key[0] for key in keys], pa.int32()), "k": pa.array([int(k) for _ in found for k in ks], pa.int32()),
        "weights": pa.array([key[1] for key in keys], pa.string()), "held": pa.array([key[2] for key in keys], pa.bool_()),
        "n": pa.array([int(v) for sums in found.values() for v in sums[0]], pa.int64()),
        "sse": pa.array([float(v) for sums in found.values() for v in sums[1]], pa.float64()),
    })


def _nearest(distance: np.ndarray, row_fold: np.ndarray, left_out: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and distances of each query's nearest rows in order, so many that k lie outside each fold left out."""
    total = distance.shape[1]
    many = min(total, k + k // 2)
    while True:
        if many < total:
            picked = np.sort(np.argpartition(distance, many - 1, axis=1)[:, :many], axis=1)
        else:
            picked = np.broadcast_to(np.arange(total), distance.shape)
        chosen = np.take_along_axis(distance, picked, axis=1)
        # rows as far as the last one may be among those not picked, with a smaller id
        sure = chosen < chosen.max(axis=1, keepdims=True)
        if many == total or all(((row_fold[picked] != f[:, None]) & sure).sum(axis=1).min() >= k for f in left_out.T):
            order = np.argsort(chosen, axis=1, kind="stable")
            return np.take_along_axis(picked, order, axis=1), np.take_along_axis(chosen, order, axis=1)
        many = min(total, 2 * many)


def _running_predictions(
    distance: np.ndarray, y: np.ndarray, keep: np.ndarray, ks: np.ndarray, weights: Sequence[str]
) -> dict[str, np.ndarray]:
    """Per weighting, the predictions of each query (row) for each k, from its kept neighbours in order."""
    at = np.nonzero(keep)[1]
    first = np.concatenate([[0], np.cumsum(keep.sum(axis=1))[:-1]])
    place = at[first[:, None] + ks - 1]

    def so_far(values: np.ndarray) -> np.ndarray:
        return np.take_along_axis(np.cumsum(np.where(keep, values, 0.0), axis=1), place, axis=1)

    out = {}
    if "uniform" in weights:
        out["uniform"] = so_far(y) / ks
    if "distance" in weights:
        exact = np.take_along_axis(distance, at[first][:, None], axis=1) == 0
        w = np.where(exact, distance == 0, 1 / np.where(distance == 0, 1.0, distance))
        out["distance"] = so_far(w * y) / so_far(w)
    return out
