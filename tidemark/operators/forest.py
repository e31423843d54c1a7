"""Random forests and their cross-validation from binned rows: all folds' forests grow together, one pass a level.

Every feature is cut into at most ``BINS`` bins. A row is kept as its bins, target, fold and a hash, some 20 bytes.
A pass adds up, in each task, one histogram per open node; these are shuffled by tree, and only the chosen splits
reach the driver. How often a row is drawn for a tree follows from the row's hash, so the draws do not depend on
how the rows are partitioned (borders of bins are quantiles to a ten-thousandth of the rows). The method is the library's: the same bins, bootstrap, features per node, impurities,
limits and importances.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil, factorial, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.numeric import double

# Tasks get this code with their work: executors need not have the library installed.
for module in (sys.modules[__name__], numeric):
    cloudpickle.register_pickle_by_value(module)

BINS = 32
# Rows in one stored block, and rows worked on at a time (their arrays fit a core's cache).
BLOCK, STRETCH = 1 << 14, 1 << 16
# Rows of a partition of blocks: some 100 MB.
DEALT = 1 << 22
MAX_CLASSES = 100
# Split number of a node that is not split: every bin is below it, so its rows stay on the left down to the last level.
LEAF = 255
BLOCKS = "n int, bins binary, target binary, fold binary, draw binary"


@dataclass(frozen=True)
class Shape:
    """Size of a forest; ``classes`` is 0 for a regression."""

    trees: int = 30
    depth: int = 8
    least: int = 10
    seed: int = 42

    def tried(self, features: int, classes: int) -> int:
        """Features looked at in each node."""
        return ceil(sqrt(features)) if classes else ceil(features / 3)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: node i has the children 2 i and 2 i + 1; ``value`` belongs to the last level."""

    features: tuple[str, ...]
    classes: int
    edges: tuple[np.ndarray, ...]
    feature: np.ndarray
    split: np.ndarray
    value: np.ndarray
    importances: tuple[float, ...]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Of rows given as one line of bins a feature: the mean over the trees, or the likeliest class."""
        rows, depth = np.arange(bins.shape[1]), self.value.shape[1].bit_length() - 1
        total = np.zeros((bins.shape[1], self.value.shape[2]))
        for feature, split, value in zip(self.feature, self.split, self.value):
            total += value[_descend(bins, rows, feature, split, depth) - (1 << depth)]
        # Rounded, so that classes equally likely stay so whatever the order of the trees; the lowest wins.
        return total.round(9).argmax(axis=1).astype(float) if self.classes else total[:, 0] / len(self.value)

    def transform(self, df: DataFrame) -> DataFrame:
        model = self

        def predicted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                # The only column of a model of one feature comes without a tuple.
                columns = columns if isinstance(columns, tuple) else (columns,)
                yield pd.Series(model.predict(_binned([c.to_numpy() for c in columns], model.edges)))

        guess = F.pandas_udf(predicted, "double")
        return df.withColumn("prediction", guess(*[F.expr(double(f)) for f in self.features]))


def _descend(bins: np.ndarray, rows: np.ndarray, feature: np.ndarray, split: np.ndarray, depth: int) -> np.ndarray:
    """Node of each of the rows after ``depth`` steps from the root."""
    flat, start = bins.ravel(), feature.astype(np.int64) * bins.shape[1]
    node = np.ones(len(rows), np.int64)
    for _ in range(depth):
        right = flat.take(start.take(node) + rows) > split.take(node)
        node += node
        node += right
    return node


def _binned(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left").astype(np.uint8) for c, e in zip(columns, edges)])


@dataclass(frozen=True)
class Summary:
    edges: tuple[np.ndarray, ...]
    rows: int
    in_fold: tuple[int, ...]
    classes: int
    centre: float
    variance: float


def summarize(rows: DataFrame, features: Sequence[str], target: str, fold: str, folds: int, classifier: bool) -> Summary:
    """Bin borders (between all values of a feature with few of them, else at its quantiles), sizes and target."""
    marks = f"array({', '.join(f'{i / BINS!r}D' for i in range(1, BINS))})"
    y = double(target)
    cells = [f"approx_count_distinct({f}) AS n{i}" for i, f in enumerate(features)]
    cells += [f"count_if({fold} = {k}) AS f{k}" for k in range(folds)]
    cells += ["count(*) AS n", f"avg({y}) AS centre", f"var_pop({y}) AS variance", f"min({y}) AS low", f"max({y}) AS high"]
    found = rows.agg(*[F.expr(c) for c in [*cells, f"count_if({y} <> floor({y})) AS odd"]]).first()
    in_fold = tuple(found[f"f{k}"] for k in range(folds))
    for k, own in enumerate(in_fold):
        if not own or own == found["n"]:
            raise ValueError(f"The {'training' if own else 'validation'} data at fold {k} is empty.")
    if classifier and (found["low"] < 0 or found["odd"] or found["high"] >= MAX_CLASSES):
        raise ValueError(f"classes must be whole numbers from 0 to {MAX_CLASSES - 1}")
    # Few by an estimate whose error is far below a half: those are looked at one by one.
    few = [found[f"n{i}"] <= 2 * BINS for i in range(len(features))]
    marked = [f"percentile_approx({double(f)}, {marks}, 10000) AS q{i}" for i, f in enumerate(features)]
    listed = [f"collect_set({double(f)}) AS v{i}" for i, f in enumerate(features) if few[i]]
    # A feature with few values is cheap to rank only where its values turn out to be more than the bins.
    looked = rows.agg(*[F.expr(c) for c in [*listed, *[m for m, f in zip(marked, few) if not f]]]).first()
    wide = [i for i, f in enumerate(few) if f and len(looked[f"v{i}"]) > BINS]
    ranked = rows.agg(*[F.expr(marked[i]) for i in wide]).first() if wide else None
    edges = []
    for i in range(len(features)):
        if few[i] and i not in wide:
            values = np.array(sorted(looked[f"v{i}"]))
            edges.append((values[1:] + values[:-1]) / 2)
        else:
            edges.append(np.unique(np.array((ranked if few[i] else looked)[f"q{i}"], float)))
    classes = int(found["high"]) + 1 if classifier else 0
    centre, variance = (0.0, 1.0) if classifier else (found["centre"], found["variance"])
    return Summary(tuple(edges), found["n"], in_fold, classes, centre, variance)


def _pack(rows: DataFrame, features: Sequence[str], target: str, fold: str, edges: Sequence[np.ndarray]) -> DataFrame:
    """The rows in blocks of binary columns."""
    width = len(features)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for at in range(0, batch.num_rows, BLOCK):
                part = [c[at : at + BLOCK] for c in columns]
                bins = _binned(part[:width], edges)
                cells = [bins, part[width].astype(np.float64), part[width + 1].astype(np.uint8), part[width + 2].astype(np.int64)]
                arrays = [pa.array([bins.shape[1]], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]]
                yield pa.RecordBatch.from_arrays(arrays, ["n", "bins", "target", "fold", "draw"])

    named = [f"{double(f)} AS x{i}" for i, f in enumerate(features)]
    hashed = f"xxhash64({', '.join(rows.columns)}) AS draw"
    return rows.selectExpr(*named, f"{double(target)} AS target", f"{fold} AS fold", hashed).mapInArrow(blocks, BLOCKS)


def _stretches(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bins, target, fold and hash of many rows at a time."""

    def joined(held: list[dict]) -> tuple[np.ndarray, ...]:
        bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(width, -1) for r in held], axis=1)
        rest = (("target", np.float64), ("fold", np.uint8), ("draw", np.uint64))
        return bins, *[np.concatenate([np.frombuffer(r[name], kind) for r in held]) for name, kind in rest]

    held, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            held, size = [*held, row], size + row["n"]
            if size >= STRETCH:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def _poisson() -> np.ndarray:
    """Number of draws (mean 1) for each 16-bit number."""
    below = np.cumsum([np.exp(-1) / factorial(k) for k in range(12)])
    return np.searchsorted(below, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


DRAWS = _poisson()


def _drawn(draw: np.ndarray, salt: int) -> np.ndarray:
    """How often each row is drawn for the tree with this salt."""
    mixed = (draw ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    mixed *= np.uint64(0xC4CEB9FE1A85EC53)
    return DRAWS.take((mixed >> np.uint64(48)).astype(np.int64)).astype(np.float64)


@dataclass
class _Growth:
    """What the tasks of one level need: the trees so far, and features to try in each open node."""

    level: int
    classes: int
    centre: float
    folds: int
    trees: int
    salts: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    # Per tree: place of each node of the level among the open ones, -1 for the others.
    place: np.ndarray
    tried: list[np.ndarray]

    @property
    def cells(self) -> int:
        return self.classes or 3

    def excluded(self, tree: int) -> int:
        """The fold this tree leaves out; the last forest leaves out none."""
        return tree // self.trees

    def histograms(self, batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray]]:
        """Per tree: weights (of each class; or rows, sum and squares) by open node, tried feature, bin."""
        shapes = [(t.shape[1], t.shape[0], BINS, self.cells) for t in self.tried]
        found = [np.zeros(s) if s[1] else None for s in shapes]
        for bins, target, fold, draw in _stretches(batches, width):
            flat, size = bins.ravel(), bins.shape[1]
            y = target - self.centre
            label = target.astype(np.int64) if self.classes else None
            for tree, sums in enumerate(found):
                if sums is None:
                    continue
                weight = _drawn(draw, self.salts[tree])
                if self.excluded(tree) < self.folds:
                    weight *= fold != self.excluded(tree)
                rows = np.flatnonzero(weight)
                node = _descend(bins, rows, self.feature[tree], self.split[tree], self.level) - (1 << self.level)
                place = self.place[tree].take(node)
                if (self.place[tree] < 0).any():
                    kept = place >= 0
                    rows, place = rows[kept], place[kept]
                w = weight.take(rows)
                if self.classes:
                    last, parts = label.take(rows), [w]
                else:
                    moved = w * y.take(rows)
                    last, parts = 0, [w, moved, moved * y.take(rows)]
                groups, stride = self.tried[tree].shape[0], self.classes or 1
                base = place * (BINS * stride) + last
                for j in range(self.tried[tree].shape[1]):
                    start = self.tried[tree][:, j].astype(np.int64) * size
                    key = base + flat.take(start.take(place) + rows).astype(np.int64) * stride
                    for i, part in enumerate(parts):
                        added = np.bincount(key, part, groups * BINS * stride)
                        if self.classes:
                            sums[j] += added.reshape(groups, BINS, stride)
                        else:
                            sums[j, :, :, i] += added.reshape(groups, BINS)
        return ((tree, sums) for tree, sums in enumerate(found) if sums is not None)

    def choose(self, tree: int, sums: np.ndarray, least: int) -> list[dict]:
        """The best split of each open node, if any makes it purer; and what then lies on either side."""
        left = sums.cumsum(axis=2)
        whole = left[:, :, -1:, :]
        right = whole - left
        size = lambda a: a.sum(axis=-1) if self.classes else a[..., 0]
        total = size(whole)
        before, *after = (_impurity(side, self.classes) * size(side) for side in (whole, left, right))
        before, gain = before / np.maximum(total, 1), (before - sum(after)) / np.maximum(total, 1)
        gain[(size(left) < least) | (size(right) < least)] = -1
        rows = []
        for g in range(sums.shape[1]):
            # The gain is rounded, so that equal splits stay equal whatever the order of summation; the first wins.
            best = np.argmax(np.round(gain[:, g] / max(before[0, g, 0], 1e-30), 9))
            j, b = np.unravel_index(best, gain[:, g].shape)
            better = gain[j, g, b] > 1e-9 * before[j, g, 0]
            node = int(np.flatnonzero(self.place[tree] == g)[0]) + (1 << self.level)
            rows.append({
                "tree": tree, "node": node, "feature": int(self.tried[tree][g, j]) if better else -1, "split": int(b),
                "gain": float(gain[j, g, b] * total[j, g, 0]), "whole": whole[j, g, 0].tolist(),
                "below": left[j, g, b].tolist(), "above": right[j, g, b].tolist(),
            })
        return rows


def _impurity(sums: np.ndarray, classes: int) -> np.ndarray:
    """Gini impurity of class weights, or variance from rows, sum and squares."""
    if classes:
        size = np.maximum(sums.sum(axis=-1), 1e-300)
        return 1 - ((sums / size[..., None]) ** 2).sum(axis=-1)
    size = np.maximum(sums[..., 0], 1)
    return np.maximum(sums[..., 2] / size - (sums[..., 1] / size) ** 2, 0)


CHOICES = "tree int, node int, feature int, split int, gain double, whole array<double>, below array<double>, above array<double>"


def _level(blocks: DataFrame, growth: _Growth, width: int, least: int, tasks: int) -> list:
    """Histograms in each task, added up by tree; one row per open node comes back."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, sums in growth.histograms(batches, width):
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for tree, sums in zip(batch["tree"].to_pylist(), batch["sums"]):
                found = np.frombuffer(sums.as_buffer(), np.float64)
                totals[tree] = totals[tree] + found if tree in totals else found.copy()
        for tree, sums in sorted(totals.items()):
            tried = growth.tried[tree]
            shaped = sums.reshape(tried.shape[1], tried.shape[0], BINS, growth.cells)
            rows = growth.choose(tree, shaped, least)
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("split", pa.int32()), ("gain", pa.float64()),
                *[(name, pa.list_(pa.float64())) for name in ("whole", "below", "above")],
            ]))

    measured = blocks.mapInArrow(measure, "tree int, sums binary")
    return measured.repartition(tasks, "tree").mapInArrow(merge, CHOICES).collect()


def _errors(blocks: DataFrame, forests: Sequence[Forest], classes: int) -> dict[int, tuple[int, float]]:
    """Per fold: its rows, and the hits or squared errors on them of the forest that was grown without it."""
    width = len(forests[0].features)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, target, fold, _ in _stretches(batches, width):
            for k, forest in enumerate(forests):
                own = np.flatnonzero(fold == k)
                if len(own):
                    off = forest.predict(np.ascontiguousarray(bins[:, own])) - target[own]
                    score = float((off == 0).sum()) if classes else float((off * off).sum())
                    yield pa.RecordBatch.from_pydict({"fold": pa.array([k], pa.int32()), "n": pa.array([len(own)], pa.int64()), "score": [score]})

    judged = blocks.mapInArrow(judge, "fold int, n bigint, score double")
    sums = judged.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("score").alias("score"))
    return {r.fold: (r.n, r.score) for r in sums.collect()}


def _grow(
    blocks: DataFrame, shape: Shape, features: Sequence[str], known: Summary, folds: int, tasks: int
) -> list[Forest]:
    """One forest without each fold, and one of all rows."""
    classes, centre = known.classes, known.centre
    count, width, last = shape.trees * (folds + 1), len(features), 1 << shape.depth
    random = np.random.default_rng(shape.seed)
    salts = random.integers(0, 1 << 63, count, dtype=np.uint64)
    feature = np.zeros((count, last), np.uint8)
    split = np.full((count, last), LEAF, np.uint8)
    value = np.zeros((count, last, classes or 1))
    gains = np.zeros((count, last))
    # Sums of every node, from which a leaf predicts.
    sums_of: list[dict[int, np.ndarray]] = [{} for _ in range(count)]
    opened = [[1] for _ in range(count)]

    def outcome(tree: int, node: int) -> np.ndarray | float:
        """What a leaf predicts: shares of the classes, or the mean."""
        sums = sums_of[tree][node]
        return sums / max(sums.sum(), 1e-300) if classes else centre + sums[1] / max(sums[0], 1e-300)

    for level in range(shape.depth):
        if not any(opened):
            break
        place = np.full((count, 1 << level), -1, np.int64)
        tried = []
        for tree, nodes in enumerate(opened):
            place[tree, [n - (1 << level) for n in nodes]] = range(len(nodes))
            # Drawn for every node of the level, so that a node's features do not depend on which others are open.
            drawn = np.random.default_rng([shape.seed, tree, level]).random((1 << level, width)).argsort(axis=1)
            tried.append(drawn[[n - (1 << level) for n in nodes], : shape.tried(width, classes)].astype(np.uint8))
        growth = _Growth(level, classes, centre, folds, shape.trees, salts, feature, split, place, tried)
        opened = [[] for _ in range(count)]
        for r in sorted(_level(blocks, growth, width, shape.least, tasks), key=lambda r: (r.tree, r.node)):
            sums_of[r.tree][r.node] = np.array(r.whole)
            if r.feature < 0:
                continue
            feature[r.tree, r.node], split[r.tree, r.node], gains[r.tree, r.node] = r.feature, r.split, r.gain
            for child, sums in ((2 * r.node, np.array(r.below)), (2 * r.node + 1, np.array(r.above))):
                sums_of[r.tree][child] = sums
                if level + 1 < shape.depth and _impurity(sums, classes) > 1e-12 * known.variance:
                    opened[r.tree].append(child)

    is_leaf = lambda tree, node: node >= last or split[tree, node] == LEAF
    for tree, known_sums in enumerate(sums_of):
        for node in sorted(known_sums, reverse=True):
            if not is_leaf(tree, node):
                below, above = 2 * node, 2 * node + 1
                if not (is_leaf(tree, below) and is_leaf(tree, above)):
                    continue
                # A split whose sides predict the same is taken back, as the library does.
                if classes and sums_of[tree][below].argmax() != sums_of[tree][above].argmax():
                    continue
                if not classes and outcome(tree, below) != outcome(tree, above):
                    continue
                feature[tree, node], split[tree, node], gains[tree, node] = 0, LEAF, 0
            # Where the rows of a leaf arrive on the last level.
            value[tree, node * (last >> (node.bit_length() - 1)) - last] = outcome(tree, node)

    forests = []
    for k in range(folds + 1):
        own = slice(k * shape.trees, (k + 1) * shape.trees)
        shares = (gains[own] / np.maximum(gains[own].sum(axis=1, keepdims=True), 1e-300)).ravel()
        weights = np.bincount(feature[own].ravel(), shares, width) / max(shares.sum(), 1e-300)
        forests.append(Forest(tuple(features), classes, known.edges, feature[own], split[own], value[own], tuple(map(float, weights))))
    return forests


def cross_validate(
    rows: DataFrame, features: Sequence[str], target: str, fold: str, folds: int, shape: Shape, classifier: bool, partitions: int | None = None
) -> tuple[float, Forest]:
    """Mean accuracy or RMSE over the folds, each predicted by the forest of the others, and the forest of all rows.

    ``rows`` are complete; equal rows are drawn together, so a column that tells them apart should be among them.
    ``partitions`` deals the blocks of binned rows anew. The driver gets bin borders, and one row per split node.
    """
    known = summarize(rows, features, target, fold, folds, classifier)
    blocks = _pack(rows, features, target, fold, known.edges)
    if partitions:
        blocks = blocks.repartition(max(partitions, -(-known.rows // DEALT)))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    tasks = partitions or rows.sparkSession.sparkContext.defaultParallelism
    try:
        forests = _grow(blocks, shape, features, known, folds, tasks)
        found = _errors(blocks, forests[:folds], known.classes)
    finally:
        blocks.unpersist()
    scores = [found[k][1] / found[k][0] for k in range(folds)]
    return float(np.mean(scores if classifier else np.sqrt(scores))), forests[-1]
