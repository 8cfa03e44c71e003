"""Boosting and forests from counts a bin, grown level by level over rows that are coded once.

Spark's own trees keep every row as objects and look at each feature of each row in every pass. Here a row is a few
bytes: the bins of its numbers and the slots of its categories, small columns packed into one code. A pass over the
blocks of rows counts them by node and code in numpy, tasks return counts, and the splits follow from their sums. No row
leaves its partition and no task returns more than nodes times codes; a forest's counts are summed in a shuffle. Boosting
counts the smaller child of each split only, the other one is the rest of their parent, and the root's rows once for all trees.

The rules are Spark's, so the outcome is its model class: cuts from weighted quantiles of its bounded sample of rows,
all rows in every count, variance gain for boosting, Gini's for a forest with Poisson draws and features drawn a node, the
first of equal gains, the same stop rules, leaf values, residuals and step. Random draws are numpy's.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import ensure_checkpoint_dir, scratch_path

#: Rows of a block; its working arrays stay in a core's cache.
BLOCK_ROWS = 1 << 17
#: Columns are packed together while their codes fit a byte.
PACKED_CODES = 256
#: Trees of a forest that grow at once, and nodes whose counts are shuffled together: memory follows them, not the rows.
TREES_A_PASS = 10
NODES_A_KEY = 32
#: Settings these trees know; a fit with others is Spark's own.
FOREST_SETTINGS = {"numTrees", "maxDepth", "maxBins", "minInstancesPerNode", "seed"}
BOOSTING_SETTINGS = {"maxIter", "stepSize", "maxDepth", "maxBins", "minInstancesPerNode", "seed", "checkpointInterval"}


@dataclass(frozen=True)
class Layout:
    """Cuts of the numeric features, slots of the categorical columns, and which columns share a code."""

    cuts: tuple[np.ndarray, ...]
    sizes: tuple[int, ...]
    groups: tuple[tuple[int, ...], ...]

    @staticmethod
    def of(cuts: Sequence[np.ndarray], sizes: Sequence[int]) -> Layout:
        cells = [len(c) + 1 for c in cuts] + [s + 1 for s in sizes]
        groups: list[list[int]] = []
        for c in sorted(range(len(cells)), key=lambda c: -cells[c]):
            room = (g for g in groups if math.prod(cells[k] for k in g) * cells[c] <= PACKED_CODES)
            found = next(room, None)
            groups.append([c]) if found is None else found.append(c)
        return Layout(tuple(cuts), tuple(sizes), tuple(tuple(g) for g in groups))

    @property
    def cells(self) -> list[int]:
        """Codes of each column; a category unseen in training has the last one."""
        return [len(c) + 1 for c in self.cuts] + [s + 1 for s in self.sizes]

    @property
    def widths(self) -> list[int]:
        return [math.prod(self.cells[c] for c in g) for g in self.groups]

    @property
    def dtype(self):
        return next(t for t in (np.uint8, np.uint16, np.int32) if max(self.widths) - 1 <= np.iinfo(t).max)

    def place(self, column: int) -> tuple[int, int]:
        """Number of a column's group and its place in there."""
        return next((k, g.index(column)) for k, g in enumerate(self.groups) if column in g)

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """(group, row) codes of rows given by column."""
        wide = len(self.cuts)
        out = np.zeros((len(self.groups), len(columns[0])), dtype=self.dtype)
        for k, group in enumerate(self.groups):
            packed = np.zeros(len(columns[0]), dtype=np.int64)
            for c in group:
                own = np.searchsorted(self.cuts[c], columns[c], side="left") if c < wide else columns[c].astype(np.int64)
                packed = packed * self.cells[c] + own
            out[k] = packed
        return out

    def column_codes(self, column: int) -> np.ndarray:
        """The column's own code for every code of its group."""
        k, at = self.place(column)
        shape = [self.cells[c] for c in self.groups[k]]
        return np.unravel_index(np.arange(self.widths[k]), shape)[at]

    def column_counts(self, counts: np.ndarray, column: int) -> np.ndarray:
        """(.., group code) counts summed to (.., column code)."""
        k, at = self.place(column)
        shape = [self.cells[c] for c in self.groups[k]]
        full = counts.reshape(*counts.shape[:-1], *shape)
        others = tuple(counts.ndim - 1 + i for i in range(len(shape)) if i != at)
        return full.sum(axis=others)


def cuts_of(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between neighbouring values, at most bins - 1 of them, by equal shares of weight."""
    values, weights = values[~np.isnan(values)], weights[~np.isnan(values)]
    seen, where = np.unique(values, return_inverse=True)
    if len(seen) < 2:
        return np.zeros(0)
    middle = (seen[:-1] + seen[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    sums = np.cumsum(np.bincount(where, weights=weights))
    stride = sums[-1] / bins
    target, out = stride, []
    for i, m in enumerate(middle):
        if abs(sums[i] - target) < abs(sums[i + 1] - target):
            out.append(m)
            target += stride
    return np.array(out[: bins - 1])


def layout(train: DataFrame, numeric: Sequence[str], sizes: Sequence[int], weights: tuple[float, float], n_rows: int,
           bins: int, seed: int) -> Layout:
    """Cuts from max(bins^2, 10,000) rows, as Spark draws them: candidate thresholds only, all rows are counted."""
    wanted = max(bins * bins, 10_000)
    drawn = train.select("label", *numeric)
    if n_rows > wanted:
        drawn = drawn.sample(False, wanted / n_rows, seed)
    table = drawn.toArrow()  # bounded by the settings
    weight = np.where(table["label"].to_numpy() == 1, weights[1], weights[0])
    bins = min(bins, max(n_rows, 2))
    return Layout.of([cuts_of(table[c].to_numpy().astype(float), weight, bins) for c in numeric], sizes)


def blocks(train: DataFrame, numeric: Sequence[str], slots: Sequence[str], shape: Layout) -> RDD:
    """Rows as blocks (codes, n0): rows of class 0 first, n0 of them. As many partitions as cores: tasks go block by block."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        label = table["label"].to_numpy()
        if not np.isin(label, (0, 1)).all():
            raise ValueError("a training label is neither 0 nor 1")
        codes = shape.codes([table[c].to_numpy().astype(float) for c in (*numeric, *slots)])
        first, second = np.flatnonzero(label == 0), np.flatnonzero(label == 1)
        codes = np.concatenate([codes[:, first], codes[:, second]], axis=1)
        return pa.RecordBatch.from_pydict({"codes": pa.array([codes.tobytes()], pa.binary()), "n0": pa.array([len(first)], pa.int64())})

    groups, dtype = len(shape.groups), shape.dtype
    found = train.select("label", *numeric, *slots).mapInArrow(coded, "codes binary, n0 long").rdd
    cores = train.sparkSession.sparkContext.defaultParallelism
    return found.map(lambda r: (np.frombuffer(r[0], dtype=dtype).reshape(groups, -1), r[1])).coalesce(cores)


@dataclass(frozen=True)
class Walk:
    """Where rows go: for every node the group it looks at and, by code, the next node; a leaf leads to itself."""

    group: np.ndarray
    following: np.ndarray  # (node, code)

    def step(self, codes: np.ndarray, node: np.ndarray | None) -> np.ndarray:
        n = codes.shape[1]
        if node is None:  # all in the root
            return self.following[0].take(codes[self.group[0]])
        seen = codes.reshape(-1).take(self.group.take(node) * n + np.arange(n))
        return self.following.reshape(-1).take(node * self.following.shape[1] + seen)


#: Levels of splits whose turns fit a word, a bit a split of a full tree.
WORD_LEVELS = 6


@dataclass(frozen=True)
class Descent:
    """Where rows lie some levels below the root: a place each, and the node of every place (-1 where no row comes).

    A code sets the bits of those splits of its group that send it right, in the order of a full tree; the bits of all
    groups together lead a row down by arithmetic, and below a leaf to the left. Deeper trees walk from node to node.
    """

    depth: int
    bits: tuple[tuple[int, np.ndarray], ...]
    nodes: np.ndarray
    walk: Walk | None = None

    def places(self, codes: np.ndarray) -> np.ndarray:
        if self.walk is not None:
            node = None
            for _ in range(self.depth):
                node = self.walk.step(codes, node)
            return node
        if not self.bits:
            return np.zeros(codes.shape[1], dtype=np.int64)
        turns = None
        for k, bits in self.bits:
            own = bits.take(codes[k])
            turns = own if turns is None else np.bitwise_or(turns, own, out=turns)
        place = turns & 1
        for level in range(1, self.depth):
            own = turns >> (place + ((1 << level) - 1))
            own &= 1
            place <<= 1
            place |= own
        return place.view(np.int64) if place.dtype == np.uint64 else place  # an index must fit a signed number


class Tree:
    """A tree as it grows: nodes in the order made, each (depth, statistics, split, children)."""

    def __init__(self, shape: Layout):
        self.shape = shape
        self.depth, self.split, self.children, self.stats, self.rows, self.gain = [0], [None], [None], [None], [0], [-1.0]

    def divide(self, node: int, split: tuple) -> tuple[int, int]:
        """Give a node two children; the split is (feature, column, threshold or left value, codes that go left)."""
        made = (len(self.depth), len(self.depth) + 1)
        for _ in made:
            for held, value in ((self.depth, self.depth[node] + 1), (self.split, None), (self.children, None), (self.stats, None),
                                (self.rows, 0), (self.gain, -1.0)):
                held.append(value)
        self.split[node], self.children[node] = split, made
        return made

    def set_classes(self, node: int, rows: np.ndarray, weights: tuple[float, float]) -> None:
        """A node's statistics are the weights of its classes."""
        self.stats[node], self.rows[node] = (weights[0] * rows[0], weights[1] * rows[1]), int(rows.sum())

    def prune(self) -> None:
        """Two leaves of the same class become one, from the bottom up, as in Spark."""
        for node in reversed(range(len(self.depth))):
            made = self.children[node]
            if made and not any(self.children[c] for c in made) and len({self.stats[c][1] > self.stats[c][0] for c in made}) == 1:
                self.children[node], self.split[node], self.gain[node] = None, None, -1.0

    def level_table(self, nodes: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, first child or -1, goes right by code) of these nodes; the last entry stands for all others."""
        group, child = np.zeros(len(nodes) + 1, dtype=np.int64), np.full(len(nodes) + 1, -1, dtype=np.int64)
        right = np.zeros((len(nodes) + 1, max(self.shape.widths)), dtype=bool)
        for i, node in enumerate(nodes):
            if self.split[node] is not None:
                _, column, _, goes_left = self.split[node]
                group[i], child[i] = self.shape.place(column)[0], self.children[node][0]
                right[i, : self.shape.widths[group[i]]] = ~goes_left[self.shape.column_codes(column)]
        return group, child, right

    def walk(self) -> Walk:
        group = np.zeros(len(self.depth), dtype=np.int64)
        following = np.repeat(np.arange(len(self.depth), dtype=np.int64)[:, None], max(self.shape.widths), axis=1)
        for node, split in enumerate(self.split):
            if split is not None:
                _, column, _, goes_left = split
                group[node] = self.shape.place(column)[0]
                left = goes_left[self.shape.column_codes(column)]
                following[node, : len(left)] = np.where(left, *self.children[node])
        return Walk(group, following)

    def descent(self, depth: int) -> Descent:
        if depth > WORD_LEVELS:
            return Descent(depth, (), np.arange(len(self.depth)), self.walk())
        word = np.uint32 if depth < WORD_LEVELS else np.uint64
        bits: dict[int, np.ndarray] = {}
        nodes = np.full(1 << depth, -1, dtype=np.int64)
        waiting = [(0, 0)]  # nodes and their place among those of their level
        while waiting:
            node, place = waiting.pop()
            level = self.depth[node]
            if level == depth or self.split[node] is None:
                nodes[place << (depth - level)] = node
                continue
            _, column, _, goes_left = self.split[node]
            k = self.shape.place(column)[0]
            right = (~goes_left[self.shape.column_codes(column)]).astype(word)
            held = bits.setdefault(k, np.zeros(self.shape.widths[k], dtype=word))
            held |= right << word((1 << level) - 1 + place)
            waiting += [(child, 2 * place + i) for i, child in enumerate(self.children[node])]
        return Descent(depth, tuple(bits.items()), nodes)


def best_splits(
    shape: Layout, rows: list[np.ndarray], weight: list[np.ndarray], totals: Sequence[list[np.ndarray]], least: int,
    allowed: np.ndarray | None = None,
) -> list[tuple | None]:
    """Best split of each node, from (node, code) sums a group; None where none is allowed or gains.

    (gain, feature, column, threshold or left value, codes that go left). A slot is a category of its own, there or not.
    The gain is that of variance, given sums of the target, or of Gini's impurity, given weights of each class.
    `allowed` are the features a node may use, (node, feature).
    """
    n_nodes = rows[0].shape[0]
    all_rows, all_w = (x[0].sum(axis=1, keepdims=True) for x in (rows, weight))
    all_s = [t[0].sum(axis=1, keepdims=True) for t in totals]
    gains, made = [], []
    offset = len(shape.cuts)
    for c, cells in enumerate(shape.cells):
        k = shape.place(c)[0]
        found = [shape.column_counts(x[k], c) for x in (rows, weight, *totals)]
        n, w, *sums = (np.cumsum(x, axis=1)[:, :-1] if c < len(shape.cuts) else x[:, :-1] for x in found)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = sum((s * s / w + (a - s) ** 2 / (all_w - w) - a * a / all_w) / all_w for s, a in zip(sums, all_s, strict=True))
            lower = sums[-1] / w < (all_s[-1] - sums[-1]) / (all_w - w)
        fits = (n >= least) & (all_rows - n >= least)
        if allowed is not None:
            fits &= allowed[:, [c]] if c < len(shape.cuts) else allowed[:, offset : offset + cells - 1]
        gain = np.where(fits, gain, -np.inf)
        gains.append(gain)
        if c < len(shape.cuts):
            made += [(c, c, b, None) for b in range(cells - 1)]
        else:
            made += [(offset + b, c, b, lower[:, b]) for b in range(cells - 1)]
            offset += cells - 1
    if not made:
        return [None] * n_nodes
    gains = np.concatenate(gains, axis=1)
    out: list[tuple | None] = []
    for node, at in enumerate(gains.argmax(axis=1)):
        gain = float(gains[node, at])
        if not gain > 0:
            out.append(None)
            continue
        feature, column, b, lower = made[at]
        codes = np.arange(shape.cells[column])
        if lower is None:
            out.append((gain, feature, column, float(shape.cuts[column][b]), codes <= b))
        else:
            value = 1.0 if lower[node] else 0.0
            out.append((gain, feature, column, value, (codes == b) == bool(value)))
    return out


def _summed(held: RDD, count: Callable) -> list[np.ndarray]:
    """Arrays of a block added up over all blocks; a task returns one set."""

    def of_task(part):
        total = None
        for block in part:
            found = count(block)
            total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            yield total

    return held.mapPartitions(of_task).reduce(lambda a, b: [x + y for x, y in zip(a, b, strict=True)])


def _residual(odds: np.ndarray | None, n: int, n0: int, weights: tuple[float, float] = (1.0, 1.0)) -> np.ndarray:
    """What the trees so far leave, times the class's weight: the label as -1 or 1, then 4y / (1 + exp(2y * margin)).

    `odds` is that exponential.
    """
    signed = -weights[0], weights[1]
    out = np.empty(n) if odds is None else 1.0 + odds
    for y, part in zip(signed, (out[:n0], out[n0:]), strict=True):
        if odds is None:
            part[:] = y
        else:
            np.divide(4.0 * y, part, out=part)
    return out


def _rooted(widths: Sequence[int], weights: tuple[float, float], first: bool) -> Callable:
    """Weighted residual sums of all rows by code, a group each, after the rows of each class for the first tree.

    Last what the tree before left in its leaves.
    """

    def count(block) -> list[np.ndarray]:
        codes, n0, odds, told = block
        r = _residual(odds, codes.shape[1], n0, weights)
        out = []
        for k, width in enumerate(widths):
            if first:
                out += [np.bincount(part, minlength=width)[None, :] for part in (codes[k, :n0], codes[k, n0:])]
            out.append(np.bincount(codes[k], weights=r, minlength=width)[None, :])
        return out if told is None else [*out, told]

    return count


def _counted(descent: Descent, slot: np.ndarray, n_slots: int, widths: Sequence[int], weights: tuple[float, float]) -> Callable:
    """Rows a class and weighted residual sums by slot and code, a group each, of the rows that lie in a slot.

    `slot` has that of each place, or n_slots where rows are not counted.
    """

    def count(block) -> list[np.ndarray]:
        codes, n0, odds, _ = block
        seats = slot.take(descent.places(codes))
        here = np.flatnonzero(seats < n_slots)
        seats, middle = seats.take(here), int(here.searchsorted(n0))
        r = _residual(None if odds is None else odds.take(here), len(here), middle, weights)
        out = []
        for k, width in enumerate(widths):
            at, size = seats * width, n_slots * width
            at += codes[k].take(here)
            for found in (np.bincount(at[:middle], minlength=size), np.bincount(at[middle:], minlength=size),
                          np.bincount(at, weights=r, minlength=size)):
                out.append(found.reshape(-1, width))
        return out

    return count


def _passed(descent: Descent, factor: np.ndarray) -> Callable:
    """Blocks after a tree: each row's odds times its leaf's factor, beside rows, sums and squares a class and leaf."""
    reached = np.flatnonzero(descent.nodes >= 0)
    leaves = descent.nodes[reached]
    by_place = np.ones((2, len(descent.nodes)))
    by_place[:, reached] = factor[:, leaves]

    def update(block):
        codes, n0, odds, _ = block
        n, size = codes.shape[1], by_place.shape[1]
        place = descent.places(codes).astype(np.int64)
        r = _residual(odds, n, n0)
        told = np.zeros((2, 3, factor.shape[1]))
        new = np.empty(n)
        for label, part in enumerate((slice(0, n0), slice(n0, n))):
            here, left = place[part], r[part]
            found = [np.bincount(here, minlength=size), np.bincount(here, weights=left, minlength=size),
                     np.bincount(here, weights=left * left, minlength=size)]
            told[label][:, leaves] = np.array(found)[:, reached]
            new[part] = by_place[label].take(here)
        if odds is not None:
            new *= odds
        return codes, n0, new, told

    return update


def _with_rest(found: list[np.ndarray], parents: list[np.ndarray], left_counted: np.ndarray) -> list[np.ndarray]:
    """A group's rows a class and sums of both children, left before right, from those of the counted child and the parent."""
    out = []
    for own, both in zip(found, parents, strict=True):
        rest = both - own
        if len(out) == 2:
            rest[(parents[0] == found[0]) & (parents[1] == found[1])] = 0.0  # no rows, no sum
        at = left_counted[:, None, None]
        out.append(np.where(at, np.stack([own, rest], axis=1), np.stack([rest, own], axis=1)).reshape(-1, own.shape[1]))
    return out


def boosting(train: DataFrame, numeric: Sequence[str], slots: Sequence[str], sizes: Sequence[int], weights: tuple[float, float],
             n_rows: int, params: dict) -> list[tuple[Tree, float]]:
    """Trees with their weights. `train` has the label, numbers and slots; `weights` are those of the classes."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    shape = layout(train, numeric, sizes, weights, n_rows, params["maxBins"], params["seed"])
    w0, w1 = weights
    widths = shape.widths
    held = StorageLevel.MEMORY_AND_DISK_DESER  # blocks are bytes: a serialized store would copy and compress them in every pass
    state = blocks(train, numeric, slots, shape).map(lambda b: (*b, None, None)).persist(held)
    made: list[tuple[Tree, float]] = []
    older, kept = None, []
    roots: list[list[np.ndarray]] = []  # rows a class by code, a group each: the same for every tree
    try:
        for turn in range(params["maxIter"]):
            tree = Tree(shape)
            open_nodes, counted, left_counted = [0], [0], np.zeros(0, dtype=bool)
            by_group: list[list[np.ndarray]] = []
            for depth in range(params["maxDepth"]):
                if depth == 0:
                    found = _summed(state, _rooted(widths, weights, not made))
                    if made:
                        _finish(made[-1][0], found[-1], weights)
                        older.unpersist()
                        kept = _drop_checkpoints(spark, kept, state)
                    else:
                        roots = [[a.astype(float) for a in found[3 * k : 3 * k + 2]] for k in range(len(widths))]
                    by_group = [[*rows, found[k] if made else found[3 * k + 2]] for k, rows in enumerate(roots)]
                else:
                    descent = tree.descent(depth)
                    seat = np.full(len(tree.depth) + 1, len(counted), dtype=np.int64)  # the last for places without rows
                    seat[counted] = np.arange(len(counted))
                    found = _summed(state, _counted(descent, seat[descent.nodes], len(counted), widths, weights))
                    by_group = [_with_rest(found[3 * k : 3 * k + 3], parents[k], left_counted) for k in range(len(widths))]
                rows = [g[0] + g[1] for g in by_group]
                weight = [w0 * g[0] + w1 * g[1] for g in by_group]
                total = [g[2] for g in by_group]
                following, counted, left_counted, divided = [], [], [], []
                splits = best_splits(shape, rows, weight, [total], params["minInstancesPerNode"])
                for i, (node, best) in enumerate(zip(open_nodes, splits, strict=True)):
                    tree.stats[node] = (weight[0][i].sum(), total[0][i].sum())
                    if best is not None:
                        children = tree.divide(node, best[1:])
                        following += children
                        tree.gain[node] = best[0]
                        column = best[2]
                        k, goes_left = shape.place(column)[0], best[4][shape.column_codes(column)]
                        for child, part in zip(children, (goes_left, ~goes_left), strict=True):
                            tree.stats[child] = tuple(x[k][i, part].sum() for x in (weight, total))
                        left_counted.append(rows[k][i, goes_left].sum() <= rows[k][i, ~goes_left].sum())
                        counted.append(children[0] if left_counted[-1] else children[1])
                        divided.append(i)
                left_counted = np.array(left_counted, dtype=bool)
                parents = [[a[divided] for a in g] for g in by_group]
                open_nodes = following
                if not open_nodes:
                    break
            step = 1.0 if turn == 0 else params["stepSize"]
            value = np.array([s / w for w, s in tree.stats])
            with np.errstate(over="ignore"):
                factor = np.exp(np.array([[-2.0], [2.0]]) * step * value)
            passed = _passed(tree.descent(params["maxDepth"]), factor)
            older, state = state, state.map(passed).persist(held)
            done, every = turn + 1, params["checkpointInterval"]
            if every > 0 and done % every == 0 and done < params["maxIter"]:
                state.checkpoint()
            made.append((tree, step))
        _finish(made[-1][0], _summed(state, lambda block: [block[3]])[0], weights)
        _drop_checkpoints(spark, kept, None)
    finally:
        state.unpersist()
        if older is not None:
            older.unpersist()
    return made


def _drop_checkpoints(spark: SparkSession, kept: list[str], state: RDD | None) -> list[str]:
    """Delete checkpoints that a later one replaces, as Spark's own boosting does; those that are kept."""
    newest = state.getCheckpointFile() if state is not None else None
    if state is not None and newest is None:
        return kept
    for name in kept:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)
    return [newest] if newest else []


def _finish(tree: Tree, told: np.ndarray, weights: tuple[float, float]) -> None:
    """Statistics (weight, sum, squares) and rows of every node from those of the leaves."""
    w0, w1 = weights
    stats, rows = (w0 * told[0] + w1 * told[1]).T.copy(), (told[0, 0] + told[1, 0]).copy()
    for node in reversed(range(len(tree.depth))):
        if tree.children[node] is not None:
            left, right = tree.children[node]
            stats[node], rows[node] = stats[left] + stats[right], rows[left] + rows[right]
    tree.stats, tree.rows = [tuple(s) for s in stats], rows.astype(int).tolist()


def _bagged(trees: Sequence[int], seed: int, wide: bool) -> Callable:
    """Blocks with how often each tree draws each row, Poisson with mean 1, and the node it lies in there."""

    def start(partition: int, part):
        for ordinal, (codes, n0) in enumerate(part):
            n = codes.shape[1]
            drawn = [np.random.default_rng([seed, partition, ordinal, t]).poisson(1.0, n).astype(np.uint8) for t in trees]
            yield codes, n0, drawn, [np.zeros(n, dtype=np.int32 if wide else np.uint16) for _ in trees]

    return start


def _drawn_counts(slots: Sequence[np.ndarray], n_open: Sequence[int], widths: Sequence[int]) -> Callable:
    """A task's drawn rows by class, open node and code, a group each, as ((tree, first node), arrays)."""

    def count(part):
        totals: dict[int, list[np.ndarray]] = {}
        for codes, n0, drawn, nodes in part:
            n = codes.shape[1]
            for t, many in enumerate(n_open):
                if not many:
                    continue
                held = totals.setdefault(t, [np.zeros((2, many + 1, width)) for width in widths])
                place, times = slots[t].take(nodes[t]), drawn[t].astype(float)
                for k, width in enumerate(widths):
                    at = place * width + codes[k]
                    for label, rows in enumerate((slice(0, n0), slice(n0, n))):
                        held[k][label] += np.bincount(at[rows], weights=times[rows], minlength=(many + 1) * width).reshape(-1, width)
        for t in list(totals):
            held = totals.pop(t)
            for first in range(0, n_open[t], NODES_A_KEY):
                yield (t, first), [a[:, first : min(first + NODES_A_KEY, n_open[t])].copy() for a in held]

    return count


def _chosen(shape: Layout, trees: Sequence[int], open_nodes: Sequence[Sequence[int]], weights: tuple[float, float], params: dict,
            per_node: int) -> Callable:
    """From counts ((tree, first node), arrays) the split of each node: (tree, node, split, rows a class, of those left)."""
    n_features = len(shape.cuts) + sum(shape.sizes)

    def choose(entry):
        (t, first), counts = entry
        nodes = open_nodes[t][first : first + counts[0].shape[1]]
        allowed = np.zeros((len(nodes), n_features), dtype=bool)
        for i, node in enumerate(nodes):
            drawn = np.random.default_rng([params["seed"], trees[t], node]).permutation(n_features)[:per_node]
            allowed[i, drawn] = counts[0][:, i].sum(axis=1).all()  # a node of one class stays a leaf
        classes = [[w * a[label] for a in counts] for label, w in enumerate(weights)]
        splits = best_splits(shape, [a.sum(axis=0) for a in counts], [a + b for a, b in zip(*classes, strict=True)], classes,
                             params["minInstancesPerNode"], allowed)
        out = []
        for i, split in enumerate(splits):
            left = None
            if split is not None:
                k, goes_left = shape.place(split[2])[0], split[4][shape.column_codes(split[2])]
                left = counts[k][:, i][:, goes_left].sum(axis=1)
            out.append((t, nodes[i], split, counts[0][:, i].sum(axis=1), left))
        return out

    return choose


def _moved(slots: Sequence[np.ndarray], tables: Sequence[tuple | None]) -> Callable:
    """Blocks with each tree's rows one level further down; `tables` are (group, first child, goes right by code) of open nodes."""

    def step(block):
        codes, n0, drawn, nodes = block
        every, out = np.arange(codes.shape[1]), []
        for t, table in enumerate(tables):
            if table is None:
                out.append(nodes[t])
                continue
            group, child, right = table
            place = slots[t].take(nodes[t])
            seen = codes.reshape(-1).take(group.take(place) * len(every) + every)
            to = child.take(place)
            out.append(np.where(to < 0, nodes[t], to + right.reshape(-1).take(place * right.shape[1] + seen)).astype(nodes[t].dtype))
        return codes, n0, drawn, out

    return step


def forest(train: DataFrame, numeric: Sequence[str], slots: Sequence[str], sizes: Sequence[int], weights: tuple[float, float],
           n_rows: int, params: dict) -> list[tuple[Tree, float]]:
    """Trees with weight 1, each on its own draw of all rows, with ceil(sqrt(features)) features a node; TREES_A_PASS at once."""
    sc = train.sparkSession.sparkContext
    shape = layout(train, numeric, sizes, weights, n_rows, params["maxBins"], params["seed"])
    n_features = len(numeric) + sum(sizes)
    per_node = n_features if params["numTrees"] == 1 else math.ceil(math.sqrt(n_features))
    held = blocks(train, numeric, slots, shape).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list[Tree] = []
    alive: list[RDD] = [held]
    try:
        for begin in range(0, params["numTrees"], TREES_A_PASS):
            numbers = range(begin, min(begin + TREES_A_PASS, params["numTrees"]))
            made = [Tree(shape) for _ in numbers]
            state = held.mapPartitionsWithIndex(_bagged(numbers, params["seed"], params["maxDepth"] > 14)).persist(StorageLevel.MEMORY_AND_DISK)
            alive.append(state)
            open_nodes = [[0] for _ in made]
            for depth in range(params["maxDepth"]):
                places = []
                for tree, nodes in zip(made, open_nodes, strict=True):
                    place = np.full(len(tree.depth), len(nodes), dtype=np.int64)
                    place[nodes] = np.arange(len(nodes))
                    places.append(place)
                counts = state.mapPartitions(_drawn_counts(places, [len(n) for n in open_nodes], shape.widths))
                summed = counts.reduceByKey(lambda a, b: [x + y for x, y in zip(a, b, strict=True)], sc.defaultParallelism)
                found = summed.flatMap(_chosen(shape, numbers, open_nodes, weights, params, per_node)).collect()  # a row a node
                if depth:
                    alive.pop(-2).unpersist()
                following: list[list[int]] = [[] for _ in made]
                for t, node, split, classes, left in sorted(found, key=lambda f: f[:2]):
                    tree = made[t]
                    tree.set_classes(node, classes, weights)
                    if split is not None:
                        children = tree.divide(node, split[1:])
                        tree.gain[node] = split[0]
                        for child, rows in zip(children, (left, classes - left), strict=True):
                            tree.set_classes(child, rows, weights)
                        following[t] += children
                if depth + 1 == params["maxDepth"] or not any(following):
                    break
                tables = [tree.level_table(nodes) if more else None for tree, nodes, more in zip(made, open_nodes, following, strict=True)]
                state = state.map(_moved(places, tables)).persist(StorageLevel.MEMORY_AND_DISK)
                alive.append(state)
                open_nodes = following
            while len(alive) > 1:
                alive.pop().unpersist()
            for tree in made:
                tree.prune()
            grown += made
    finally:
        for rdd in alive:
            rdd.unpersist()
    return [(tree, 1.0) for tree in grown]


NODE_SCHEMA = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _stored(number: int, tree: Tree) -> list[tuple]:
    """Nodes in Spark's stored form, numbered from the root down, left before right."""
    ids: dict[int, int] = {}
    order, waiting = [], [0]
    while waiting:
        node = waiting.pop()
        ids[node] = len(order)
        order.append(node)
        if tree.children[node] is not None:
            waiting += reversed(tree.children[node])
    out = []
    for node in order:
        stats = [float(x) for x in tree.stats[node]]
        if len(stats) == 2:
            w = sum(stats)
            impurity = 1.0 - (stats[0] / w) ** 2 - (stats[1] / w) ** 2 if w else 0.0
            prediction = float(stats[1] > stats[0])
        else:
            w, s, q = stats
            impurity, prediction = ((q - s * s / w) / w, s / w) if w else (0.0, 0.0)
        inner = tree.children[node] is not None
        split = (-1, [], -1)
        if inner:
            feature, column, value, _ = tree.split[node]
            split = (feature, [value], -1 if column < len(tree.shape.cuts) else 2)
        left, right = (ids[c] for c in tree.children[node]) if inner else (-1, -1)
        out.append((number, (ids[node], prediction, impurity, stats, tree.rows[node], tree.gain[node], left, right, split)))
    return out


def stored_model(spark: SparkSession, estimator, trees: Sequence[tuple[Tree, float]], n_features: int):
    """Spark's model of these trees, by its stored form; the estimator gives its settings and tells boosting from a forest."""
    path = scratch_path(spark, "trees")
    made, kind, more = GBTClassificationModel, "regression.DecisionTreeRegressionModel", {}
    if isinstance(estimator, RandomForestClassifier):
        made, kind, more = RandomForestClassificationModel, "classification.DecisionTreeClassificationModel", {"numClasses": 2}
    set_params = {p.name: v for p, v in estimator.extractParamMap().items() if estimator.isSet(p)}
    defaults = {p.name: v for p, v in estimator.extractParamMap().items() if estimator.hasDefault(p) and not estimator.isSet(p)}
    own = {"checkpointInterval", "featuresCol", "labelCol", "maxBins", "maxDepth", "minInstancesPerNode", "seed", "weightCol"}

    def told(cls: str, uid: str, params: dict, **more) -> str:
        head = {"class": f"org.apache.spark.ml.{cls}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps(head | {"paramMap": params, "defaultParamMap": defaults if more else {}} | more)

    head = told(f"classification.{made.__name__}", estimator.uid, set_params, numFeatures=n_features, numTrees=len(trees), **more)
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    one = {k: v for k, v in set_params.items() if k in own}
    listed = [(i, told(kind, f"dt_{estimator.uid}_{i}", one), w) for i, (_, w) in enumerate(trees)]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for i, (tree, _) in enumerate(trees) for row in _stored(i, tree)]
    spark.createDataFrame(nodes, NODE_SCHEMA).coalesce(1).write.parquet(f"{path}/data")
    return made.load(path)
