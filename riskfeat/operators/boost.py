"""Boosted trees of a small table, learned by one task.

MLlib's ``GBTClassifier`` runs a Spark job per level of every tree; on a few
thousand rows a round is nearly all start of jobs. Here one task holds the rows
(``MAX_ROWS`` at most, checked by the caller) and grows the same trees in numpy:
MLlib's thresholds, its seeded draws of rows and of features per node, its
variance gain, its order among equal gains and its sums in row order, as of a
table in one partition. Only the last digit of an exponential may differ, which
can decide between two features of the same gain. Up to ``MAX_ROWS`` rows MLlib
takes its thresholds from every row; beyond that from a sample of its own, and
tables of that size are left to it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 10_000  # training rows; MLlib's max(maxBins^2, 10,000) of the same meaning
MAX_CELLS = 1 << 22  # rows x features of a table that one task holds
CHUNK = 1 << 19  # histogram cells of the nodes looked at together
_WORD = (1 << 64) - 1


@dataclass(frozen=True)
class Settings:
    rounds: int
    depth: int
    step: float
    subsample: float
    features: str
    min_rows: int
    min_gain: float
    max_bins: int
    memory: int  # bytes of the statistics of a group of nodes
    seed: int

    def weights(self) -> list[float]:
        """Of the trees."""
        return [1.0] + [self.step] * (self.rounds - 1)

    def per_node(self, n: int) -> int:
        """Features looked at in a node."""
        if self.features in ("all", "auto"):
            return n
        return min(n, int(self.features)) if self.features.isdigit() else math.ceil(float(self.features) * n)


def settings_of(est) -> Settings | None:
    """What ``est`` is set to; None if it is not boosting as it is done here."""
    if not isinstance(est, GBTClassifier) or est.isDefined("validationIndicatorCol") or est.getMinWeightFractionPerNode() > 0:
        return None
    features = est.getFeatureSubsetStrategy()
    if not (features in ("all", "auto") or features.replace(".", "", 1).isdigit()):
        return None
    return Settings(est.getMaxIter(), est.getMaxDepth(), est.getStepSize(), est.getSubsamplingRate(), features, est.getMinInstancesPerNode(),
                    est.getMinInfoGain(), est.getMaxBins(), est.getMaxMemoryInMB() << 20, est.getSeed())


# ------------------------------------------------- the JVM's random numbers
def _hash_words(words: Sequence[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """Murmur3 of 32-bit words, per entry."""
    m = np.uint64(0xFFFFFFFF)
    mul = lambda a, b: (a * np.uint64(b)) & m
    rot = lambda a, r: ((a << np.uint64(r)) | (a >> np.uint64(32 - r))) & m
    h = seed
    for k in words:
        h = (mul(rot(h ^ mul(rot(mul(k, 0xCC9E2D51), 15), 0x1B873593), 13), 5) + np.uint64(0xE6546B64)) & m
    h = h ^ np.uint64(4 * len(words))
    h = mul(h ^ (h >> np.uint64(16)), 0x85EBCA6B)
    h = mul(h ^ (h >> np.uint64(13)), 0xC2B2AE35)
    return h ^ (h >> np.uint64(16))


def _started(seeds: Sequence[int]) -> np.ndarray:
    """First state of Spark's ``XORShiftRandom`` per seed."""
    s = np.array([x & _WORD for x in seeds], np.uint64)
    words = [(s >> np.uint64(32)).astype(np.uint32).byteswap().astype(np.uint64), s.astype(np.uint32).byteswap().astype(np.uint64)]
    low = _hash_words(words, np.full(len(s), 0x3C074A61, np.uint64))
    return (_hash_words(words, low) << np.uint64(32)) | low


def _step(s: np.ndarray) -> np.ndarray:
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


def _as_double(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low26, low27 = np.uint64((1 << 26) - 1), np.uint64((1 << 27) - 1)
    return (((a & low26) << np.uint64(27)) + (b & low27)).astype(np.float64) * 2.0**-53


@lru_cache(maxsize=32)
def _jump(power: int) -> np.ndarray:
    """Tables (8 bytes x 256 values) that take a state ``2^power`` steps on; a step is linear in the bits."""
    unit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    columns = _step(unit) if power == 0 else _jumped(_jumped(unit, power - 1), power - 1)
    out = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for bit in range(8):
            out[byte, 1 << bit:2 << bit] = out[byte, :1 << bit] ^ columns[8 * byte + bit]
    return out


def _jumped(s: np.ndarray, power: int) -> np.ndarray:
    tables, out = _jump(power), np.zeros_like(s)
    for byte in range(8):
        out ^= tables[byte][((s >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.intp)]
    return out


def doubles(seed: int, n: int) -> np.ndarray:
    """The first ``n`` numbers of ``XORShiftRandom(seed).nextDouble``."""
    states, power = _step(_started([seed])), 0
    while len(states) < 2 * n:
        states, power = np.concatenate([states, _jumped(states, power)]), power + 1
    return _as_double(states[0:2 * n:2], states[1:2 * n:2])


class _Longs:
    """``java.util.Random.nextLong``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        x = self.state >> 16
        return x - (1 << 32) if x >> 31 else x

    def __call__(self) -> int:
        high = self._next() << 32
        return (high + self._next()) & _WORD


def _subsets(seeds: Sequence[int], n: int, k: int) -> np.ndarray:
    """Per seed ``k`` of ``n`` features by Spark's reservoir, in its order."""
    out = np.tile(np.arange(k), (len(seeds), 1))
    state, row = _started(seeds), np.arange(len(seeds))
    for item in range(k, n):
        a = _step(state)
        state = _step(a)
        at = (_as_double(a, state) * (item + 1)).astype(np.int64)
        hit = at < k
        out[row[hit], at[hit]] = item
    return out


# ------------------------------------------------------------------ learning
def thresholds(x: np.ndarray, w: np.ndarray, max_bins: int) -> np.ndarray:
    """Split thresholds of a column: halfway between neighbouring values, about equal weight apart."""
    values, inverse = np.unique(x, return_inverse=True)
    if len(values) <= max_bins:
        return (values[:-1] + values[1:]) / 2.0
    weight = np.bincount(inverse, w).tolist()
    stride = float(w.sum()) / max_bins
    found, current, target = [], weight[0], stride
    for i in range(1, len(weight)):
        before, current = current, current + weight[i]
        if abs(before - target) < abs(current - target):
            found.append(i)
            target += stride
    at = np.array(found, np.intp)
    return (values[at - 1] + values[at]) / 2.0


def _impurity(n, total, squares):
    return np.where(n == 0, 0.0, (squares - (total * total) / n) / n)


@dataclass
class Tree:
    """Node arrays; a leaf sends every row to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


class _Grower:
    """Grows trees over one table of binned rows."""

    def __init__(self, x: np.ndarray, w: np.ndarray, s: Settings):
        self.s, (self.n, self.f) = s, x.shape
        self.cuts = [thresholds(x[:, j], w, min(s.max_bins, self.n)) for j in range(self.f)]
        self.splits = np.array([len(c) for c in self.cuts])
        self.width = int(self.splits.max(initial=0)) + 1
        bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1)
        self.cell = bins + np.arange(self.f) * self.width  # of a row and feature in a node's histogram
        self.usable = np.arange(self.width - 1) < self.splits[:, None]
        self.w = w
        self.unit = bool((w == 1.0).all())
        self.k = s.per_node(self.f)

    def _group(self, stack: list[int], longs: _Longs) -> tuple[list[int], np.ndarray]:
        """Nodes off the stack as far as their statistics fit, and the features of each in their order."""
        if self.k == self.f:
            fit = max(1, self.s.memory // int(24 * (self.splits + 1).sum()))
            orders = np.tile(np.arange(self.f), (min(fit, len(stack)), 1))
        else:
            start, seeds = longs.state, [longs() for _ in stack]
            orders = _subsets(seeds, self.f, self.k)
            used = np.cumsum(24 * (self.splits + 1)[orders].sum(axis=1))
            fit = max(1, int(np.searchsorted(used, self.s.memory, "right")))
            if fit < len(stack):  # the first one that did not fit has drawn, too
                longs.state = start
                for _ in range(fit + 1):
                    longs()
        group = stack[:fit]
        del stack[:fit]
        return group, orders[:len(group)]

    def _best(self, nodes: np.ndarray, at: np.ndarray, rows: np.ndarray, orders: np.ndarray, per_row, parent: np.ndarray):
        """Per node the best (gain, feature, split) and the statistics left and right of it."""
        k, f, width = len(nodes), self.f, self.width
        place = np.full(int(at.max()) + 1, -1)
        place[nodes] = np.arange(k)
        p = place[at[rows]]
        r, p = rows[p >= 0], p[p >= 0]
        flat = (self.cell[r] + (p * (f * width))[:, None]).ravel()
        added = lambda v: np.bincount(flat, None if v is None else np.repeat(v[r], f), k * f * width).reshape(k, f, width).cumsum(axis=2)
        raw = added(None)
        stats = [raw.astype(np.float64) if self.unit else added(per_row[0]), added(per_row[1]), added(per_row[2])]
        left = [h[..., :-1] for h in stats]
        right = [h[..., -1:] - h[..., :-1] for h in stats]
        if nodes[0] == 0:  # the root's own statistics are the sides of the first split looked at
            order = orders[0][self.splits[orders[0]] > 0]
            parent[0] = [a[0, order[0], 0] + b[0, order[0], 0] for a, b in zip(left, right)]
        whole = _impurity(*parent[nodes].T)[:, None, None]
        count = left[0] + right[0]
        gain = whole - (left[0] / count) * _impurity(*left) - (right[0] / count) * _impurity(*right)
        ok = self.usable & (raw[..., :-1] >= self.s.min_rows) & (raw[..., -1:] - raw[..., :-1] >= self.s.min_rows) & (gain >= self.s.min_gain)
        gain = np.where(ok, gain, -np.inf)
        split = gain.argmax(axis=2)
        of_feature = np.take_along_axis(gain, split[..., None], 2)[..., 0]
        first = np.take_along_axis(of_feature, orders, 1).argmax(axis=1)
        each = np.arange(k)
        feature = orders[each, first]
        split = split[each, feature]
        pick = lambda side: np.stack([h[each, feature, split] for h in side], axis=1)
        return of_feature[each, feature], feature, split, pick(left), pick(right)

    def grow(self, target: np.ndarray, drawn: np.ndarray, seed: int) -> tuple[Tree, np.ndarray]:
        """A tree of the drawn rows, and every row's leaf."""
        s, longs = self.s, _Longs(seed)
        per_row = (self.w, self.w * target, self.w * target * target)
        at = np.zeros(self.n, np.intp)
        stats, level = np.array([[math.fsum(v[drawn]) for v in per_row]]), [0]
        feature, split, left, right = [-1], [0], [0], [0]
        stack = [0] if self.width > 1 and s.depth > 0 else []
        most = max(1, CHUNK // (self.f * self.width))
        while stack:
            group, orders = self._group(stack, longs)
            found = [self._best(np.array(group[i:i + most]), at, drawn, orders[i:i + most], per_row, stats) for i in range(0, len(group), most)]
            gain, feat, cut, low, high = (np.concatenate(x) for x in zip(*found))
            children = []
            for i, node in enumerate(group):
                if not gain[i] > 0:
                    continue
                feature[node], split[node], left[node], right[node] = int(feat[i]), int(cut[i]), len(level), len(level) + 1
                for side in (low[i], high[i]):
                    child = len(level)
                    level.append(level[node] + 1)
                    feature.append(-1)
                    split.append(0)
                    left.append(child)
                    right.append(child)
                    children.append(side)
                    if level[child] < s.depth and not abs(float(_impurity(*side))) < 2.220446049250313e-16:
                        stack.insert(0, child)
            if children:
                stats = np.concatenate([stats, np.array(children)])
                f, c = np.array(feature), np.array(split)
                mine = f[at]
                moved = (mine >= 0) & np.isin(at, group)
                r = np.nonzero(moved)[0]
                goes = self.cell[r, mine[r]] - mine[r] * self.width <= c[at[r]]
                at[r] = np.where(goes, np.array(left)[at[r]], np.array(right)[at[r]])
        f = np.array(feature)
        value = np.where(stats[:, 0] == 0, 0.0, stats[:, 1] / stats[:, 0])
        threshold = np.array([self.cuts[j][c] if j >= 0 else np.inf for j, c in zip(feature, split)])
        return Tree(np.maximum(f, 0), threshold, np.array(left), np.array(right), value), at


def learn(x: np.ndarray, y: np.ndarray, w: np.ndarray, s: Settings) -> Iterator[Tree]:
    """The trees of ``GBTClassifier`` on rows ``x`` (n, features) with labels 0 and 1 and weights."""
    if not len(x):
        raise ValueError("boosting needs rows")
    if not np.isin(y, (0.0, 1.0)).all():
        raise ValueError("labels must be 0 or 1")
    with np.errstate(all="ignore"):
        grower, sign, every = _Grower(x, w, s), 2.0 * y - 1.0, np.arange(len(x))
        pred, weights = np.zeros(len(x)), s.weights()
        for m in range(s.rounds):
            # exp in long doubles: rounded as the JVM's
            target = sign if m == 0 else 4.0 * sign / (1.0 + np.exp((2.0 * sign * pred).astype(np.longdouble)).astype(np.float64))
            drawn = every if s.subsample >= 1.0 else every[doubles(s.seed + m + 1, len(x)) < s.subsample]
            tree, leaf = grower.grow(target, drawn, s.seed + m)
            pred = pred + tree.value[leaf] * weights[m]
            yield tree


# ------------------------------------------------------------------- scoring
@dataclass
class Model:
    """Weighted trees of at most ``depth`` levels of splits."""

    trees: list[Tree]
    weights: list[float]
    depth: int

    def leaves(self, tree: Tree, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.intp), np.arange(len(x))
        for _ in range(self.depth):
            at = np.where(x[rows, tree.feature[at]] <= tree.threshold[at], tree.left[at], tree.right[at])
        return tree.value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for tree, weight in zip(self.trees, self.weights):
            out = out + self.leaves(tree, x) * weight
        return out

    def margins_with(self, x: np.ndarray, other: np.ndarray, groups: Sequence[Sequence[int]]) -> Iterator[np.ndarray]:
        """Margins of ``x``, then of ``x`` with the columns of each group taken from ``other``.

        A tree that splits on none of a group's columns keeps its leaves.
        """
        parts = np.stack([self.leaves(t, x) * w for t, w in zip(self.trees, self.weights)])
        yield parts.sum(axis=0)
        splits = [set(t.feature[t.left != np.arange(len(t.left))].tolist()) for t in self.trees]
        for group in groups:
            changed, columns = parts.copy(), list(group)
            mine = x[:, columns]
            x[:, columns] = other[:, columns]
            for i, tree in enumerate(self.trees):
                if not splits[i].isdisjoint(columns):
                    changed[i] = self.leaves(tree, x) * self.weights[i]
            x[:, columns] = mine
            yield changed.sum(axis=0)

    def score(self, df: DataFrame, keep: Sequence[str], features: str = "features") -> DataFrame:
        """``(*keep, SCORE)`` with SCORE = P(class 1)."""
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                with np.errstate(over="ignore"):
                    p = probability(model.value.margin(matrix_of(b.column("_x"))))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(p)], names=[*keep, "SCORE"])

        rows = df.select(*keep, vector_to_array(features).alias("_x"))
        schema = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], "SCORE double"])
        return rows.mapInArrow(run, schema)


def of_mllib(model) -> Model:
    """The trees of a fitted ``GBTClassificationModel`` over numbers, from its description."""
    lines = [line.strip() for line in model.toDebugString.splitlines()]
    starts = [i for i, line in enumerate(lines) if re.fullmatch(r"Tree \d+ \(weight .*\):", line)]
    trees, deepest = [], 0
    for start, end in zip(starts, [*starts[1:], len(lines)]):
        feature, threshold, left, right, value, levels, open_ = [], [], [], [], [], [], []
        for line in lines[start + 1:end]:
            node = len(feature)
            if line.startswith("Else"):
                right[open_[-1]] = node  # the next line begins the other side
                continue
            found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)|Predict: (\S+)", line)
            if not found:
                if line:
                    raise ValueError(f"not a split of a number: {line}")
                continue
            leaf = found[3] is not None
            feature.append(0 if leaf else int(found[1]))
            threshold.append(np.inf if leaf else float(found[2]))
            value.append(float(found[3]) if leaf else 0.0)
            left.append(node if leaf else node + 1)
            right.append(node if leaf else -1)
            levels.append(len(open_))
            if not leaf:
                open_.append(node)
            while leaf and open_ and right[open_[-1]] >= 0:  # both sides are done
                open_.pop()
        deepest = max(deepest, *levels)
        trees.append(Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)))
    if len(trees) != model.getNumTrees:
        raise ValueError(f"{len(trees)} of {model.getNumTrees} trees read")
    return Model(trees, [float(w) for w in model.treeWeights], deepest)


def probability(margin: np.ndarray) -> np.ndarray:
    """P(class 1), as MLlib takes it from class 0."""
    return 1.0 - 1.0 / (1.0 + np.exp(2.0 * margin))


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


_TREE = "at int, feature array<long>, threshold array<double>, left array<long>, right array<long>, value array<double>"


def fit(train: DataFrame, s: Settings, label: str, weight: str | None = None, features: str = "features") -> Model:
    """The model of all rows of ``train``, which the caller knows to be few."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(matrix_of(b.column("x")), *[b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w")]) for b in batches if b.num_rows]
        if not parts:
            raise ValueError("boosting needs rows")
        x, y, w = (np.concatenate(p) for p in zip(*parts))
        for i, t in enumerate(learn(x, y.astype(np.float64), w.astype(np.float64), s)):
            columns = [pa.array([i], pa.int32()), *[pa.array([v.tolist()], k) for v, k in (
                (t.feature, pa.list_(pa.int64())), (t.threshold, pa.list_(pa.float64())), (t.left, pa.list_(pa.int64())),
                (t.right, pa.list_(pa.int64())), (t.value, pa.list_(pa.float64())))]]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "feature", "threshold", "left", "right", "value"])

    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                        (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"))
    found = rows.coalesce(1).mapInArrow(run, _TREE).collect()
    trees = [Tree(*[np.array(r[c]) for c in ("feature", "threshold", "left", "right", "value")]) for r in sorted(found, key=lambda r: r["at"])]
    return Model(trees, s.weights(), s.depth)
