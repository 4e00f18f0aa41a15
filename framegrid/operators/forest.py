"""A random forest with several outputs, grown level by level from histograms that Spark adds up, and evaluated from flat arrays.

A node is split where the summed variance of all outputs falls most. For that only counts and sums by bin are needed, so each task
adds its rows into one histogram for each node of the level, and a shuffle by node adds the tasks' histograms; the driver sees the chosen
splits alone. Nodes whose rows are few enough for one task are dealt out with their rows and grown to the end there, by the same
rules, so the result does not depend on where a node was grown. Outputs of 0 and 1 make a classifier: its leaves are probabilities.

Each tree sees each row as often as a Poisson draw from the row's and the tree's hash says, and each node a random part of the
features, drawn from the tree's and the node's number. Sums are of whole numbers (outputs in steps of 2**-16), so they do not depend on
their order. Rows that have a null, or features of another length than the first row's, are an error; equal rows are drawn alike.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.sources.models import read_file
from framegrid.sources.sinks import write_file

STEP = 1 << 16
#: Histogram cells of one pass over the rows, and rows of a node that one task grows to the end.
MOST_CELLS, SMALL_ROWS = 1 << 22, 4096
#: Chances that a Poisson variable of mean 1 is at most 0, 1, 2 and so on.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


@dataclass
class Forest:
    """All nodes in a row: a leaf has feature -1; values are given for leaves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Means over the trees for rows of features; all rows and trees take a step at a time."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while (inner := self.feature[at] >= 0).any():
            low = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
        return self.value[at].mean(axis=1)

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in ("roots", "feature", "threshold", "left", "right", "value")}


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def unpacked(content: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(content), allow_pickle=False) as held:
        return {k: held[k] for k in held.files}


def save(forest: Forest, path: str) -> None:
    write_file(path, packed(forest.arrays()))


def load(path: str) -> Forest:
    return Forest(**unpacked(read_file(path)))


@dataclass(frozen=True)
class Growth:
    trees: int = 300
    depth: int = 14
    bins: int = 32
    least_rows: int = 1
    feature_share: float = 1 / 3
    seed: int = 0

    def features(self, tree: int, node: int, n: int) -> np.ndarray:
        """The features that a node may split by."""
        most = max(1, round(n * self.feature_share))
        return np.sort(np.random.default_rng([self.seed, tree, node]).choice(n, most, replace=False))

    def draws(self, keys: np.ndarray, tree: int) -> np.ndarray:
        """How often a tree sees each row."""
        x = keys.astype(np.uint64) ^ np.uint64((tree * 0x9E3779B97F4A7C15 + self.seed * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return np.searchsorted(_POISSON, ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53), side="right")


def histogram(bins: np.ndarray, sums: np.ndarray, slot: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """slots x features x bins x (1 + outputs) from rows of bins and of (draws, draws * outputs)."""
    m = bins.shape[1]
    key = ((slot[:, None] * m + np.arange(m)) * n_bins + bins).ravel()
    size = slots * m * n_bins
    return np.stack([np.bincount(key, np.repeat(s, m), size) for s in sums.T], axis=-1).reshape(slots, m, n_bins, sums.shape[1])


def best_split(h: np.ndarray, least: int) -> tuple[int, int, np.ndarray] | None:
    """Place in the node's features, last bin of the lower side and that side's sums; the first of equals; None for a leaf."""
    total = h[0].sum(axis=0)
    low = np.cumsum(h, axis=1)[:, :-1]
    high = total - low
    n_low, n_high = low[..., 0], high[..., 0]
    fits = (n_low >= least) & (n_high >= least)
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(fits, (low[..., 1:] ** 2).sum(axis=-1) / n_low + (high[..., 1:] ** 2).sum(axis=-1) / n_high, -np.inf)
    at = int(np.argmax(score))
    before = float((total[1:] ** 2).sum() / total[0])
    if score.flat[at] <= before * (1 + 1e-12) + 1e-9:
        return None
    j, b = np.unravel_index(at, score.shape)
    return int(j), int(b), low[j, b]


def _grow(tree: int, node: int, total: np.ndarray, bins: np.ndarray, sums: np.ndarray, growth: Growth, n_bins: int) -> Iterator[tuple]:
    """All of a node's subtree from its rows: (node, feature, bin, sums); feature -1 for leaves."""
    waiting = [(node, np.arange(len(bins)), total)]
    while waiting:
        node, rows, total = waiting.pop()
        split, chosen = None, growth.features(tree, node, bins.shape[1])
        if node.bit_length() <= growth.depth and total[0] >= 2 * growth.least_rows:
            split = best_split(histogram(bins[rows][:, chosen], sums[rows], np.zeros(len(rows), np.int64), 1, n_bins)[0], growth.least_rows)
        if split is None:
            yield node, -1, 0, total
            continue
        j, b, low = split
        yield node, int(chosen[j]), b, total
        goes = bins[rows, chosen[j]] <= b
        waiting += [(2 * node, rows[goes], low), (2 * node + 1, rows[~goes], total - low)]


def _edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """The borders of each feature's bins, at its quantiles; features times bins at most."""
    shares = [i / bins for i in range(1, bins)]
    flat = rows.select(F.posexplode("features").alias("at", "x"))
    found = flat.groupBy("at").agg(F.percentile_approx("x", shares, 10_000).alias("edges"), F.max("x").alias("most")).collect()
    by = {r["at"]: np.unique([e for e in r.edges if e < r.most]) for r in found}
    return [by[i] for i in range(len(by))]


def _binned(rows: DataFrame, edges: list[np.ndarray], outputs: int) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            features, target = (batch.column(i) for i in (1, 2))
            n = batch.num_rows
            x = features.flatten().to_numpy(zero_copy_only=False)
            y = target.flatten().to_numpy(zero_copy_only=False)
            if len(x) != n * len(edges) or len(y) != n * outputs or np.isnan(x).any() or np.isnan(y).any():
                raise ValueError("all rows have the same number of features and outputs, and none is null")
            x = x.reshape(n, len(edges))
            held = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)
            steps = np.rint(y.reshape(n, outputs) * STEP).astype(np.int64)
            columns = [batch.column(0), pa.array([r.tobytes() for r in held], pa.binary()), pa.array([r.tobytes() for r in steps], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "bins", "steps"])

    keyed = rows.select(F.xxhash64("features", "target").alias("key"), "features", "target")
    return keyed.mapInArrow(run, "key long, bins binary, steps binary")


def _matrices(batch: pa.RecordBatch, features: int, outputs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = batch.column("key").to_numpy(zero_copy_only=False)
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(len(keys), features)
    return keys, bins, np.frombuffer(b"".join(batch.column("steps").to_pylist()), np.int64).reshape(len(keys), outputs)


class _Tree:
    """Splits so far by heap number: the root is 1, the children of i are 2 i and 2 i + 1."""

    def __init__(self) -> None:
        self.splits: dict[int, tuple[int, int]] = {}

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` steps; rows that reach a leaf before stay there."""
        at = np.ones(len(bins), np.int64)
        if not self.splits:
            return at
        most = max(self.splits) + 1
        feature, border = np.full(most, -1), np.zeros(most, np.int64)
        for node, (f, b) in self.splits.items():
            feature[node], border[node] = f, b
        for _ in range(levels):
            f = np.where(at < most, feature[np.minimum(at, most - 1)], -1)
            inner = f >= 0
            goes = bins[np.arange(len(bins)), np.maximum(f, 0)] > border[np.minimum(at, most - 1)]
            at = np.where(inner, 2 * at + goes, at)
        return at


def _level(data: DataFrame, trees: dict[int, _Tree], nodes: list[tuple[int, int]], level: int, growth: Growth, shape: tuple[int, int, int]) -> list:
    """Splits of the nodes from histograms: rows of (slot, feature, bin, total, low) as the driver gets them."""
    features, outputs, n_bins = shape
    chosen = np.stack([growth.features(t, n, features) for t, n in nodes])
    at_slot: dict[int, dict[int, int]] = {}
    for slot, (t, n) in enumerate(nodes):
        at_slot.setdefault(t, {})[n] = slot

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = np.zeros((len(nodes), chosen.shape[1], n_bins, 1 + outputs))
        for batch in it:
            keys, bins, steps = _matrices(batch, features, outputs)
            for t, slots in at_slot.items():
                of = np.full(1 << (level + 1), -1)
                of[list(slots)] = list(slots.values())
                slot, n = of[trees[t].place(bins, level)], growth.draws(keys, t)
                rows = np.flatnonzero((slot >= 0) & (n > 0))
                if len(rows):
                    sums = np.concatenate([n[rows, None], n[rows, None] * steps[rows]], axis=1)
                    own, local = np.unique(slot[rows], return_inverse=True)
                    h[own] += histogram(bins[rows[:, None], chosen[slot[rows]]], sums, local, len(own), n_bins)
        held = np.flatnonzero(h[:, 0, :, 0].sum(axis=1) > 0)
        for part in np.array_split(held, max(1, len(held) // 64)):
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([h[s].tobytes() for s in part], pa.binary())], ["slot", "h"])

    def choose(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(slot: int, h: np.ndarray) -> pa.RecordBatch:
            total, split = h[0].sum(axis=0), best_split(h, growth.least_rows)
            j, b, low = split or (-1, 0, total)
            feature = int(chosen[slot, j]) if split else -1
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (slot, feature, b)] + [pa.array([x.tobytes()], pa.binary()) for x in (total, low)], ["slot", "feature", "bin", "total", "low"])

        now, h = -1, None
        for batch in it:  # in order of slots, so one histogram is held at a time
            for slot, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(body.as_py()).reshape(chosen.shape[1], n_bins, 1 + outputs)
                if slot != now and h is not None:
                    yield settled(now, h)
                h = part.copy() if slot != now else h + part
                now = slot
        if h is not None:
            yield settled(now, h)

    counted = data.mapInArrow(count, "slot long, h binary").repartition("slot").sortWithinPartitions("slot")
    return counted.mapInArrow(choose, "slot long, feature long, bin long, total binary, low binary").collect()


def _finish(data: DataFrame, trees: dict[int, _Tree], nodes: dict[tuple[int, int], np.ndarray], level: int, growth: Growth, shape: tuple[int, int, int]) -> list:
    """Subtrees of small nodes, each grown in one task from its rows."""
    features, outputs, n_bins = shape
    of_tree: dict[int, list[int]] = {}
    for t, n in nodes:
        of_tree.setdefault(t, []).append(n)

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keys, bins, _ = _matrices(batch, features, outputs)
            for t, wanted in of_tree.items():
                at, n = trees[t].place(bins, level), growth.draws(keys, t)
                rows = np.flatnonzero(np.isin(at, wanted) & (n > 0))
                if len(rows):
                    index = pa.array(rows)
                    columns = [pa.array(np.full(len(rows), t)), pa.array(at[rows]), pa.array(n[rows]), batch.column("bins").take(index), batch.column("steps").take(index)]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "n", "bins", "steps"])

    def grow(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(-1, features)
        steps = np.frombuffer(b"".join(table.column("steps").to_pylist()), np.int64).reshape(-1, outputs)
        n = table.column("n").to_numpy()[:, None]
        sums = np.concatenate([n, n * steps], axis=1)
        grown = list(_grow(tree, node, sums.sum(axis=0).astype(float), bins, sums, growth, n_bins))
        columns = [[tree] * len(grown), *(list(c) for c in zip(*grown, strict=True))]
        columns[-1] = [x.astype(float).tobytes() for x in columns[-1]]
        kinds = {"tree": pa.int64(), "node": pa.int64(), "feature": pa.int32(), "bin": pa.int32(), "total": pa.binary()}
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    dealt = data.mapInArrow(deal, "tree long, node long, n long, bins binary, steps binary")
    return dealt.groupBy("tree", "node").applyInArrow(grow, "tree long, node long, feature int, bin int, total binary").collect()


def train(rows: DataFrame, growth: Growth = Growth(), small_rows: int = SMALL_ROWS) -> Forest:
    """Fit on rows of (features array<double>, target array<double>); further columns are left out."""
    if not 2 <= growth.bins <= 256:
        raise ValueError("bins are numbered in one byte")
    rows = rows.select("features", "target")
    first = rows.select(F.size("features").alias("f"), F.size("target").alias("t")).first()
    if first is None or first.f < 1 or first.t < 1:
        raise ValueError("no rows to fit on")
    edges = _edges(rows, growth.bins)
    data = _binned(rows, edges, first.t).persist()
    shape = (first.f, first.t, growth.bins)
    trees = {t: _Tree() for t in range(growth.trees)}
    leaves: dict[tuple[int, int], np.ndarray] = {}
    open_nodes: dict[tuple[int, int], np.ndarray | None] = {(t, 1): None for t in trees}
    cells = max(1, round(first.f * growth.feature_share)) * growth.bins * (1 + first.t)
    n_rows = data.count()
    if n_rows * 2 <= small_rows:  # a root that one task grows; its rows are drawn about once each
        open_nodes = {k: np.array([n_rows]) for k in open_nodes}
    for level in range(growth.depth + 1):
        small = {k: v for k, v in open_nodes.items() if v is not None and v[0] <= small_rows}
        large = [k for k in open_nodes if k not in small]
        open_nodes = {}
        for r in _finish(data, trees, small, level, growth, shape) if small else ():
            if r.feature < 0:
                leaves[r.tree, r.node] = np.frombuffer(r.total)
            else:
                trees[r.tree].splits[r.node] = (r.feature, r.bin)
        most = max(1, MOST_CELLS // cells)
        for at in range(0, len(large), most):
            part = large[at : at + most]
            for r in _level(data, trees, part, level, growth, shape):
                (t, n), total, low = part[r.slot], np.frombuffer(r.total), np.frombuffer(r.low)
                if r.feature < 0 or level == growth.depth:
                    leaves[t, n] = total
                    continue
                trees[t].splits[n] = (r.feature, r.bin)
                open_nodes |= {(t, 2 * n): low, (t, 2 * n + 1): total - low}
        if not open_nodes:
            break
    data.unpersist()
    return _flat(trees, leaves, edges, first.t)


def _flat(trees: dict[int, _Tree], leaves: dict[tuple[int, int], np.ndarray], edges: list[np.ndarray], outputs: int) -> Forest:
    roots, feature, threshold, left, right, value = [], [], [], [], [], []
    for t, tree in trees.items():
        if (t, 1) not in leaves and 1 not in tree.splits:
            continue  # no row was drawn
        roots.append(len(feature))
        waiting = [(1, -1, 0)]
        while waiting:
            node, parent, side = waiting.pop()
            here = len(feature)
            if parent >= 0:
                (left, right)[side][parent] = here
            f, b = tree.splits.get(node, (-1, 0))
            feature.append(f)
            threshold.append(float(edges[f][b]) if f >= 0 else 0.0)
            left.append(-1)
            right.append(-1)
            total = leaves.get((t, node))
            value.append(total[1:] / total[0] / STEP if total is not None else np.zeros(outputs))
            if f >= 0:
                waiting += [(2 * node, here, 0), (2 * node + 1, here, 1)]
    if not roots:
        raise ValueError("no tree drew a row")
    return Forest(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))
