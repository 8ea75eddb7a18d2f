"""Second-order gradient boosting on quantile-binned rows.

Features become one byte each. A tree grows level by level: every task adds up the gradients and
hessians of its rows by (node, feature, bin), Spark merges these histograms, and the same reducers
find the best split of each (node, feature), so only one candidate per node and feature reaches the
driver. Sums are whole numbers of a fixed unit: trees do not depend on the order or partitions of rows.

Rows are stored in blocks, a block's columns as packed numbers, so a scan costs arithmetic and no
conversion of rows. The margin of each row is stored with its bytes and carried from round to round;
trees grown since it was last stored are applied on the fly. Validation rows travel with the others, so the first scan of
a round also tells the loss after the round before, and early stopping needs no second fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_staged, stage, staged_so_far

#: Rounds after which margins are stored again.
CARRY = 4
#: Cells (node x feature x bin) a task sums at once; a level with more takes several scans.
CELLS = 1 << 22
#: Rows and bytes of a stored block at most.
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 19
#: Rows handled at once inside a task.
SCAN_ROWS = 1 << 16
#: Rows that are worth a task; small tables, which may lie in many files, are scanned by fewer tasks.
TASK_ROWS = 1 << 17
#: Row groups of stored blocks, which Spark reads whole.
GROUP_BYTES = 16 << 20


@dataclass
class Boosting:
    """Settings of the boosted heads; the published ones by default.

    ``l2`` penalises leaves, a child needs ``least_hessian``; columns are drawn once per tree, rows
    with probability ``row_share`` per tree. ``patience`` rounds without a better validation loss end
    the training; None never does.
    """

    rounds: int = 1000
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.6
    patience: int | None = 20
    seed: int = 42
    bins: int = 256
    l2: float = 1.0
    least_hessian: float = 1.0


@dataclass
class Tree:
    """Nodes in heap order: children of n are 2n + 1 (bin or value up to the threshold) and 2n + 2."""

    depth: int
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    threshold: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.bin = np.full(size, -1), np.zeros(size, np.int64)
        self.threshold, self.value = np.zeros(size), np.zeros(size)

    def descent(self, cuts: np.ndarray, last: float) -> _Descent:
        return _Descent(self, cuts, last)


class _Descent:
    """A tree made ready for many rows: leaves pass all rows on to the left, down to the deepest level.

    ``cuts`` are the tree's bins or thresholds, ``last`` is one that no value exceeds.
    """

    def __init__(self, tree: Tree, cuts: np.ndarray, last: float):
        split = np.flatnonzero(tree.feature >= 0)
        self.levels = int(split[-1] + 1).bit_length() if len(split) else 0
        size = 2 ** (self.levels + 1) - 1
        self.feature = np.maximum(tree.feature[:size], 0).astype(np.intp)
        self.cut = np.where(tree.feature[:size] >= 0, cuts[:size], last).astype(type(last))
        self.real = np.zeros(size, np.intp)
        for level in range(self.levels):
            children = np.arange(2 ** (level + 1) - 1, 2 ** (level + 2) - 1)
            parent = (children - 1) // 2
            own = (tree.feature[parent] >= 0) & (self.real[parent] == parent)
            self.real[children] = np.where(own, children, self.real[parent])
        self.value = tree.value[self.real]

    def reached(self, columns: np.ndarray) -> np.ndarray:
        """Where each row of ``columns`` (feature, row) ends; ``real`` and ``value`` tell the leaf and its value."""
        n, flat = columns.shape[1], columns.reshape(-1)
        at, rows = np.zeros(n, np.intp), np.arange(n)
        for _ in range(self.levels):
            right = flat.take(self.feature.take(at) * n + rows) > self.cut.take(at)
            at += at + 1 + right
        return at


@dataclass
class BoostedModel:
    """Trees over raw feature values. ``grown`` counts the trees before early stopping cut them."""

    base: float
    trees: list[Tree]
    logistic: bool
    grown: int = 0
    losses: list[float] = field(default_factory=list)

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - the name that pyspark.ml's models have
        return len(self.trees)

    def margins(self, values: np.ndarray) -> np.ndarray:
        """One per row of ``values`` (row, feature)."""
        descents = [tree.descent(tree.threshold, np.float64(np.inf)) for tree in self.trees]
        out = np.full(len(values), self.base)
        for lo in range(0, len(values), SCAN_ROWS):
            columns = np.ascontiguousarray(values[lo : lo + SCAN_ROWS].T, dtype=np.float64)
            for descent in descents:
                out[lo : lo + SCAN_ROWS] += descent.value.take(descent.reached(columns))
        return out

    def score(self, features: str) -> Column:
        """Probability of class 1, or the predicted value, from an array column without gaps."""
        model = self

        @F.pandas_udf("double")
        def scored(column):
            import pandas as pd

            if not len(column):
                return pd.Series([], dtype="float64")
            margin = model.margins(np.stack(column.to_numpy()))
            return pd.Series(1 / (1 + np.exp(-margin)) if model.logistic else margin)

        return scored(features)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(-1, 0, int(self.logistic), 0.0, float(self.base))]
        rows += [
            (t, n, int(tree.feature[n]), float(tree.threshold[n]), float(tree.value[n]))
            for t, tree in enumerate(self.trees)
            for n in range(len(tree.feature))
        ]
        spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, value double").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = spark.read.parquet(path).orderBy("tree", "node").collect()
        trees: list[Tree] = []
        for r in rows[1:]:
            if r["node"] == 0:
                size = sum(1 for other in rows if other["tree"] == r["tree"]) if not trees else len(trees[0].feature)
                trees.append(Tree((size + 1).bit_length() - 2))
            trees[-1].feature[r["node"]], trees[-1].threshold[r["node"]], trees[-1].value[r["node"]] = r["feature"], r["threshold"], r["value"]
        return cls(rows[0]["value"], trees, bool(rows[0]["feature"]), len(trees))


# --- binning ------------------------------------------------------------------------------------


def bin_cuts(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each feature: quantiles of all rows, values that occur.

    A feature of few values has a bin for each that holds 1 / bins of the rows.
    """
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    each = rows.select(F.posexplode("features").alias("feature", "value"))
    found = each.groupBy("feature").agg(F.percentile_approx("value", shares, 40 * bins).alias("cuts"))
    table = {r["feature"]: np.unique(np.array(r["cuts"], float)) for r in found.collect()}
    return [table[f] for f in sorted(table)]


_BLOCK = "rid long, rows int, label binary, weight binary, held binary, margin binary, bytes binary"


def binned(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Stored blocks of consecutive rows from (label, weight, held, features): the first row's id, the number
    of rows, and the rows' numbers column by column, features by feature as bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(list(cuts))
    width = len(cuts)
    block = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (width + 25)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), block):
                batch = whole.slice(lo, block)
                n, rid = len(batch), batch.column("rid").to_numpy()
                if rid[-1] - rid[0] != n - 1:
                    raise ValueError("the numbers of a block's rows should be consecutive")
                values = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
                found = np.empty((width, n), np.uint8)
                for f, own in enumerate(shared.value):
                    found[f] = np.searchsorted(own, values[:, f], "left")
                label, weight = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("label", "weight"))
                held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
                packed = [[x.tobytes()] for x in (label, weight, held, np.zeros(n), found)]
                arrays = [pa.array([int(rid[0])], pa.int64()), pa.array([n], pa.int32()), *[pa.array(x, pa.binary()) for x in packed]]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _BLOCK.split(", ")])

    numbered = rows.select(F.monotonically_increasing_id().alias("rid"), "label", "weight", "held", "features")
    return _stored(numbered.mapInArrow(pack, _BLOCK))


def _stored(blocks: DataFrame) -> DataFrame:
    return stage(blocks, **{"parquet.block.size": str(GROUP_BYTES)})


def _gathered(blocks: DataFrame, rows: int) -> DataFrame:
    """Stored blocks, read by at most one task per ``TASK_ROWS`` rows."""
    return blocks.coalesce(max(1, -(-rows // TASK_ROWS)))


# --- one scan -----------------------------------------------------------------------------------


def _uniform(rid: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per row that depends on its id and the seed only."""
    h = rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) / 2.0**64


@dataclass
class _Scan:
    """What a task needs: the model so far, the growing tree, and the nodes and columns to sum."""

    logistic: bool
    width: int
    bins: int
    base: float
    unit: float
    row_share: float
    row_seed: int
    since: list[Tree]
    tree: Tree
    nodes: np.ndarray
    columns: np.ndarray
    losses: bool

    def parts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
        """The rows of several blocks together."""
        for batch in batches:
            lo = rows = 0
            for hi, more in enumerate(batch.column("rows").to_pylist(), 1):
                rows += more
                if rows >= SCAN_ROWS or hi == len(batch):
                    yield _Rows(batch.slice(lo, hi - lo), self.width)
                    lo, rows = hi, 0

    def margins(self, rows: _Rows, since: Sequence[_Descent]) -> np.ndarray:
        margin = rows.column("margin", np.float64) + 0.0
        for descent in since:
            margin += descent.value.take(descent.reached(rows.found))
        return margin

    def applied(self) -> list[_Descent]:
        return [tree.descent(tree.bin, np.uint8(255)) for tree in self.since]

    def derivatives(self, y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.logistic:
            return w * (margin - y), w
        p = 1 / (1 + np.exp(-margin))
        return w * (p - y), w * np.maximum(p * (1 - p), 1e-16)

    def loss(self, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
        return np.logaddexp(0, margin) - y * margin if self.logistic else (margin - y) ** 2

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, feature, sums): packed gradients and hessians by bin; node -1: loss and number of held rows."""
        n, m, bins = len(self.nodes), len(self.columns), self.bins
        # Rows in no node of these are summed behind the others.
        size = (n + 1) * bins
        total = np.zeros((2, m, size), np.int64)
        since, here = self.applied(), self.tree.descent(self.tree.bin, np.uint8(255))
        place = np.full(len(here.real), n)
        place[self.nodes] = np.arange(n)
        place *= bins
        lost = held_rows = 0
        for rows in self.parts(batches):
            margin = self.margins(rows, since)
            y, w, held = rows.column("label", np.float64), rows.column("weight", np.float64), rows.column("held", bool)
            if self.losses:
                lost += int(np.rint(self.loss(y[held], margin[held]) / self.unit).astype(np.int64).sum())
                held_rows += int(held.sum())
            if not m:
                continue
            use = ~held & (_uniform(rows.ids(), self.row_seed) < self.row_share)
            cell = place.take(here.reached(rows.found))
            for k, part in enumerate(self.derivatives(y, w, margin)):
                units = np.where(use, np.rint(part / self.unit), 0.0)
                # Whole numbers whose sums stay below 2**53: sums of doubles are exact.
                step = int(2**53 // max(1.0, np.abs(units).max(initial=0.0)))
                for c, f in enumerate(self.columns):
                    found = cell + rows.found[f]
                    for lo in range(0, len(units), step):
                        total[k, c] += np.bincount(found[lo : lo + step], units[lo : lo + step], size).astype(np.int64)
        cells = total[:, :, : n * bins].reshape(2, m, n, bins)
        column, at = np.nonzero(cells[1].any(2))
        packed = [cells[:, j, i].tobytes() for i, j in zip(at, column, strict=True)]
        nodes, features = self.nodes[at], self.columns[column]
        if self.losses:
            packed.append(np.array([lost, held_rows], np.int64).tobytes())
            nodes, features = np.append(nodes, -1), np.append(features, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes.astype(np.int32)), pa.array(features.astype(np.int32)), pa.array(packed, pa.binary())], ["node", "feature", "sums"]
        )

    def carried(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks with their margins after the trees so far."""
        since = self.applied()
        for whole in batches:
            for i in range(len(whole)):
                batch = whole.slice(i, 1)
                margin = self.margins(_Rows(batch, self.width), since)
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array([margin.tobytes()], pa.binary()))


class _Rows:
    """The rows of some blocks; ``found`` has their bytes as (feature, row)."""

    def __init__(self, blocks: pa.RecordBatch, width: int):
        self.blocks = blocks
        each = [np.frombuffer(b.as_buffer(), np.uint8).reshape(width, -1) for b in blocks.column("bytes")]
        self.found = np.concatenate(each, axis=1)

    def column(self, name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in self.blocks.column(name)])

    def ids(self) -> np.ndarray:
        starts = zip(self.blocks.column("rid").to_pylist(), self.blocks.column("rows").to_pylist(), strict=True)
        return np.concatenate([np.arange(first, first + n) for first, n in starts])


_BEST = "node int, feature int, bin int, gain double, g long, h long, left_g long, left_h long"


def _best_split(bins: int, unit: float, l2: float, least: float):
    """Reducer of one (node, feature): merged sums to its best split; bin -1 if it has none."""

    def best(group: pa.Table) -> pa.Table:
        node, feature = group["node"][0].as_py(), group["feature"][0].as_py()
        total = np.zeros(2 if node < 0 else 2 * bins, np.int64)
        for part in group["sums"].to_pylist():
            total += np.frombuffer(part, np.int64)
        if node < 0:
            row = (node, feature, -1, 0.0, int(total[0]), int(total[1]), 0, 0)
        else:
            g, h = total.reshape(2, bins)
            left_g, left_h = np.cumsum(g), np.cumsum(h)
            all_g, all_h = int(left_g[-1]), int(left_h[-1])

            def worth(a, b):
                return (a * unit) ** 2 / (b * unit + l2) if l2 else (a * unit) ** 2 / np.maximum(b * unit, 1e-16)

            gain = worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h) - worth(all_g, all_h)
            fits = (left_h * unit >= least) & ((all_h - left_h) * unit >= least) & (left_h > 0) & (left_h < all_h)
            gain = np.where(fits, gain, -1.0)
            at = int(gain.argmax())
            good = gain[at] > 1e-9
            row = (node, feature, at if good else -1, float(gain[at]) if good else 0.0, all_g, all_h, int(left_g[at]), int(left_h[at]))
        names = [c.split()[0] for c in _BEST.split(", ")]
        kinds = [pa.int32()] * 3 + [pa.float64()] + [pa.int64()] * 4
        return pa.table({name: pa.array([value], kind) for name, value, kind in zip(names, row, kinds, strict=True)})

    return best


# --- training -----------------------------------------------------------------------------------


def patience_rounds(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds to keep, and whether the losses ran ``patience`` rounds past the best one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def _drawn(width: int, share: float, seed: int) -> np.ndarray:
    """The columns of one tree, in order."""
    many = max(1, int(width * share + 1e-9))
    return np.sort(np.random.default_rng(seed).permutation(width)[:many])


def _grow(data: DataFrame, scan: _Scan, first: list, cuts: Sequence[np.ndarray], b: Boosting) -> None:
    """Grow the scan's tree level by level; ``first`` has the best splits of the root."""
    tree, columns = scan.tree, scan.columns
    found, level = first, 0
    while True:
        best: dict[int, tuple] = {}
        for r in found:
            # Of equal gains the first column's split, and of that the first bin, is taken.
            key = (-r["gain"], r["feature"]) if r["bin"] >= 0 else (1.0, r["feature"])
            if r["node"] not in best or key < best[r["node"]][0]:
                best[r["node"]] = (key, r)
        grown = []
        for node, (_, r) in best.items():
            if level == 0:
                tree.value[node] = _leaf(r["g"], r["h"], scan.unit, b)
            if r["bin"] < 0:
                continue
            tree.feature[node], tree.bin[node] = r["feature"], r["bin"]
            tree.threshold[node] = cuts[r["feature"]][r["bin"]]
            tree.value[2 * node + 1] = _leaf(r["left_g"], r["left_h"], scan.unit, b)
            tree.value[2 * node + 2] = _leaf(r["g"] - r["left_g"], r["h"] - r["left_h"], scan.unit, b)
            grown += [2 * node + 1, 2 * node + 2]
        level += 1
        if level == b.depth or not grown:
            return
        many = max(1, CELLS // (len(columns) * b.bins))
        scan.losses, found = False, []
        for lo in range(0, len(grown), many):
            scan.nodes = np.array(sorted(grown)[lo : lo + many])
            found += _splits(data, scan, b)


def _leaf(g: int, h: int, unit: float, b: Boosting) -> float:
    return -b.rate * (g * unit) / max(h * unit + b.l2, 1e-16)


def _splits(data: DataFrame, scan: _Scan, b: Boosting) -> list:
    sums = data.mapInArrow(scan.sums, "node int, feature int, sums binary")
    return sums.groupBy("node", "feature").applyInArrow(_best_split(b.bins, scan.unit, b.l2, b.least_hessian), _BEST).collect()


def fit_trees(train: DataFrame, val: DataFrame | None, boosting: Boosting, logistic: bool) -> BoostedModel:
    """Boosted trees from rows (label, weight, features without gaps) with early stopping on ``val``.

    The first margin is one Newton step from 0 over all training rows: their mean, or log-odds of 0
    for balanced classes. Without training rows the model has no tree and the margin 0. Tables
    staged on the way are deleted.
    """
    spark, mark, b = train.sparkSession, staged_so_far(), boosting
    held = [] if val is None else [val.select("label", F.lit(1.0).alias("weight"), F.lit(True).alias("held"), "features")]
    rows = train.select("label", "weight", F.lit(False).alias("held"), "features")
    facts = rows.agg(
        F.count("*").alias("n"), F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("y"),
        F.max("weight").alias("heaviest"), F.max(F.abs("label")).alias("largest"),
    ).first()
    if not facts["n"]:
        return BoostedModel(0.0, [], logistic)
    mean = facts["y"] / facts["w"]
    base = (mean - 0.5) * 4 if logistic else mean
    peak = max(64.0, facts["heaviest"]) if logistic else max(1.0, 4 * facts["largest"] ** 2) * facts["heaviest"]
    # Sums of all rows stay below 2**62, those of a block below 2**53.
    unit = 2.0 ** np.ceil(np.log2(max(2.0**-30, peak * facts["n"] * 2.0**-62, peak * 2.0**-41)))
    cuts = bin_cuts(rows, b.bins)
    for more in held:
        rows = rows.unionByName(more)
    stored = binned(rows.withColumn("features", F.col("features").cast("array<double>")), cuts)
    size = stored.agg(F.sum("rows")).first()[0]
    data = _gathered(stored, size)
    model, since = BoostedModel(base, [], logistic), []
    for turn in range(b.rounds + 1):
        # The scan after the last round only asks for its loss.
        columns = _drawn(len(cuts), b.column_share, b.seed * 1_000_003 + turn) if turn < b.rounds else np.zeros(0, np.int64)
        if turn == b.rounds and val is None:
            break
        tree = Tree(b.depth)
        scan = _Scan(logistic, len(cuts), b.bins, base, unit, b.row_share, b.seed * 7_368_787 + turn, since, tree, np.zeros(1, np.int64), columns, val is not None)
        if turn == 0:
            scan.since = [_constant(base, b.depth)]
            since.extend(scan.since)
        first = _splits(data, scan, b)
        lost = next((r for r in first if r["node"] < 0), None)
        if turn and lost is not None and lost["h"]:
            model.losses.append(lost["g"] * unit / lost["h"])
            if b.patience is not None and patience_rounds(model.losses, b.patience)[1]:
                break
        if turn == b.rounds:
            break
        _grow(data, scan, [r for r in first if r["node"] >= 0], cuts, b)
        model.trees.append(tree)
        since.append(tree)
        if len(since) >= CARRY:
            stored = _stored(data.mapInArrow(_Scan(**{**vars(scan), "since": list(since)}).carried, data.schema))
            data, since = _gathered(stored, size), []
            drop_staged(spark, mark, keep=stored)
    model.grown = len(model.trees)
    if model.losses and b.patience is not None:
        model.trees = model.trees[: patience_rounds(model.losses, b.patience)[0]]
    drop_staged(spark, mark)
    return model


def _constant(value: float, depth: int) -> Tree:
    """A tree of one leaf: the margin that all rows begin with."""
    tree = Tree(depth)
    tree.value[0] = value
    return tree
