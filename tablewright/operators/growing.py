"""Trees and forests grown from weighted cells of binned rows.

1. Every feature is cut into at most ``bins`` bins: its own values if they are few, quantiles otherwise.
2. Rows of the same bins are one cell of a tree, with the sums that a split needs: rows, and either the weight of
   each class or weight, weighted target and its square. Bootstrap draws (Poisson of mean one, from a hash of
   the row and the tree) are made for all trees in one
   pass over the rows: a task draws sorted rows by batches and sums them before the shuffle.
3. Nodes with more than ``LOCAL_CELLS`` cells are split level by level: sums by (tree, node, feature, bin) in each
   task, one small aggregation of them, and windows over the bins for the best split. The cells stay where they are;
   the few splits so far tell a cell's node.
4. A node with fewer cells is grown to the end in the task that its cells are sent to, again by levels.
5. Where only gains or the accuracy are wanted of drawn trees, a table whose trees are local from the root on (``gather``)
   goes to the workers whole, as bins and row hashes, and each tree is drawn and grown in one task: nothing is shuffled
   for a tree.

Nodes carry heap numbers (1, then 2n and 2n + 1), so a tree may be up to ``DEEPEST`` deep. A split must leave
``min_leaf`` rows on both sides and a node needs ``min_split`` rows to be split; ties go to the first feature, then
the lowest limit. The model is collected: at most two nodes for each cell and tree. Where only the gains or the
accuracy are wanted (``keep``), the trees stay on the executors.

Null features count as 0; rows without a target are left out; rows that are equal in every column share their
draws; a constant feature is never split; a table without rows gives trees that predict null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from copy import copy
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalar import col
from tablewright.operators.project import require_columns
from tablewright.session import durable, reused, ship_package

BINS, LOCAL_CELLS, DEEPEST = 64, 1_000_000, 60
# Cells of one histogram block.
HISTOGRAM = 1 << 20
# Predictions that a worker remembers.
KNOWN = 1 << 18
# Cells that are added up at once.
BLOCK = 1 << 15
# Bytes of a table that goes to the workers whole.
GATHERED = 1 << 26


def values_at(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The values of the leaves that the rows of ``x`` fall into."""
    at = np.zeros(len(x), np.int64)
    while True:
        feature = tree["feature"][at]
        inner = np.flatnonzero(feature >= 0)
        if not len(inner):
            return tree["value"][at]
        node = at[inner]
        at[inner] = tree["left"][node] + (x[inner, feature[inner]] > tree["limit"][node])


def scored(df: DataFrame, model, keep: Sequence[str], added: str, made: Callable[[object, np.ndarray], dict[str, pa.Array]]) -> DataFrame:
    """The kept columns and those that ``made`` works out from the model's features, by Arrow batches."""
    require_columns(df, *model.features, *keep)
    ship_package(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    slim = df.select(*[col(c) for c in keep], F.array(*[F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in model.features]).alias("_x"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]], added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(sent.value.features))
            more = made(sent.value, x)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *more.values()], [*batch.schema.names[:-1], *more])

    return slim.mapInArrow(run, schema)


@dataclass(frozen=True)
class Forest:
    """Grown trees: for each tree heap numbers in order, the feature (-1 in a leaf), limit, gain, rows and value."""

    features: tuple[str, ...]
    classes: tuple | None
    trees: list[dict[str, np.ndarray]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees: class shares by row, or one value by row."""
        total = 0.0
        for tree in self.trees:
            total = total + values_at(tree, x)
        return total / max(len(self.trees), 1)

    @cached_property
    def _cuts(self) -> list[np.ndarray]:
        """The limits that any tree has on each feature."""
        pairs = [(t["feature"][t["feature"] >= 0], t["limit"][t["feature"] >= 0]) for t in self.trees]
        feature, limit = (np.concatenate(p) for p in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0))
        return [np.unique(limit[feature == f]) for f in range(len(self.features))]

    @cached_property
    def _known(self) -> dict[str, np.ndarray]:
        return {"key": np.zeros(0, np.int64)}

    def predict_each(self, x: np.ndarray) -> np.ndarray:
        """``predict``, once for all rows that lie between the same limits; a worker remembers ``KNOWN`` of them."""
        sizes = [len(c) + 1 for c in self._cuts]
        if np.prod([float(s) for s in sizes]) >= 2.0**62 or not len(x) or not self.trees:
            return self.predict(x)
        key = np.zeros(len(x), np.int64)
        for f, cuts in enumerate(self._cuts):
            key = key * sizes[f] + np.where(np.isnan(x[:, f]), 0, np.searchsorted(cuts, x[:, f]))
        unique, first, back = np.unique(key, return_index=True, return_inverse=True)
        known = self._known
        at = np.minimum(np.searchsorted(known["key"], unique), max(len(known["key"]) - 1, 0))
        new = known["key"][at] != unique if len(known["key"]) else np.ones(len(unique), bool)
        made = self.predict(x[first[new]])
        out = np.empty((len(unique), *made.shape[1:]))
        out[new] = made
        if not new.all():
            out[~new] = known["value"][at[~new]]
        if new.any() and len(known["key"]) + new.sum() <= KNOWN:
            spots = np.searchsorted(known["key"], unique[new])
            value = np.insert(known["value"], spots, made, axis=0) if "value" in known else made
            known["key"], known["value"] = np.insert(known["key"], spots, unique[new]), value
        return out[back]

    @cached_property
    def importances(self) -> np.ndarray:
        """Gain by feature, a share in each tree, averaged over trees that have any."""
        gains = []
        for tree in self.trees:
            inner = tree["feature"] >= 0
            gains.append(np.bincount(tree["feature"][inner], tree["gain"][inner], minlength=len(self.features)))
        return _mean_share(gains, len(self.features))

    def depth(self, tree: int = 0) -> int:
        return int(np.log2(self.trees[tree]["id"].max())) if len(self.trees) > tree else 0

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns with ``prediction``, or with ``y_pred`` and ``score`` (the share of the last class)."""

        def made(forest: Forest, x: np.ndarray) -> dict[str, pa.Array]:
            got = forest.predict_each(x) if len(x) else np.zeros((0, 2))
            if forest.classes is None:
                return {"prediction": pa.array(got.reshape(len(x), -1)[:, 0])}
            names = np.array(forest.classes, np.int32)
            return {"y_pred": pa.array(names[got.argmax(1)] if len(x) else names[:0]), "score": pa.array(got[:, -1])}

        return scored(df, self, keep, "prediction double" if self.classes is None else "y_pred int, score double", made)

    def nodes(self, tree: int = 0) -> list[tuple]:
        """(node, feature, limit, rows, value) of one tree, in heap order."""
        t = self.trees[tree]
        names = [None if f < 0 else self.features[f] for f in t["feature"].tolist()]
        return list(zip(t["id"].tolist(), names, t["limit"].tolist(), t["rows"].tolist(), t["value"].tolist(), strict=True))


def _mean_share(gains: Sequence[np.ndarray], size: int) -> np.ndarray:
    shares = [gain / gain.sum() for gain in gains if gain.sum() > 0]
    mean = np.mean(shares, axis=0) if shares else np.zeros(size)
    return mean / mean.sum() if mean.sum() > 0 else mean


def mean_shares(rows: Sequence, size: int) -> np.ndarray:
    """Importances from gains by (tree, node, feature): as ``Forest.importances`` has them."""
    gains: dict[int, np.ndarray] = {}
    for r in sorted(rows, key=lambda r: (r["tree"], r["node"], r["feature"])):
        gains.setdefault(r["tree"], np.zeros(size))[r["feature"]] += r["gain"]
    return _mean_share(list(gains.values()), size)


@dataclass(frozen=True)
class Weighed:
    """What is left of a forest whose trees stayed on the executors: importances, and the accuracy on its own rows."""

    features: tuple[str, ...]
    importances: np.ndarray
    accuracy: float | None


def limits(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Cut points of each feature; a value belongs to the first bin whose cut point is not below it."""
    value = {c: F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in features}
    probs = [(i + 1) / bins for i in range(bins - 1)]
    about = df.agg(*[F.approx_count_distinct(value[c]) for c in features]).first()
    # A set of a feature of few values, quantiles of another.
    few = [(n or 0) <= bins for n in about]
    found = df.agg(*[F.collect_set(value[c]) if f else F.percentile_approx(value[c], probs, 10_000) for c, f in zip(features, few, strict=True)]).first()
    out = []
    for f, v in zip(few, found, strict=True):
        v = sorted(set(v or []))
        out.append([(a + b) / 2 for a, b in zip(v, v[1:], strict=False)] if f else v)
    return out


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """The number of cut points below the value, by a tree of comparisons."""
    if not len(cuts):
        return F.lit(0)
    middle = len(cuts) // 2
    further = bin_of(value, cuts[middle + 1 :]) + (middle + 1)
    return F.when(value <= float(cuts[middle]), bin_of(value, cuts[:middle])).otherwise(further)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _mixed(state: np.ndarray, number: np.ndarray) -> np.ndarray:
    """One more 32-bit number hashed into 64-bit states (XXH64, as the column function does it)."""
    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = (state + np.uint64(p5 + np.uint64(4))) ^ (number.astype(np.uint64) * p1)
    h = _turned(h, 23) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


# Shares of the Poisson distribution of mean one that are below 1, 2, ... 8, in units of 2 ** -32.
_BELOW = np.ceil(np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 8)])) * 2.0**32).astype(np.uint32)
# Draws that are made at once.
DRAWS = 1 << 14


def _draws(row: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """(trees, rows): Poisson numbers of mean one from the rows' hashes and the trees."""
    low = _mixed(_mixed(row[None, :], trees[:, None]), np.array([[seed & 0xFFFFFFFF]])).astype(np.uint32)
    out = np.zeros(low.shape, np.uint8)
    for below in _BELOW:
        out += low >= below
    return out


def _drawn(rows: DataFrame, names: list[str], trees: int, sums: int, seed: int, undrawn: bool) -> DataFrame:
    """(tree, packed bins, n, s0, ...) of the draws of all trees, summed by cell as far as a partition's order allows.

    The rows of a partition are sorted by cell and drawn a batch at a time, so that a task holds one batch and no table
    of cells, and the trees times the rows are never rows themselves.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = [batch.column(n).to_numpy() for n in names]
            row = batch.column("_state").to_numpy().view(np.uint64)
            values = [batch.column(f"_v{i}").to_numpy() for i in range(sums)]
            new = np.concatenate([[True], np.any([p[1:] != p[:-1] for p in packed], axis=0)]) if len(row) > 1 else np.array([True])
            edges = np.flatnonzero(new)
            step = max(1, DRAWS // len(row))
            for first in range(0, trees, step):
                tree = np.arange(first, min(first + step, trees))
                k = _draws(row, tree, seed).astype(np.float64)
                n = np.add.reduceat(k, edges, axis=1)
                some = np.ones(n.shape, bool) if undrawn else n > 0
                at, cell = np.nonzero(some)
                arrays = [pa.array(tree[at], pa.int32()), *[pa.array(p[edges][cell]) for p in packed], pa.array(n[some].astype(np.int64))]
                arrays += [pa.array(np.add.reduceat(k * v, edges, axis=1)[some]) for v in values]
                yield pa.RecordBatch.from_arrays(arrays, ["tree", *names, "n", *[f"s{i}" for i in range(sums)]])

    schema = f"tree int, {', '.join(f'{n} long' for n in names)}, n long, {', '.join(f's{i} double' for i in range(sums))}"
    # Scans may have few tasks, and the draws are the work. A cell's rows go to a sixth of the tasks, so that they are
    # summed there and yet one large cell is no task's alone.
    spark = rows.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(tasks, *names, F.pmod(F.xxhash64("_state"), F.lit(max(4, tasks // 6))))
    return dealt.sortWithinPartitions(*names).mapInArrow(run, schema)


def _packed(features: Sequence[str], cuts: list[list[float]]) -> list[Column]:
    """Nine bins of seven bits in one number, which groups faster than an array does."""
    values = [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in features]
    found = [bin_of(v, c).cast("bigint") for v, c in zip(values, cuts, strict=True)]
    return [sum((F.shiftleft(b, 7 * j) for j, b in enumerate(found[i + 1 : i + 9], 1)), found[i]).alias(f"_p{i}") for i in range(0, len(found), 9)]


def cells(
    df: DataFrame, features: Sequence[str], target: str, cuts: list[list[float]], classes: Sequence | None, trees: int, bootstrap: bool, weight: str | None, seed: int, undrawn: bool = False
) -> DataFrame:
    """(tree, node, bins, n, s0, s1, ...): the cells of all trees, all at their root; ``undrawn`` keeps those that a tree
    drew no row of, with n = 0."""
    w = F.lit(1.0) if weight is None else col(weight).cast("double")
    y = col(target).cast("double")
    names = [f"_p{i}" for i in range(0, len(features), 9)]
    rows = df.filter(col(target).isNotNull()).select(
        *_packed(features, cuts), y.alias("_y"), w.alias("_w"), F.xxhash64(*[col(c) for c in df.columns]).alias("_row")
    )
    if classes is None:
        sums = [F.col("_w"), F.col("_w") * F.col("_y"), F.col("_w") * F.col("_y") ** 2]
    else:
        sums = [F.when(F.col("_y") == float(c), F.col("_w")).otherwise(0.0) for c in classes]
    if bootstrap:
        wide = rows.select(*names, F.xxhash64("_row").alias("_state"), *[s.alias(f"_v{i}") for i, s in enumerate(sums)])
        parts = _drawn(wide, names, trees, len(sums), seed, undrawn)
        summed = parts.groupBy("tree", *names).agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(sums))])
    else:
        one = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(sums)])
        summed = one.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    bins = [F.shiftright(f"_p{i - i % 9}", 7 * (i % 9)).bitwiseAND(F.lit(127)).cast("tinyint") for i in range(len(features))]
    return summed.withColumn("bins", F.array(*bins)).withColumn("node", F.lit(1).cast("bigint")).drop(*names)


def impurity(sums: Sequence, kind: str, log, divide):
    """Weight times impurity of a node with these sums; works on columns and on arrays."""
    if kind == "variance":
        return sums[2] - divide(sums[1] * sums[1], sums[0])
    total = sum(sums[1:], sums[0])
    if kind == "entropy":
        return sum((-s * log(s, total) for s in sums[1:]), -sums[0] * log(sums[0], total))
    return total - divide(sum((s * s for s in sums[1:]), sums[0] * sums[0]), total)


def _log_columns(s: Column, total: Column) -> Column:
    return F.when(s > 0, F.log2(F.try_divide(s, total))).otherwise(0.0)


def _log_arrays(s: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.log2(np.where(s > 0, s, 1.0) / np.where(s > 0, total, 1.0))


IN_COLUMNS, IN_ARRAYS = (_log_columns, F.try_divide), (_log_arrays, np.divide)


@dataclass(frozen=True)
class Rules:
    kind: str
    depth: int
    min_split: int
    min_leaf: int
    min_gain: float
    subset: int
    bins: int
    seed: int


def split_nodes(counted: DataFrame, names: list[str], size: int, rules: Rules) -> DataFrame:
    """(tree, node, n, s..., feature, bin, gain, lc, rc) of every node: its best split, or nulls, and the drawn cells on
    both sides. ``counted`` has the sums and the drawn cells (c) by (tree, node, feature, bin)."""
    if rules.subset < size:
        drawn = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda f: F.struct(F.xxhash64("tree", "node", f, F.lit(rules.seed)).alias("h"), f.alias("f"))))
        allowed = F.transform(F.slice(drawn, 1, rules.subset), lambda s: s["f"])
        seen = F.array_contains(allowed, F.col("feature"))
    else:
        seen = F.lit(True)
    whole = Window.partitionBy("tree", "node", "feature")
    below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = counted.select(
        "tree", "node", "feature", "bin", F.sum("n").over(below).alias("ln"), F.sum("n").over(whole).alias("n"), F.sum("c").over(below).alias("lc"), F.sum("c").over(whole).alias("c"),
        *[F.sum(s).over(below).alias(f"l{s}") for s in names], *[F.sum(s).over(whole).alias(s) for s in names],
    )
    left, all_ = [F.col(f"l{s}") for s in names], [F.col(s) for s in names]
    right = [a - b for a, b in zip(all_, left, strict=True)]
    fits = seen & (F.col("ln") >= rules.min_leaf) & (F.col("n") - F.col("ln") >= rules.min_leaf) & (F.col("n") >= rules.min_split)
    gain = impurity(all_, rules.kind, *IN_COLUMNS) - impurity(left, rules.kind, *IN_COLUMNS) - impurity(right, rules.kind, *IN_COLUMNS)
    total = all_[0] if rules.kind == "variance" else sum(all_[1:], all_[0])
    fits = fits & (F.col("ln") < F.col("n"))
    # Rounded, so that splits that are equal but for the order of sums tie.
    gain = F.round(gain, 6)
    best = F.when(
        fits & (gain > 1e-12 * total) & (gain >= rules.min_gain * total),
        F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), F.col("lc"), (F.col("c") - F.col("lc")).alias("rc")),
    )
    found = sums.groupBy("tree", "node").agg(F.max("n").alias("n"), *[F.first(s).alias(s) for s in names], F.max(best).alias("best"))
    return found.select(
        "tree", "node", "n", *names, (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin"), F.col("best.gain").alias("gain"), "best.lc", "best.rc"
    )


class Tops:
    """The splits of large nodes: they are few, and say in which node of its tree a cell is."""

    def __init__(self, splits: dict[tuple[int, int], tuple[int, int]], trees: int):
        nodes = [(t, 1) for t in range(trees)]
        for tree, node in splits:
            nodes += [(tree, 2 * node), (tree, 2 * node + 1)]  # side by side
        place = {key: i for i, key in enumerate(nodes)}
        self.heap = np.array([node for _, node in nodes], np.int64)
        self.tree = np.array([tree for tree, _ in nodes], np.int64)
        self.feature, self.limit, self.left = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        for (tree, node), (feature, limit) in splits.items():
            i = place[tree, node]
            self.feature[i], self.limit[i], self.left[i] = feature, limit, place[tree, 2 * node]

    def places(self, tree: np.ndarray, bins: np.ndarray) -> np.ndarray:
        at = tree.astype(np.int64)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = self.left[node] + (bins[inner, self.feature[node]] > self.limit[node])


def _batch(batch: pa.RecordBatch, size: int, names: list[str]) -> tuple[np.ndarray, ...]:
    bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return batch.column("tree").to_numpy(), bins, batch.column("n").to_numpy().astype(float), np.column_stack([batch.column(s).to_numpy() for s in names])


def _histogram(state: DataFrame, tops: Tops, large: list[tuple[int, int]], names: list[str], size: int) -> DataFrame:
    """(tree, node, feature, bin, c, n, s...) of the large nodes, summed in each task before anything is shuffled."""
    asked = {key: i for i, key in enumerate(large)}
    slots = np.array([asked.get(key, -1) for key in zip(tops.tree.tolist(), tops.heap.tolist(), strict=True)])
    k = len(names) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size, len(large) * 128))
        for batch in batches:
            tree, bins, n, sums = _batch(batch, size, names)
            slot = slots[tops.places(tree, bins)]
            here = slot >= 0
            if not here.any():
                continue
            slot, bins, values = slot[here] * 128, bins[here], [(n[here] > 0).astype(float), n[here], *sums[here].T]
            for f in range(size):
                place = slot + bins[:, f]
                for j, v in enumerate(values):
                    total[j, f] += np.bincount(place, v, minlength=len(large) * 128)
        feature, place = np.nonzero(total[0])
        key = np.array(large, np.int64).reshape(-1, 2)[place // 128]
        arrays = [pa.array(key[:, 0], pa.int32()), pa.array(key[:, 1]), pa.array(feature, pa.int32()), pa.array(place % 128, pa.int32())]
        arrays += [pa.array(total[0, feature, place].astype(np.int64)), *[pa.array(total[j, feature, place]) for j in range(1, k)]]
        yield pa.RecordBatch.from_arrays(arrays, ["tree", "node", "feature", "bin", "c", "n", *names])

    schema = f"tree int, node long, feature int, bin int, c long, n double, {', '.join(f'{s} double' for s in names)}"
    parts = state.select("tree", "bins", "n", *names).mapInArrow(run, schema)
    return parts.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("c", "n", *names)])


class _Words:
    """Bins of all features side by side in 64-bit words, and where each feature has its bits."""

    def __init__(self, bins: np.ndarray):
        self.used = bins.max(0).astype(np.int64) + 1 if len(bins) else np.ones(bins.shape[1], np.int64)
        bits = [max(int(u - 1).bit_length(), 1) for u in self.used]
        word, shift, full = [], [], [0]
        for b in bits:
            if full[-1] + b > 62:
                full.append(0)
            word.append(len(full) - 1)
            shift.append(full[-1])
            full[-1] += b
        self.word, self.shift, self.mask = np.array(word), np.array(shift, np.int64), np.array([(1 << b) - 1 for b in bits], np.int64)
        self.words = [np.zeros(len(bins), np.int64) for _ in full]
        for f, (w, s) in enumerate(zip(word, shift, strict=True)):
            self.words[w] |= bins[:, f].astype(np.int64) << s

    def take(self, order: np.ndarray) -> None:
        self.words = [w[order] for w in self.words]

    def of(self, cells: np.ndarray) -> _Words:
        out = copy(self)
        out.take(cells)
        return out

    def bins(self, feature: np.ndarray | int, at: np.ndarray, some: slice = slice(None)) -> np.ndarray:
        """The bin of each cell (of ``some``) in one feature, or in that of its node (``at``)."""
        words, at = [w[some] for w in self.words], at[some]
        if np.ndim(feature) == 0:
            return (words[self.word[feature]] >> self.shift[feature]) & self.mask[feature]
        out = words[0]
        if len(words) > 1:
            word = self.word[feature][at]
            out = np.choose(word, words) if len(words) <= 32 else np.stack(words)[word, np.arange(len(word))]
        out = out >> self.shift[feature][at]
        masks = self.mask[feature]
        out &= masks[0] if (masks == masks[0]).all() else masks[at]
        return out


# Sums of whole numbers below this share one number: n + HIGH * s1.
HIGH = 1 << 26


class _Sums:
    """The columns n, s0, s1, ... of cells, added up by some key. Whole numbers of two classes travel as one column, which
    is as exact; others as they are, each added in the order of the cells."""

    def __init__(self, n: np.ndarray, sums: np.ndarray):
        whole = sums.shape[1] == 2 and n.sum() < HIGH and (sums >= 0).all() and np.array_equal(sums.sum(1), n) and np.array_equal(sums, np.rint(sums))
        self.whole = whole
        self.columns = [n + HIGH * sums[:, 1]] if whole else [n.astype(float), *(np.ascontiguousarray(s) for s in sums.T)]

    def take(self, order: np.ndarray) -> None:
        self.columns = [c[order] for c in self.columns]

    def by(self, key: np.ndarray, size: int, some: slice = slice(None)) -> list[np.ndarray]:
        return [np.bincount(key, c[some], minlength=size) for c in self.columns]

    def apart(self, sums: list[np.ndarray]) -> list[np.ndarray]:
        if not self.whole:
            return sums
        high = np.floor(sums[0] * (1.0 / HIGH))
        n = sums[0] - high * HIGH
        return [n, n - high, high]


def grow_local(start: int, bins: np.ndarray | _Words, n: np.ndarray, sums: np.ndarray, rules: Rules, tree: int) -> dict[str, np.ndarray]:
    """The subtree below node ``start`` from its cells, level by level; arrays by node, and the leaf of each cell.

    The cells stay in order; those of a finished node leave, also from ``bins`` that come in words.
    """
    parts: list[dict[str, np.ndarray]] = []
    held, added = bins if isinstance(bins, _Words) else _Words(bins), _Sums(n, sums)
    level, width, cells = int(np.log2(start)), len(held.used), len(n)
    random = np.random.default_rng([rules.seed, tree, start])
    some = np.flatnonzero(held.used > 1)
    # ``ids``: the nodes of a level; ``asked``: those that may be split; ``at``: the place of each cell's node among these.
    ids, at, source, leaf, before = np.array([start], np.int64), np.zeros(cells, np.int64), np.arange(cells), np.zeros(cells, np.int64), 0
    totals = np.stack(added.apart(added.by(at, 1)), 1)
    asked = np.flatnonzero(_asked(totals, np.array([cells]), rules, level))
    if not len(asked):
        at, source = at[:0], source[:0]
    while True:
        gain, feature, limit = np.zeros(len(ids)), np.full(len(ids), -1), np.zeros(len(ids), np.int64)
        drawn = None
        if level < rules.depth and rules.subset < width:
            drawn = random.random((len(ids), width))[asked]
            drawn = np.sort(np.argpartition(drawn, rules.subset - 1, axis=1)[:, : rules.subset], axis=1)
        if len(asked):
            columns = [(f, int(held.used[f])) for f in some.tolist()] if drawn is None else [(drawn[:, j], int(held.used.max())) for j in range(rules.subset)]
            best, won, spot = _best(columns, held, added, totals[asked], at, rules)
            gain[asked], feature[asked], limit[asked] = best, np.where(best > 0, won, -1), np.where(best > 0, spot, 0)
        parts.append({"id": ids, "feature": feature, "bin": limit, "gain": gain, "totals": totals})
        inner = np.flatnonzero(feature >= 0)
        if not len(inner):
            leaf[source] = before + asked[at]
            break
        # The children of a node lie side by side; without a split it has one, which is no node and lets its cells go.
        split = feature[asked] >= 0
        slot = np.where(split, 2 * (np.cumsum(split) - 1), 2 * len(inner))
        right = held.bins(np.where(split, feature[asked], 0), at) > limit[asked][at]
        child = slot[at]
        child += right
        if not split.all():
            gone = np.flatnonzero(child >= 2 * len(inner))
            leaf[source[gone]] = before + asked[at[gone]]
            child[gone] = 2 * len(inner)
        before += len(ids)
        ids = np.stack([2 * ids[inner], 2 * ids[inner] + 1], 1).ravel()
        level += 1
        totals = np.stack(added.apart(added.by(child, len(ids) + 1)), 1)[:-1]
        asks = _asked(totals, np.bincount(child, minlength=len(ids) + 1)[:-1], rules, level)
        asked = np.flatnonzero(asks)
        if len(asked) == len(ids) and split.all():
            at = child
            continue
        place = np.full(len(ids) + 1, -1)
        place[asked] = np.arange(len(asked))
        at = place[child]
        ended = np.flatnonzero((at < 0) & (child < len(ids)))
        leaf[source[ended]] = before + child[ended]
        stays = np.flatnonzero(at >= 0)
        at, source = at[stays], source[stays]
        held.take(stays)
        added.take(stays)
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]} | {"leaf": leaf}


def _fallen(grown: dict[str, np.ndarray], held: _Words) -> np.ndarray:
    """The leaf of each cell of a subtree that was grown without it; ``held`` is used up."""
    left = np.searchsorted(grown["id"], 2 * grown["id"])
    at = np.zeros(len(held.words[0]), np.int64)
    out, source = at.copy(), np.arange(len(at))
    while len(at):
        ended = grown["feature"][at] < 0
        if ended.any():
            out[source[ended]] = at[ended]
            stays = np.flatnonzero(~ended)
            at, source = at[stays], source[stays]
            held.take(stays)
        at = left[at] + (held.bins(grown["feature"], at) > grown["bin"][at])
    return out


def _asked(totals: np.ndarray, cells: np.ndarray, rules: Rules, level: int) -> np.ndarray:
    """The nodes that may be split: enough rows, more than one cell, not of one class."""
    if level >= rules.depth:
        return np.zeros(len(totals), bool)
    asked = (totals[:, 0] >= max(rules.min_split, 2 * rules.min_leaf)) & (cells > 1)
    if rules.kind != "variance":
        with np.errstate(all="ignore"):
            asked &= impurity(list(totals[:, 1:].T), rules.kind, *IN_ARRAYS) > 1e-7  # the gain would be rounded to nothing
    return asked


def _best(columns, held: _Words, added: _Sums, totals: np.ndarray, at: np.ndarray, rules: Rules) -> tuple[np.ndarray, ...]:
    """(gain, feature, bin) of the best split of each node; a gain of 0 where there is none. ``columns``: features, one
    for all nodes or one for each, with their number of bins; of equal gains the first counts."""
    count = len(totals)
    best, feature, limit = np.zeros(count), np.full(count, -1), np.zeros(count, np.int64)
    weight = totals[:, 1] if rules.kind == "variance" else totals[:, 1:].sum(1)
    least = np.maximum(1e-12, rules.min_gain) * weight
    with np.errstate(all="ignore"):
        own = impurity(list(totals[:, 1:].T), rules.kind, *IN_ARRAYS)
    for f, used in columns:
        mine = np.broadcast_to(f, count)
        for nodes, spots, left in _sides(at, held, f, added, used, count):
            whole, right = totals[nodes], []
            for j, side in enumerate(left):
                right.append(whole[:, j, None] - side)
            with np.errstate(all="ignore"):
                gain = own[nodes, None] - impurity(left[1:], rules.kind, *IN_ARRAYS) - impurity(right[1:], rules.kind, *IN_ARRAYS)
            ok = (left[0] >= max(rules.min_leaf, 1)) & (right[0] >= max(rules.min_leaf, 1))
            gain = np.round(gain, 6)
            gain = np.where(ok & (gain > least[nodes, None]), gain, 0.0)
            spot = gain.argmax(1)
            top = gain[np.arange(len(spot)), spot]
            better = top > best[nodes]
            won = np.arange(count)[nodes][better]
            best[won], feature[won] = top[better], mine[won]
            limit[won] = spot[better] if spots is None else spots[better, spot[better]]
    return best, feature, limit


def _sides(at: np.ndarray, held: _Words, feature: np.ndarray | int, added: _Sums, used: int, nodes: int) -> Iterator[tuple[np.ndarray | slice, np.ndarray | None, list[np.ndarray]]]:
    """(nodes, bins, sums at or below each bin): a row for each node (``at``), a column for each bin but the last
    (None: all).

    Few nodes, or few bins, have a column for every bin. Otherwise each node has one for the bins that its cells are in,
    and nodes with like numbers of bins go together: the work grows with the cells, not with the nodes times the bins.
    """
    if used < 2:
        return
    if nodes * used <= max(len(at), 2 * len(at) if used <= 4 else 0):
        # Many cells by blocks, which stay in the processor's cache; fractions are added in one go, as their order counts.
        step = BLOCK if added.whole and 4 * nodes * used <= BLOCK else max(len(at), 1)
        total = None
        for a in range(0, len(at), step):
            some = slice(a, a + step)
            key = held.bins(feature, at, some)
            key += at[some] * used
            part = added.by(key, nodes * used, some)
            total = part if total is None else [t + p for t, p in zip(total, part, strict=True)]
        yield slice(None), None, added.apart([t.reshape(nodes, used).cumsum(1)[:, :-1] for t in total])
        return
    bits = int(len(at)).bit_length()
    key = np.sort(((at * 128 + held.bins(feature, at)) << bits) | np.arange(len(at)))
    spot, key = key & ((1 << bits) - 1), key >> bits
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.empty(len(at), np.int64)
    group[spot] = np.cumsum(new) - 1
    key = key[new]
    owner, bin_ = key >> 7, key & 127
    sums = added.by(group, len(key))
    many = np.bincount(owner, minlength=nodes)
    rank = np.arange(len(owner)) - (np.cumsum(many) - many)[owner]
    size = np.ceil(np.log2(np.maximum(many, 1))).astype(np.int64)
    for one in np.unique(size[many > 1]).tolist():
        mine = np.flatnonzero((size == one) & (many > 1))
        row = np.full(nodes, -1)
        row[mine] = np.arange(len(mine))
        take = np.flatnonzero(row[owner] >= 0)
        shape, r, c = (len(mine), 1 << one), row[owner[take]], rank[take]
        left = []
        for s in sums:
            wide = np.zeros(shape)
            wide[r, c] = s[take]
            left.append(wide.cumsum(1))
        spots = np.zeros(shape, np.int64)
        spots[r, c] = bin_[take]
        yield mine, spots, added.apart(left)


def _split_large(state: DataFrame, names: list[str], size: int, rules: Rules, trees: int, local_cells: int) -> tuple[Tops | None, list[dict]]:
    """The nodes with more than ``local_cells`` drawn cells, split level by level: each level is one pass over the stored
    cells, which stay where they are, and the splits (a few for each ``local_cells`` cells) are collected."""
    counts = state.groupBy("tree", "node").agg(F.count_if(F.col("n") > 0).alias("c")).collect()
    large = sorted((r["tree"], r["node"]) for r in counts if r["c"] > local_cells)
    splits: dict[tuple[int, int], tuple[int, int]] = {}
    told: list[dict] = []
    ship_package(state.sparkSession)
    step = max(1, HISTOGRAM // (128 * size))
    while large:
        tops, deeper = Tops(splits, trees), []
        for first in range(0, len(large), step):
            counted = _histogram(state, tops, large[first : first + step], names, size)
            for r in split_nodes(counted, names, size, rules).collect():
                node = r.asDict()
                if int(np.log2(r["node"])) >= rules.depth:
                    node.update(feature=None, bin=None, gain=None)
                told.append(node)
                if node["feature"] is not None:
                    splits[r["tree"], r["node"]] = (r["feature"], r["bin"])
                    deeper += [(r["tree"], 2 * r["node"] + i) for i, c in enumerate((r["lc"], r["rc"])) if c > local_cells]
        large = sorted(deeper)
    return (Tops(splits, trees) if told else None), told


def grow(start: DataFrame, size: int, n_sums: int, rules: Rules, trees: int, local_cells: int = LOCAL_CELLS, cells: int | None = None, keep: str = "trees") -> DataFrame:
    """(tree, node, n, s..., feature, bin, gain) of all nodes of all trees. ``start`` has ``cells`` rows; without that
    number it is counted, and so read twice. With ``keep`` = "gains" there is a row for each grown subtree and feature,
    with the sum of its gains; "leaves" adds one for each tree and cell, with the cell's packed bins (p0, ...) and the
    sums of the leaf that it falls into."""
    spark = start.sparkSession
    names = [f"s{i}" for i in range(n_sums)]
    columns = ["tree", "node", "bins", "n", *names]
    state = start.select(*columns)
    total = start.count() if cells is None else cells
    tops, told = _split_large(state, names, size, rules, trees, local_cells) if total > local_cells else (None, [])
    if tops is not None:
        ended = {(r["tree"], r["node"]) for r in told if r["feature"] is None}
        rest = np.array([key not in ended for key in zip(tops.tree.tolist(), tops.heap.tolist(), strict=True)])

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tree, bins, *_ = _batch(batch, size, names)
                at = tops.places(tree, bins)
                moved = batch.set_column(batch.schema.get_field_index("node"), "node", pa.array(tops.heap[at]))
                yield moved.filter(pa.array(rest[at]))

        whole, state = state, state.mapInArrow(placed, state.schema)
    schema = f"tree int, node long, n double, {', '.join(f'{s} double' for s in names)}, feature int, bin int, gain double"
    packs = range(0, size, 9)
    if keep != "trees":
        schema += "".join(f", p{i} long" for i in packs)
    ship_package(spark)

    def rows(tree, node, totals, feature, bin_, gain, packed=None) -> pa.RecordBatch:
        count = len(feature)
        arrays = [pa.array(np.broadcast_to(tree, count).copy(), pa.int32()), pa.array(node, pa.int64()), *[pa.array(totals[:, j].astype(float)) for j in range(n_sums + 1)]]
        arrays += [pa.array(feature, pa.int32()), pa.array(bin_, pa.int32()), pa.array(gain, pa.float64())]
        if keep != "trees":
            arrays += [pa.nulls(count, pa.int64()) for _ in packs] if packed is None else [pa.array(p) for p in packed]
        return pa.RecordBatch.from_arrays(arrays, ["tree", "node", "n", *names, "feature", "bin", "gain", *([f"p{i}" for i in packs] if keep != "trees" else [])])

    def cells_of(tree, node, totals, bins) -> Iterator[pa.RecordBatch]:
        wide = bins.astype(np.int64)
        packed = [sum(wide[:, i + j] << (7 * j) for j in range(min(9, size - i))) for i in packs]
        for a in range(0, len(wide), 1 << 17):
            b = slice(a, a + (1 << 17))
            none = np.full(len(wide[b]), -1)
            yield rows(tree if np.isscalar(tree) else tree[b], node[b], totals[b], none, none, none.astype(float), [p[b] for p in packed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            bins, n, sums = (np.concatenate(x) for x in zip(*held, strict=True))
            got = grow_local(place[1], bins, n, sums, rules, place[0])
            if keep == "trees":
                yield rows(place[0], got["id"], got["totals"], got["feature"], got["bin"], got["gain"])
                return
            inner = got["feature"] >= 0
            gains = np.bincount(got["feature"][inner], got["gain"][inner], minlength=size)
            yield rows(place[0], np.full(size, place[1]), np.zeros((size, n_sums + 1)), np.arange(size), np.zeros(size, np.int64), gains)
            if keep == "leaves":
                yield from cells_of(place[0], got["id"][got["leaf"]], got["totals"][got["leaf"]], bins)

        for batch in batches:
            tree, bins, n, sums = _batch(batch, size, names)
            node = batch.column("node").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])])) if len(tree) else []
            for a, b in zip(edges, [*edges[1:], len(tree)], strict=True):
                here = (int(tree[a]), int(node[a]))
                if here != place and held:
                    yield from finish()
                    held = []
                place = here
                held.append((bins[a:b], n[a:b], sums[a:b]))
        if held:
            yield from finish()

    # Without large nodes every tree is one subtree.
    roots = trees if tops is None else int((tops.feature < 0).sum())
    tasks = max(1, min(roots, 4 * spark.sparkContext.defaultParallelism) if tops is None else max(-(-roots // 8), min(roots, 4 * spark.sparkContext.defaultParallelism)))
    dealt = state.repartition(tasks, "tree", "node").sortWithinPartitions("tree", "node", "bins")
    out = dealt.mapInArrow(run, schema)
    if told:
        filled = [
            (r["tree"], r["node"], float(r["n"]), *[float(r[s]) for s in names], *((-1, 0, 0.0) if r["feature"] is None else (r["feature"], r["bin"], r["gain"])))
            for r in told
            if keep == "trees" or r["feature"] is not None
        ]
        if keep != "trees":
            filled = [(*r, *[None for _ in packs]) for r in filled]
        if filled:
            out = out.union(spark.createDataFrame(filled, schema))
        if keep == "leaves" and ended:
            sums = {(r["tree"], r["node"]): [float(r[c]) for c in ("n", *names)] for r in told}
            table = np.array([sums.get(key, [0.0] * (n_sums + 1)) for key in zip(tops.tree.tolist(), tops.heap.tolist(), strict=True)])

            def stayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                """The cells of large nodes that were not split: their leaf is known."""
                for batch in batches:
                    tree, bins, *_ = _batch(batch, size, names)
                    at = tops.places(tree, bins)
                    here = np.flatnonzero(~rest[at])
                    yield from cells_of(tree[here], tops.heap[at[here]], table[at[here]], bins[here])

            out = out.union(whole.mapInArrow(stayed, schema))
    return out


def tree_of(rows, cuts: list[list[float]], value: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of one tree from its rows in heap order (pandas)."""
    ids, feature, at = rows["node"].to_numpy(), rows["feature"].to_numpy(), rows["bin"].to_numpy()
    limit = np.array([cuts[f][b] if f >= 0 else np.nan for f, b in zip(feature, at, strict=True)])
    left = np.searchsorted(ids, 2 * ids)
    gain, n = rows["gain"].to_numpy(), rows["n"].to_numpy()
    return {"id": ids, "feature": feature, "bin": at, "limit": limit, "gain": gain, "rows": n, "value": value, "left": left}


def fit(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    classes: Sequence | None = None,
    trees: int = 1,
    depth: int = DEEPEST,
    min_split: int = 2,
    min_leaf: int = 1,
    min_gain: float = 0.0,
    subset: str = "all",
    criterion: str = "gini",
    bootstrap: bool = False,
    weight: str | None = None,
    bins: int = BINS,
    seed: int = 42,
    local_cells: int = LOCAL_CELLS,
    cuts: list[list[float]] | None = None,
    keep: str = "trees",
    held: Gathered | None = None,
) -> Forest | Weighed:
    """Trees of ``classes`` (their target values, in order), or of a numeric target without them.

    ``keep`` = "gains" collects the gains by tree and feature only, for forests whose trees are too large for the driver;
    "leaves" works out the accuracy on the rows as well, on the executors. ``held``: what ``gather`` made of the rows, with
    these features among others.
    """
    if depth > DEEPEST:
        raise ValueError(f"trees deeper than {DEEPEST} are not to be had; got {depth}")
    if bins > 127:
        raise ValueError(f"at most 127 bins; got {bins}")
    require_columns(df, *features, target)
    labelled = df.filter(col(target).isNotNull())
    cuts = limits(labelled, features, bins) if cuts is None else cuts
    size = len(features)
    drawn = max(1, int(np.sqrt(size))) if subset == "sqrt" else size
    kind = "variance" if classes is None else criterion
    rules = Rules(kind, depth, min_split, min_leaf, min_gain, drawn, max(bins, 2), seed)
    n_sums = 3 if classes is None else len(classes)
    if keep != "trees" and bootstrap and classes and weight is None:
        whole = gather(labelled, features, target, cuts, classes, local_cells) if held is None else held
        if whole is not None:
            return _weigh_gathered(df.sparkSession, whole, features, trees, rules, keep)
    start = cells(labelled, features, target, cuts, classes, trees, bootstrap, weight, seed, keep == "leaves")
    with reused(start) as kept:  # a lost block is drawn again, with the same draws
        nodes = grow(kept, size, n_sums, rules, trees, local_cells, keep=keep)
        if keep != "trees":
            return _weigh(nodes, labelled, features, target, cuts, classes, n_sums, keep)
        found = nodes.toPandas()
    out = []
    for _, rows in found.groupby("tree", sort=True):
        rows = rows.sort_values("node")
        sums = rows[[f"s{i}" for i in range(n_sums)]].to_numpy()
        out.append(tree_of(rows, cuts, sums[:, 1:2] / sums[:, :1] if classes is None else sums / sums.sum(1, keepdims=True)))
    return Forest(tuple(features), None if classes is None else tuple(classes), out)


@dataclass(frozen=True)
class Gathered:
    """The labelled rows of a small table: bins by feature, the hashes that draws are made from, and class numbers."""

    features: tuple[str, ...]
    bins: np.ndarray
    state: np.ndarray
    label: np.ndarray
    classes: int

    @cached_property
    def _cells(self) -> dict[tuple[str, ...], tuple[_Words, np.ndarray]]:
        return {}

    def cells(self, features: tuple[str, ...]) -> tuple[_Words, np.ndarray]:
        """(bins of each cell, the cell and class of each row in one number) by these features; a worker remembers the
        last ones."""
        if features not in self._cells:
            self._cells.clear()
            held = _Words(self.bins[:, [self.features.index(f) for f in features]])
            order = np.argsort(held.words[0]) if len(held.words) == 1 else np.lexsort(held.words)
            new = np.concatenate([[True], np.any([w[order[1:]] != w[order[:-1]] for w in held.words], axis=0)])
            place = np.empty(len(order), np.int64)
            place[order] = (np.cumsum(new) - 1) * self.classes
            self._cells[features] = held.of(order[new]), place + self.label
        return self._cells[features]

    def drawn(self, tree: int, seed: int) -> np.ndarray:
        """How often the tree draws each row."""
        parts = [_draws(self.state[a : a + DRAWS], np.array([tree]), seed)[0] for a in range(0, len(self.state), DRAWS)]
        return np.concatenate(parts).astype(np.float64)

    def counts(self, place: np.ndarray, cells: int, times: np.ndarray | None = None) -> np.ndarray:
        """(cells, classes): rows of each class, each as often as it was drawn."""
        return np.bincount(place, times, minlength=cells * self.classes).reshape(cells, self.classes)


def gather(df: DataFrame, features: Sequence[str], target: str, cuts: list[list[float]], classes: Sequence, local_cells: int = LOCAL_CELLS) -> Gathered | None:
    """The rows of a table that is small enough: every tree's drawn rows are ``LOCAL_CELLS`` at most (a draw leaves out
    more than a third of the rows), and all rows take ``GATHERED`` bytes at most. None for other tables."""
    labelled = df.filter(col(target).isNotNull())
    rows = labelled.count()
    if not rows or rows > local_cells * 3 // 2 or rows * (len(features) + 9) > GATHERED:
        return None
    names = [f"_p{i}" for i in range(0, len(features), 9)]
    y = col(target).cast("double")
    label = F.coalesce(*[F.when(y == float(c), F.lit(i)) for i, c in enumerate(classes)]).cast("tinyint")
    table = labelled.select(*_packed(features, cuts), F.xxhash64(F.xxhash64(*[col(c) for c in df.columns])).alias("_state"), label.alias("_label")).toArrow()
    bins = np.empty((table.num_rows, len(features)), np.int8)
    for i in range(len(features)):
        bins[:, i] = (table.column(names[i // 9]).to_numpy() >> (7 * (i % 9))) & 127
    return Gathered(tuple(features), bins, table.column("_state").to_numpy().view(np.uint64), table.column("_label").to_numpy(), len(classes))


def _weigh_gathered(spark, held: Gathered, features: Sequence[str], trees: int, rules: Rules, keep: str) -> Weighed:
    """Each tree drawn and grown in one task; its gains, and with "leaves" the sums by cell of the class shares of a
    task's trees, are all that leaves it."""
    ship_package(spark)
    sent, own, k = spark.sparkContext.broadcast(held), tuple(features), held.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        held, place = table.cells(own)
        size, total = len(held.words[0]), None
        for tree in (t for batch in batches for t in batch.column(0).to_pylist()):
            sums = table.counts(place, size, table.drawn(tree, rules.seed))
            n = sums @ np.ones(k)
            some = np.flatnonzero(n)
            if not len(some):
                continue
            got = grow_local(1, held.of(some), n[some], sums[some], rules, tree)
            inner = got["feature"] >= 0
            gains = np.bincount(got["feature"][inner], got["gain"][inner], minlength=len(own))
            yield made(tree=np.full(len(own), tree), feature=np.arange(len(own)), gain=gains)
            if keep == "leaves":
                leaf, rest = np.empty(size, np.int64), np.flatnonzero(n == 0)
                leaf[some], leaf[rest] = got["leaf"], _fallen(got, held.of(rest))
                weight = got["totals"][:, 1:].sum(1)
                total = np.zeros((k, size)) if total is None else total
                for i in range(k):
                    total[i] += (got["totals"][:, i + 1] / weight)[leaf]
        if total is not None:
            for a in range(0, size, 1 << 17):
                b = slice(a, a + (1 << 17))
                yield made(cell=np.arange(size)[b], **{f"v{i}": total[i, b] for i in range(k)})

    kinds = {"tree": pa.int32(), "feature": pa.int32(), "gain": pa.float64(), "cell": pa.int64()} | {f"v{i}": pa.float64() for i in range(k)}

    def made(**columns: np.ndarray) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in kinds.items()], list(kinds))

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = sent.value.cells(own)
        seen = sent.value.counts(place, len(held.words[0]))
        for batch in batches:
            hits = seen[batch.column("cell").to_numpy(), batch.column("said").to_numpy()].sum()
            yield pa.RecordBatch.from_arrays([pa.array([int(hits)])], ["hits"])

    # Sums by cell are sent once for each task, gains cost next to nothing.
    cores = spark.sparkContext.defaultParallelism
    tasks = min(trees, 2 * cores if keep == "leaves" else trees)
    schema = "tree int, feature int, gain double, cell long, " + ", ".join(f"v{i} double" for i in range(k))
    grown = spark.range(0, trees, 1, tasks).mapInArrow(run, schema)
    try:
        if keep == "gains":
            return Weighed(own, mean_shares(grown.select("tree", F.lit(1).alias("node"), "feature", "gain").collect(), len(own)), None)
        summed = grown.groupBy("cell", "tree", "feature").agg(F.sum("gain").alias("gain"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(k)])
        with reused(summed) as both:
            gains = both.filter("cell is null").select("tree", F.lit(1).alias("node"), "feature", "gain").collect()
            shares = F.array(*[F.round(f"v{i}", 9) for i in range(k)])
            said = both.filter("cell is not null").select("cell", (F.array_position(shares, F.array_max(shares)) - 1).alias("said"))
            hits = said.mapInArrow(right, "hits long").agg(F.sum("hits")).first()[0]
        return Weighed(own, mean_shares(gains, len(own)), hits / len(held.label))
    finally:
        sent.destroy()


def _weigh(nodes: DataFrame, rows: DataFrame, features: Sequence[str], target: str, cuts: list[list[float]], classes: Sequence | None, n_sums: int, keep: str) -> Weighed:
    """The gains, and the accuracy of the trees' mean class shares, from grown gains and leaves."""
    if keep == "gains":
        return Weighed(tuple(features), mean_shares(nodes.collect(), len(features)), None)
    packs = [f"p{i}" for i in range(0, len(features), 9)]
    total = sum((F.col(f"s{i}") for i in range(1, n_sums)), F.col("s0"))
    gain = F.col("feature") >= 0
    # One pass over the grown rows: gains stay by subtree, leaves are summed over the trees.
    summed = nodes.groupBy(*packs, *[F.when(gain, F.col(c)).alias(c) for c in ("tree", "node", "feature")]).agg(
        F.sum("gain").alias("gain"), *[F.sum(F.try_divide(F.col(f"s{i}"), total)).alias(f"v{i}") for i in range(n_sums)]
    )
    with reused(summed) as both:
        means = mean_shares(both.filter("feature is not null").collect(), len(features))
        shares = F.array(*[F.round(f"v{i}", 9) for i in range(n_sums)])
        said = both.filter("feature is null").select(*packs, (F.array_position(shares, F.array_max(shares)) - 1).alias("said"))
        seen = rows.select(*[p.alias(n) for p, n in zip(_packed(features, cuts), packs, strict=True)], col(target).cast("double").alias("_y"))
        counts = seen.groupBy(*packs).agg(F.count(F.lit(1)).alias("c"), *[F.count_if(F.col("_y") == float(c)).alias(f"c{i}") for i, c in enumerate(classes)])
        right = F.element_at(F.array(*[F.col(f"c{i}") for i in range(n_sums)]), (F.col("said") + 1).cast("int"))
        accuracy = counts.join(said, packs).agg((F.sum(right) / F.sum("c")).alias("a")).first()["a"]
    return Weighed(tuple(features), means, accuracy)
