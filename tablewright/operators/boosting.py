"""Boosted trees that stop when held-out rows stop getting better.

Rows are reduced to cells of equal bins once; a cell's margin is the same for all its rows, so the margins are a
column of the stored cells and every round is a few jobs over them: one tree is grown on the residuals (see
``growing``), its leaves take Newton steps, the margins move, and the loss of the training and of the held-out
cells is summed. After ``patience`` rounds without a held-out loss that is lower by ``tolerance`` the fit ends, and
the model goes back to its best round; the later trees stay in it for staged scores.

Null features count as 0; rows without a target are left out; without held-out rows all rounds are made and kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import col
from tablewright.operators import growing
from tablewright.operators.project import require_columns
from tablewright.session import durable, ship_package

# Rounds after which the margins are stored, so that their expression stays short.
STORE_EVERY = 8


@dataclass(frozen=True)
class Boosted:
    features: tuple[str, ...]
    logistic: bool
    base: float
    rate: float
    trees: list[dict[str, np.ndarray]]
    # (training, held-out) mean loss after every round; the second is nan without held-out rows.
    losses: list[tuple[float, float]]
    best: int

    def margins(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The margin after each round."""
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total = total + self.rate * growing.values_at(tree, x)[:, 0]
            yield total

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns with ``prediction``, or with ``y_pred`` and ``score``, after the best round."""

        def made(model: Boosted, x: np.ndarray) -> dict[str, pa.Array]:
            margin = np.full(len(x), model.base)
            for i, margin in enumerate(model.margins(x)):
                if i + 1 == model.best:
                    break
            if not model.logistic:
                return {"prediction": pa.array(margin)}
            return {"y_pred": pa.array((margin > 0).astype(np.int32)), "score": pa.array(1 / (1 + np.exp(-margin)))}

        return growing.scored(df, self, keep, "y_pred int, score double" if self.logistic else "prediction double", made)

    @property
    def importances(self) -> np.ndarray:
        return growing.Forest(self.features, None, self.trees[: self.best]).importances

    def staged(self, df: DataFrame, label: str, split: str) -> DataFrame:
        """(split, iteration, accuracy) of the classes after every round, the ones behind the best included."""
        require_columns(df, *self.features, label, split)
        ship_package(df.sparkSession)
        sent = df.sparkSession.sparkContext.broadcast(self)
        x = F.array(*[F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in self.features])
        slim = df.filter(col(label).isNotNull()).select(col(split).cast("boolean").alias("split"), col(label).cast("int").alias("y"), x.alias("x"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = sent.value
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(model.features))
                part, y = np.array(batch.column("split").to_pylist()), batch.column("y").to_numpy()
                rows = [
                    (side, i + 1, int(((margin > 0) == y)[part == side].sum()), int((part == side).sum()))
                    for i, margin in enumerate(model.margins(x))
                    for side in (True, False)
                ]
                kinds = (pa.bool_(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["split", "iteration", "right", "n"])

        counted = slim.mapInArrow(run, "split boolean, iteration int, right long, n long").groupBy("split", "iteration")
        return counted.agg((F.sum("right") / F.sum("n")).alias("accuracy"))


def _leaf_values(tree: dict[str, np.ndarray], node: int, place: dict[int, int]) -> Column:
    """The tree as an expression over the cells' bins."""
    i = place[node]
    if tree["feature"][i] < 0:
        return F.lit(float(tree["value"][i, 0]))
    test = F.element_at("bins", int(tree["feature"][i]) + 1) <= int(tree["bin"][i])
    return F.when(test, _leaf_values(tree, 2 * node, place)).otherwise(_leaf_values(tree, 2 * node + 1, place))


def rounds_kept(held_out: Sequence[float], patience: int, tolerance: float) -> tuple[int, bool]:
    """The best round of a series of losses (from 1) and whether ``patience`` rounds have passed since."""
    best, least = 0, np.inf
    for i, loss in enumerate(held_out):
        if loss < least - tolerance:
            best, least = i + 1, loss
    return best, len(held_out) - best >= patience


def fit(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    logistic: bool,
    rounds: int = 100,
    rate: float = 0.1,
    depth: int = 3,
    min_split: int = 2,
    min_leaf: int = 1,
    held_out: Column | None = None,
    patience: int = 5,
    tolerance: float = 1e-4,
    bins: int = growing.BINS,
    seed: int = 42,
) -> Boosted:
    """``held_out``: a condition for the rows that only judge."""
    require_columns(df, *features, target)
    rows = df.filter(col(target).isNotNull())
    cuts = growing.limits(rows, features, bins)
    judge = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    parts = [
        growing.cells(rows.filter(judge if side else ~judge), features, target, cuts, None, 1, False, None, seed).withColumn("judge", F.lit(side))
        for side in ([False, True] if held_out is not None else [False])
    ]
    cells = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cells = cells.select("bins", "judge", F.col("s0").alias("w"), F.col("s1").alias("sy"), F.col("s2").alias("syy"))
    first = cells.filter("not judge").agg(F.sum("w").alias("w"), F.sum("sy").alias("sy")).first()
    share = (first["sy"] / first["w"]) if first["w"] else 0.0
    if logistic:
        share = min(max(share, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share))) if logistic else float(share)
    state = durable(cells.withColumn("margin", F.lit(base)))
    total = state.filter("not judge").count()
    rules = growing.Rules("variance", depth, min_split, min_leaf, 0.0, len(features), max(bins, 2), seed)
    w, sy, m = F.col("w"), F.col("sy"), F.col("margin")
    p = 1 / (1 + F.exp(-m))
    residual, slope = (sy - w * p, w * p * (1 - p)) if logistic else (sy - w * m, w)
    # log(1 + e^m) without overflow.
    loss = w * (F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))) - sy * m if logistic else F.col("syy") - 2 * m * sy + w * m * m
    trees: list[dict[str, np.ndarray]] = []
    losses: list[tuple[float, float]] = []
    best, done = 0, False
    while len(trees) < rounds and not done:
        start = state.filter("not judge").select(
            F.lit(0).alias("tree"), F.lit(1).cast("bigint").alias("node"), "bins", F.col("w").cast("double").alias("n"),
            w.alias("s0"), residual.alias("s1"), F.lit(0.0).alias("s2"), slope.alias("s3"),
        )
        nodes = growing.grow(start, len(features), 4, rules, 1, cells=total).toPandas().sort_values("node")
        value = nodes["s1"].to_numpy() / np.maximum(nodes["s3"].to_numpy(), 1e-12)
        tree = growing.tree_of(nodes, cuts, value[:, None])
        place = {int(n): i for i, n in enumerate(tree["id"])}
        state = state.withColumn("margin", m + rate * _leaf_values(tree, 1, place))
        trees.append(tree)
        if len(trees) % STORE_EVERY == 0:
            state = durable(state)
        sums = {r["judge"]: r["loss"] / r["w"] for r in state.groupBy("judge").agg(F.sum(loss).alias("loss"), F.sum("w").alias("w")).collect() if r["w"]}
        losses.append((sums.get(False, float("nan")), sums.get(True, float("nan"))))
        if True in sums:
            best, done = rounds_kept([b for _, b in losses], patience, tolerance)
        else:
            best = len(trees)
    return Boosted(tuple(features), logistic, base, rate, trees, losses, best)
