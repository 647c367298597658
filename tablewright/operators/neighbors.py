"""Exact k-nearest neighbours without a cross join.

Training rows are dealt into cells whose number grows with the rows: boxes of a k-d tree in few dimensions, regions around
pivots in many. A query first meets one block of its own cell, which bounds the distance of its k-th neighbour; only
then does it go to the other blocks that can hold something closer. Queries and blocks meet by an equi-join key, blocks are
bounded on both sides, and a block emits only its k best rows per query. Inside a block few dimensions are searched by a
tree again; many are multiplied out in tiles, and what the bound lets through is measured exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalar import col, md5_bits
from tablewright.session import durable, ship_package

MAX_PIVOTS = 4096
# Regions around pivots are compared with every query, and overlap in many dimensions.
MAX_REGIONS = 256
BLOCK_BYTES, LEAST_ROWS, MOST_ROWS = 32 << 20, 4096, 65_536
QUERY_ROWS = 16_384
# Up to so many dimensions boxes are searched.
BOX_DIMS = 6
SAMPLE_ROWS = 32
LEAF_ROWS = 64
PAIRS = 1 << 20
QUERY_SLICE, TILE = 256, 4096
TWO_POW_32 = 4294967296


def as_vector(df: DataFrame, features: Sequence[str], output: str = "vector") -> DataFrame:
    return df.withColumn(output, F.array(*[col(c).cast("double") for c in features]))


def _whole(vector: str) -> Column:
    """The vector as doubles; a null vector, or one that holds a null, stops the job: it has no distance."""
    v = col(vector).cast("array<double>")
    return F.when(v.isNotNull() & ~F.exists(v, lambda x: x.isNull()), v).otherwise(F.raise_error(F.lit(f"{vector} holds a null")).cast("array<double>"))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.asarray(series.tolist(), dtype=np.float64)


def _rows(table: pa.Table, column: str) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    lists = table.column(column).combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)


def _slack(q: np.ndarray, t: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Allowance for the cancellation in ``_distances``: about 1e-8 of the vectors' lengths."""
    scale = np.sqrt((q * q).sum(1)) + np.sqrt((t * t).sum(1).max())
    return 1e-6 * (scale + np.where(np.isfinite(bound), bound, 0.0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _exact(qs: np.ndarray, ts: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    step = max(1, PAIRS * 4 // max(1, qs.shape[1]))
    parts = [np.sqrt(((qs[rows[i : i + step]] - ts[cols[i : i + step]]) ** 2).sum(1)) for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _best(rows: np.ndarray, cols: np.ndarray, exact: np.ndarray, tid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k smallest (distance, id) of every row, in that order."""
    order = np.lexsort((tid[cols], exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    first = np.r_[True, rows[1:] != rows[:-1]][: len(rows)]
    kept = np.arange(len(rows)) - np.flatnonzero(first)[np.cumsum(first) - 1] < k
    return rows[kept], cols[kept], exact[kept]


class _Boxes:
    """A k-d tree over points, cut at medians along the widest side until ``leaf`` points are left."""

    def __init__(self, points: np.ndarray, leaf: int):
        axis, at, below, above = [], [], [], []
        self.members: list[np.ndarray] = []
        todo = [(np.arange(len(points)), None, None)]
        while todo:
            own, parent, side = todo.pop()
            inside = points[own]
            width = np.nan_to_num(inside.max(0) - inside.min(0), nan=0.0) if len(own) > leaf else np.zeros(1)
            j = int(width.argmax()) if width.size else 0
            if not width.size or not width[j] > 0:
                here = ~len(self.members)
                self.members.append(own)
            else:
                x = inside[:, j]
                cut = np.partition(x, len(x) // 2)[len(x) // 2]
                if cut <= x.min():
                    cut = x[x > x.min()].min()
                here = len(axis)
                axis.append(j), at.append(cut), below.append(0), above.append(0)
                todo += [(own[x < cut], here, below), (own[x >= cut], here, above)]
            if parent is None:
                self.root = here
            else:
                side[parent] = here
        self.axis, self.at = np.array(axis, dtype=np.int64), np.array(at, dtype=np.float64)
        self.kids = np.array([below, above], dtype=np.int64).T
        self.cells = len(self.members)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of every row, and its distance from the cell's centre, which a box does without."""
        node = np.full(len(x), self.root, dtype=np.int64)
        going = np.flatnonzero(node >= 0)
        while len(going):
            at = node[going]
            node[going] = self.kids[at, (x[going, self.axis[at]] >= self.at[at]).astype(np.int64)]
            going = going[node[going] >= 0]
        return ~node, np.zeros(len(x))

    def near(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that can hold a point within the row's bound."""
        bound = bound * (1 + 1e-9)
        rows, cells = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                rows.append(own), cells.append(np.full(len(own), ~node))
                continue
            v, cut = x[own, self.axis[node]], self.at[node]
            reach = bound[own] + 1e-12 * (np.abs(v) + abs(cut))
            for kid, there in zip(self.kids[node], (v - reach <= cut, v + reach >= cut), strict=True):
                if there.any():
                    todo.append((int(kid), own[there]))
        return np.concatenate(rows), np.concatenate(cells)


class _Regions:
    """Points belong to the nearest of some pivots; the triangle inequality rules regions out."""

    def __init__(self, centers: np.ndarray):
        self.centers, self.cells = centers, len(centers)
        self.radius = np.full(len(centers), np.inf)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _distances(x, self.centers).argmin(1)
        # Distances that bound others are measured directly, without cancellation.
        return cell, np.sqrt(((x - self.centers[cell]) ** 2).sum(1))

    def near(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = _distances(x, self.centers) - np.maximum(self.radius, 0.0)
        return np.nonzero(least <= (bound + _slack(x, self.centers, bound))[:, None])


def _search_boxes(qs: np.ndarray, ts: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of all that may be among the k nearest within the bound, by a tree over the rows."""
    tree = _Boxes(ts, max(LEAF_ROWS, 2 * k))
    wide = max(len(m) for m in tree.members)
    member = np.full((tree.cells, wide), -1)
    for i, m in enumerate(tree.members):
        member[i, : len(m)] = m
    padded = np.where((member >= 0)[:, :, None], ts[member], np.inf)
    step = max(1, PAIRS // (wide * max(1, ts.shape[1])))

    def measured(rows: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        return np.sqrt(((padded[leaves] - qs[rows][:, None, :]) ** 2).sum(2))

    limit = bound.copy()
    home = tree.place(qs)[0]
    if wide > k:
        for i in range(0, len(qs), step):
            own = np.arange(i, min(i + step, len(qs)))
            kth = np.partition(measured(own, home[own]), k - 1, axis=1)[:, k - 1]
            limit[own] = np.fmin(limit[own], kth)
    limit *= 1 + 1e-12
    rows, leaves = tree.near(qs, limit)
    found = []
    for i in range(0, len(rows), step):
        r, leaf = rows[i : i + step], leaves[i : i + step]
        d = measured(r, leaf)
        hit, place = np.nonzero((d <= limit[r][:, None]) & (member[leaf] >= 0))
        found.append((r[hit], member[leaf[hit], place], d[hit, place]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _search_tiles(qs: np.ndarray, ts: np.ndarray, tid: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by products of tiles. These are rounded, so what comes within their error of the bound is measured."""
    middle = ts.mean(0)
    q, t = qs - middle, ts - middle
    q2, t2 = (q * q).sum(1), (t * t).sum(1)
    long = np.sqrt(max(q2.max(), t2.max()))
    # Single precision where neither the squares nor their differences leave its range.
    kind = np.float32 if 1e-12 < long < 1e15 else np.float64
    error = (2 * qs.shape[1] + 16) * float(np.finfo(kind).eps) * (np.sqrt(q2) + np.sqrt(t2.max())) ** 2
    # One product gives t.t - 2 q.t, which is compared with the squared bound less q.q.
    left = np.ascontiguousarray(np.c_[-2.0 * q, np.ones(len(q))].astype(kind))
    right = np.ascontiguousarray(np.c_[t, t2].astype(kind))
    found = []
    for start in range(0, len(qs), QUERY_SLICE):
        end = min(start + QUERY_SLICE, len(qs))
        limit = bound[start:end].copy()
        have, many = [], 0
        for at in range(0, len(ts), TILE):
            product = left[start:end] @ right[at : at + TILE].T
            if at == 0 and product.shape[1] > k and not np.isfinite(limit).all():
                kth = np.partition(product, k - 1, axis=1)[:, k - 1].astype(np.float64)
                limit = np.fmin(limit, np.sqrt(np.maximum(kth + q2[start:end] + error[start:end], 0.0)))
            edge = limit * limit * (1 + 1e-9) - q2[start:end] + error[start:end]
            near = product <= np.nextafter(edge.astype(kind), kind(np.inf))[:, None]
            # Several times as fast as the hits of a matrix.
            rows, cols = np.divmod(np.flatnonzero(near.ravel()), near.shape[1])
            rows, cols = rows + start, cols + at
            exact = _exact(qs, ts, rows, cols)
            have.append((rows, cols, exact))
            many += len(rows)
            if many > 16 * k * QUERY_SLICE:
                # Many near copies: keep the best so far and tighten the limit.
                have = [_best(*(np.concatenate(c) for c in zip(*have, strict=True)), tid, k)]
                rows, _, exact = have[0]
                many = len(rows)
                last = np.flatnonzero(np.r_[rows[1:] != rows[:-1], True])
                full = last[np.bincount(rows - start, minlength=end - start)[rows[last] - start] >= k]
                limit[rows[full] - start] = np.fmin(limit[rows[full] - start], exact[full])
        found += have
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _search(qs: np.ndarray, ts: np.ndarray, tid: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance): for every query the k nearest rows by (distance, id), those beyond its bound left out."""
    if not len(qs) or not len(ts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    got = _search_boxes(qs, ts, k, bound) if 0 < qs.shape[1] <= BOX_DIMS else _search_tiles(qs, ts, tid, k, bound)
    return _best(*got, tid, k)


def _lists(values: np.ndarray, rows: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """One list for each of n rows; ``rows`` ascend. NaN becomes null."""
    offsets = np.r_[0, np.cumsum(np.bincount(rows, minlength=n))].astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind, from_pandas=True))


def _salted(key: str, salt: str) -> Column:
    """A hash of the key that owes nothing to the plain one, by which splits and folds choose rows."""
    return md5_bits(F.col(key), F.lit(salt))


def _numbers(values: Sequence[int]) -> Column:
    """An array of whole numbers as one constant."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<int>")


def nearest(
    queries: DataFrame,
    train: DataFrame,
    query_id: str,
    train_id: str,
    k: int,
    payload: str,
    vector: str = "vector",
    pivots: int = MAX_PIVOTS,
    block_rows: int | None = None,
) -> DataFrame:
    """(query_id, rank, distance, neighbor_id, payload): the k nearest by (distance, id), exactly.

    Ids are integers; rows without one take no part. A vector with a null raises; fill or drop such rows first. One with a
    NaN has no distance and takes no part. ``pivots`` is about the most cells. Both inputs are read more than once, so pass
    stored tables or cheap plans.
    """
    spark = queries.sparkSession
    ship_package(spark)
    t = train.select(col(train_id).cast("bigint").alias("tid"), col(payload).cast("double").alias("value"), _whole(vector).alias("tv"))
    q = queries.select(col(query_id).cast("bigint").alias("qid"), _whole(vector).alias("qv"))
    t = t.filter(F.col("tid").isNotNull() & ~F.exists("tv", F.isnan))
    q = q.filter(F.col("qid").isNotNull() & ~F.exists("qv", F.isnan))
    size = t.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("tv")).alias("dims")).first()
    n, dims = size["n"], size["dims"]
    if not n:
        return spark.createDataFrame([], _out_schema(query_id))
    query_rows = block_rows or QUERY_ROWS
    block_rows = block_rows or min(MOST_ROWS, max(LEAST_ROWS, BLOCK_BYTES // (8 * max(1, dims))))
    # Of identical vectors only the k smallest ids can ever be neighbours. The limit is applied
    # before the shuffle, so a vector copied a billion times moves k rows per partition.
    copies = Window.partitionBy("tv").orderBy("tid")
    t = t.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k).drop("_copy")

    boxes = dims <= BOX_DIMS
    cells = max(1, min(pivots, -(-n // block_rows), pivots if boxes else MAX_REGIONS))
    spots = np.zeros((1, dims))
    if cells > 1:
        wanted = max(256, cells * SAMPLE_ROWS) if boxes else max(256, 4 * cells)
        rows = train.select(col(train_id).cast("bigint").alias("tid"), _whole(vector).alias("tv"))
        rows = rows.filter(~F.exists("tv", F.isnan) & (_salted("tid", "spot") < F.lit(min(TWO_POW_32, wanted * TWO_POW_32 // n + 1))))
        taken = [r["tv"] for r in rows.select("tv").limit(2 * wanted).collect()]
        if taken:
            spots = np.unique(np.asarray(taken, dtype=np.float64), axis=0)
    if boxes:
        map_ = _Boxes(spots, -(-len(spots) // cells))
        map_.members = []
    else:
        map_ = _Regions(spots[np.random.default_rng(0).permutation(len(spots))[:cells]])

    @F.pandas_udf("struct<cell:int,reach:double>")
    def place(v: pd.Series) -> pd.DataFrame:
        cell, reach = map_.place(_matrix(v))
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": reach})

    count = np.zeros(map_.cells, dtype=np.int64)
    load = np.zeros(map_.cells, dtype=np.int64)
    if map_.cells == 1:
        t, q = t.withColumn("cell", F.lit(0)), q.withColumn("cell", F.lit(0))
        count[0], load[0] = n, q.count()
    else:
        t = durable(t.withColumn("_p", place("tv")).select("tid", "value", "tv", "_p.cell", "_p.reach"))
        q = q.withColumn("cell", place("qv")["cell"])
        radius = np.full(map_.cells, -np.inf)
        for row in t.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect():
            count[row["cell"]], radius[row["cell"]] = row["n"], row["radius"]
        map_.radius = radius
        for row in q.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
            load[row["cell"]] = row["n"]

    # A part is a block of a cell; parts are numbered through all cells. A query starts at one part of its cell.
    blocks = np.maximum(-(-count // block_rows), 1)
    base = np.r_[0, np.cumsum(blocks)]
    parts = int(base[-1])

    def part_of(key: str) -> Column:
        own = F.element_at(_numbers(blocks), F.col("cell") + 1)
        return (F.element_at(_numbers(base), F.col("cell") + 1) + _salted(key, "part") % own).cast("int")

    t = t.select("tid", "value", "tv", part_of("tid").alias("part"))
    # Blocks of many dimensions take long to start at: they meet fewer queries at a time, for even tasks.
    home_blocks = np.maximum(-(-load // (blocks * (query_rows if boxes else -(-query_rows // 4)))), 1)
    mixed = _salted("qid", "block")
    q = q.select(
        "qid", "qv", part_of("qid").alias("part"), (mixed % F.element_at(_numbers(home_blocks), F.col("cell") + 1)).cast("int").alias("qb")
    )
    per_part = np.repeat(home_blocks, blocks)

    def copied(per_part: Sequence[int]) -> DataFrame:
        """The rows of a part, once for each block of queries that comes to it."""
        times = F.element_at(_numbers(per_part), F.col("part") + 1)
        return t.filter(times > 0).withColumn("qb", F.explode(F.sequence(F.lit(0), times - 1)))

    home_kinds = pa.schema(
        [("qid", pa.int64()), ("qv", pa.list_(pa.float64())), ("bound", pa.float64()), ("near", pa.list_(pa.int32()))]
        + [("tid", pa.list_(pa.int64())), ("distance", pa.list_(pa.float64())), ("value", pa.list_(pa.float64()))]
    )

    def start(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows:
            return home_kinds.empty_table()
        qs, tid = _rows(a, "qv"), b.column("tid").to_numpy()
        rows, cols, exact = _search(qs, _rows(b, "tv"), tid, k, np.full(len(qs), np.inf))
        bound = np.full(len(qs), np.inf)
        found = np.bincount(rows, minlength=len(qs))
        full = found >= k
        bound[full] = exact[(np.cumsum(found) - 1)[full]]
        near_row = near_part = np.zeros(0, dtype=np.int64)
        if parts > 1:
            own = a.column("part")[0].as_py()
            pieces = []
            for i in range(0, len(qs), QUERY_ROWS):
                r, cell = map_.near(qs[i : i + QUERY_ROWS], bound[i : i + QUERY_ROWS])
                r, cell = r[count[cell] > 0] + i, cell[count[cell] > 0]
                times = blocks[cell]
                part = np.repeat(base[cell], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                r = np.repeat(r, times)
                r, part = r[part != own], part[part != own]
                order = np.argsort(r, kind="stable")
                pieces.append((r[order], part[order]))
            near_row, near_part = (np.concatenate(c) for c in zip(*pieces, strict=True))
        value = b.column("value").to_numpy()[cols].astype(np.float64)
        m = len(qs)
        return pa.Table.from_arrays(
            [a.column("qid"), a.column("qv").cast(home_kinds.field("qv").type), pa.array(bound), _lists(near_part, near_row, m, pa.int32())]
            + [_lists(tid[cols], rows, m, pa.int64()), _lists(exact, rows, m, pa.float64()), _lists(value, rows, m, pa.float64())],
            schema=home_kinds,
        )

    pair_kinds = pa.schema([("qid", pa.int64()), ("tid", pa.int64()), ("distance", pa.float64()), ("value", pa.float64())])

    def go_on(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pair_kinds.empty_table()
        tid = b.column("tid").to_numpy()
        rows, cols, exact = _search(_rows(a, "qv"), _rows(b, "tv"), tid, k, a.column("bound").to_numpy())
        value = pa.array(b.column("value").to_numpy()[cols].astype(np.float64), from_pandas=True)
        return pa.Table.from_arrays([pa.array(a.column("qid").to_numpy()[rows]), pa.array(tid[cols]), pa.array(exact, from_pandas=True), value], schema=pair_kinds)

    # A fixed partition count keeps adaptive execution from packing compute-heavy groups into few tasks.
    tasks, key = int(spark.conf.get("spark.sql.shuffle.partitions")), ("part", "qb")

    def met(left: DataFrame, right: DataFrame, how, schema: str) -> DataFrame:
        return left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)).applyInArrow(how, schema)

    lists = "tid array<bigint>, distance array<double>, value array<double>"
    first = met(q, copied(per_part * (np.repeat(load, blocks) > 0)), start, f"qid bigint, qv array<double>, bound double, near array<int>, {lists}")
    if parts > 1:
        first = durable(first)
    pairs = first.select("qid", F.explode(F.arrays_zip("tid", "distance", "value")).alias("_n")).select("qid", "_n.tid", "_n.distance", "_n.value")
    if parts > 1:
        asked = first.select("qid", "qv", "bound", F.explode("near").alias("part"))
        visits = np.zeros(parts, dtype=np.int64)
        for row in first.select(F.explode("near").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
            visits[row["part"]] = row["n"]
        visit_blocks = -(-visits // query_rows)
        asked = asked.withColumn("qb", (mixed % F.element_at(_numbers(visit_blocks), F.col("part") + 1)).cast("int"))
        pairs = pairs.unionByName(met(asked, copied(visit_blocks), go_on, "qid bigint, tid bigint, distance double, value double"))
    best = Window.partitionBy("qid").orderBy("distance", "tid")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(F.col("qid").alias(query_id), "rank", "distance", F.col("tid").alias("neighbor_id"), "value")
    )


def _out_schema(query_id: str) -> str:
    return f"{query_id} bigint, rank int, distance double, neighbor_id bigint, value double"


def knn_regression(neighbors: DataFrame, query_id: str, weights: str = "uniform", output: str = "prediction") -> DataFrame:
    """Mean neighbour value, plain or weighted by 1 / distance (exact hits win)."""
    if weights == "uniform":
        value = F.avg("value")
    else:
        inverse = F.when(F.col("distance") > 0, 1 / F.col("distance"))
        hits = F.avg(F.when(F.col("distance") == 0, F.col("value")))
        value = F.coalesce(hits, F.try_divide(F.sum(inverse * F.col("value")), F.sum(inverse)))
    return neighbors.groupBy(query_id).agg(value.alias(output))


def knn_classification(neighbors: DataFrame, query_id: str) -> DataFrame:
    """Majority class (ties: smallest), its vote share, and the neighbour distances' mean and deviation."""
    votes = neighbors.groupBy(query_id, F.col("value").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("distance").alias("d"), F.sum(F.col("distance") ** 2).alias("d2")
    )
    sums = votes.groupBy(query_id).agg(
        F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("best"), F.sum("n").alias("k"), F.sum("d").alias("d"), F.sum("d2").alias("d2")
    )
    mean = F.col("d") / F.col("k")
    return sums.select(
        query_id,
        F.col("best.label").cast("int").alias("y_pred"),
        (-F.col("best.n") / F.col("k")).alias("vote_share"),
        mean.alias("mean_distance"),
        F.sqrt(F.greatest(F.lit(0.0), F.col("d2") / F.col("k") - mean * mean)).alias("std_distance"),
    )


def distance_summary(neighbors: DataFrame) -> DataFrame:
    return neighbors.agg(F.avg("distance").alias("mean_distance"), F.stddev_pop("distance").alias("std_distance"))


def r2_by_k(neighbors: DataFrame, actuals: DataFrame, query_id: str, actual: str) -> DataFrame:
    """R^2 of the uniform regressor for every k up to the neighbours' depth, from one neighbour table."""
    upto = Window.partitionBy(query_id).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    running = neighbors.select(query_id, F.col("rank").alias("k"), F.avg("value").over(upto).alias("_p"))
    joined = running.join(actuals.select(query_id, col(actual).cast("double").alias("_y")), query_id)
    sums = joined.groupBy("k").agg(F.avg((F.col("_y") - F.col("_p")) ** 2).alias("mse"), F.var_pop("_y").alias("var"))
    return sums.select("k", (1 - F.try_divide("mse", F.nullif("var", F.lit(0.0)))).alias("r2"))


def accuracy_by_k(neighbors: DataFrame, actuals: DataFrame, query_id: str, label: str, ks: Sequence[int]) -> DataFrame:
    """Classifier accuracy for every wanted k from one neighbour table."""
    wide = neighbors.filter(F.col("rank") <= max(ks)).select(
        query_id, "rank", "value", F.explode(F.array(*[F.lit(int(x)) for x in ks])).alias("k")
    ).filter(F.col("rank") <= F.col("k"))
    votes = wide.groupBy(query_id, "k", "value").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy(query_id, "k").agg(F.min(F.struct((-F.col("n")).alias("n"), "value"))["value"].alias("_p"))
    joined = best.join(actuals.select(query_id, col(label).cast("double").alias("_y")), query_id)
    return joined.groupBy("k").agg(F.avg((F.col("_p") == F.col("_y")).cast("double")).alias("accuracy"))


def cross_validated_k(df: DataFrame, row_id: str, label: str, fold: str, folds: int, ks: Sequence[int], vector: str = "vector") -> DataFrame:
    """Mean out-of-fold accuracy for every k: one neighbour search per fold serves all k."""
    out: DataFrame | None = None
    for i in range(folds):
        held, rest = df.filter(col(fold) == i), df.filter(col(fold) != i)
        part = accuracy_by_k(nearest(held, rest, row_id, row_id, max(ks), label, vector), held, row_id, label, ks)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("k").agg(F.avg("accuracy").alias("accuracy"))
