"""Approximate nearest neighbours by low-dimensional stable projections.

Vectors are projected on ``DIMS`` Gaussian directions (2-stable: a projected squared distance over the true one follows a
chi-square law with ``DIMS`` degrees of freedom).  The projections are indexed by a kd-tree: its upper levels, fitted on a
bounded sample, cut the space into cells that Spark partitions by, and each cell is cut further where it is searched.
A query takes leaves by growing projected distance and verifies their rows against the original vectors, until the
chi-square test says that a nearer row is unlikely to be left: CDF(r^2 / d_k^2) >= ``CONFIDENCE`` for the distance r of the next leaf
and the k-th best distance d_k so far.  First every query searches its own cell; then the same test, with the d_k found
there, picks the other cells it has to visit.

Largest inner products become nearest distances by one more component: sqrt(M^2 - |x|^2) for rows, 0 for queries (scaled to
length M), with M the largest norm.

Equal vectors may be a third of all rows: they are one distinct vector with its k + 1 smallest ids, which is all a top-k
can use.  Cells that are still large are dealt to blocks.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or are not of the most frequent
length (ties: the longer) take no part; ties in score go to the smaller id; repeated ids: the smallest vector by value of an id
counts; fewer than k candidates give fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.operators.materialize import stored

DIMS, CONFIDENCE, SEED = 8, 0.97, 20240817
#: Rows the upper tree is fitted on, the rows one cell aims at, and the most cells (their boxes are broadcast: 1 MB).
SAMPLE, CELL_ROWS, MOST_CELLS = 40_000, 4_000, 8_192
#: Rows of a leaf inside a cell, rows of a block of a large cell, queries that meet a block in one group.
LEAF, BLOCK, QUERIES = 128, 16_000, 4_000


def chi_square_quantile(p: float, dims: int) -> float:
    """Quantile of the chi-square law with an even number of degrees of freedom, by bisection of its closed form."""
    half = dims // 2

    def cdf(x: float) -> float:
        term = total = 1.0
        for i in range(1, half):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 10.0 * dims + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


@dataclass
class Tree:
    """A kd-tree of cells: inner nodes as (axis, value, left, right), leaves as negative numbers; boxes per cell."""

    nodes: list[tuple[int, float, int, int]]
    low: np.ndarray
    high: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int32)
        if not self.nodes:
            return out
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            axis, value, left, right = self.nodes[node]
            goes = points[rows, axis] < value
            for child, part in ((left, rows[goes]), (right, rows[~goes])):
                if child < 0:
                    out[part] = -child - 1
                elif len(part):
                    todo.append((child, part))
        return out


def grow(points: np.ndarray, leaf: int) -> tuple[Tree, list[np.ndarray]]:
    """Splits at the median of the widest axis until a leaf holds at most ``leaf`` points or only equal ones."""
    dims = points.shape[1]
    nodes: list[tuple[int, float, int, int]] = []
    low, high, members = [], [], []

    def split(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> int:
        spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(dims)
        axis = int(np.argmax(spread))
        value = float(np.median(points[rows, axis])) if len(rows) > leaf else 0.0
        goes = points[rows, axis] < value
        if len(rows) > leaf and spread[axis] and not goes.any():  # the median is the least value: split above it
            value = float(points[rows, axis][points[rows, axis] > value].min())
            goes = points[rows, axis] < value
        if len(rows) <= leaf or not spread[axis]:
            low.append(lo)
            high.append(hi)
            members.append(rows)
            return -len(members)
        at = len(nodes)
        nodes.append((axis, value, 0, 0))
        below, above = hi.copy(), lo.copy()
        below[axis] = above[axis] = value
        left = split(rows[goes], lo, below)
        nodes[at] = (axis, value, left, split(rows[~goes], above, hi))
        return at

    split(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf))
    return Tree(nodes, np.array(low), np.array(high)), members


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.empty((len(points), len(low)))
    for start in range(0, len(points), 256):
        p = points[start : start + 256, None, :]
        out[start : start + 256] = (np.maximum(0, np.maximum(low - p, p - high)) ** 2).sum(axis=2)
    return out


class _Space:
    """The projection, for rows and for queries, with the lift from inner product to distance."""

    def __init__(self, dim: int, most: float):
        self.most = most
        self.axes = np.random.default_rng(SEED).standard_normal((dim + 1, DIMS))

    def rows(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.most**2 - (v * v).sum(axis=1)))
        return np.column_stack((v, rest)) @ self.axes

    def queries(self, v: np.ndarray) -> np.ndarray:
        return (v * (self.most / np.linalg.norm(v, axis=1))[:, None]) @ self.axes[:-1]


def _matrix(column, dim: int) -> np.ndarray:
    return np.array(column.to_list() if hasattr(column, "to_list") else column, dtype=np.float64).reshape(-1, dim)


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, float] | None:
    """(id, v, norm2) of all rows that take part, their length and the largest norm."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & (F.size("v") > 0) & finite)
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        .filter(F.col("norm2") > 0)
    )
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max("norm2").alias("most"))
    top = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    if top is None:
        return None
    return rows.filter(F.size("v") == top["dim"]), top["dim"], math.sqrt(top["most"])


def _per_cell(values: dict[int, int]):
    """The number of parts of each row's cell, 1 where the table of cells says nothing."""
    more = [F.lit(x) for c, n in values.items() if n > 1 for x in (c, n)]
    return F.coalesce(F.try_element_at(F.create_map(*more), F.col("cell")), F.lit(1)) if more else F.lit(1)


_FOUND = "q long, group long, score double"


def _search(queries: pd.DataFrame, block: pd.DataFrame, space: _Space, dim: int, k: int) -> pd.DataFrame:
    """The k best distinct vectors of one block for each query; ``d2`` is the query's k-th best squared distance so far."""
    v = _matrix(block["v"], dim)
    ids = block["group"].to_numpy()
    projected = _matrix(block["p"], DIMS)
    q = _matrix(queries["v"], dim)
    qp = _matrix(queries["p"], DIMS)
    norm = np.linalg.norm(q, axis=1)
    most2 = space.most**2
    tree, members = grow(projected, LEAF)
    boxes = np.array([projected[m].min(axis=0) for m in members]), np.array([projected[m].max(axis=0) for m in members])
    away = box_distance(qp, *boxes)
    order = np.argsort(away, axis=1, kind="stable")
    factor = chi_square_quantile(CONFIDENCE, DIMS)
    best = np.full((len(q), k), -np.inf)
    owner = np.full((len(q), k), -1, dtype=np.int64)
    bound = queries["d2"].to_numpy().astype(float)  # inf where unknown
    active = np.arange(len(q))
    for step in range(len(members)):
        leaf = order[active, step]
        far = away[active, leaf]
        active, leaf = active[far <= factor * bound[active]], leaf[far <= factor * bound[active]]
        if not len(active):
            break
        for one in np.unique(leaf):
            who, rows = active[leaf == one], members[one]
            scores = q[who] @ v[rows].T
            all_scores = np.concatenate((best[who], scores), axis=1)
            all_ids = np.concatenate((owner[who], np.broadcast_to(ids[rows], scores.shape)), axis=1)
            top = np.argpartition(-all_scores, k - 1, axis=1)[:, :k]
            best[who] = np.take_along_axis(all_scores, top, axis=1)
            owner[who] = np.take_along_axis(all_ids, top, axis=1)
        worst = best[active].min(axis=1)
        # squared distance of the lifted, scaled vectors that belongs to an inner product
        d2 = np.where(np.isfinite(worst), 2 * most2 - 2 * worst * space.most / norm[active], np.inf)
        bound[active] = np.minimum(bound[active], np.maximum(d2, 0))
    at, slot = np.nonzero(owner >= 0)
    # exact scores, one product order whatever the block: sum of the componentwise products
    index = {g: i for i, g in enumerate(ids)}
    rows = np.array([index[g] for g in owner[at, slot]], dtype=np.int64)
    score = np.array([math.fsum(x) for x in q[at] * v[rows]]) if len(rows) else np.empty(0)
    return pd.DataFrame({"q": queries["q"].to_numpy()[at], "group": owner[at, slot], "score": score})


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    cleaned = _clean(vectors, id_col, vec_col)
    if cleaned is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, dim, most = cleaned
    space = _Space(dim, most)
    # distinct vectors with the k + 1 smallest ids each; only those can be among a top k
    single = rows.groupBy("id").agg(F.min("v").alias("v"))
    digest = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2")]
    marked = stored(single.select("id", "v", *digest), "vectors")
    least = Window.partitionBy("h1", "h2").orderBy("id")
    owners = stored(
        marked.select("id", "h1", "h2").withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= k + 1), "owners"
    )
    heads = owners.filter("nth = 1").select("id", F.col("id").alias("group"))
    distinct = marked.join(heads, "id").select("group", "v", "h1", "h2")
    project_rows = F.pandas_udf(lambda v: pd.Series(list(space.rows(_matrix(v, dim)))), "array<double>")
    indexed = stored(distinct.withColumn("p", project_rows("v")), "projected")
    total = indexed.count()

    sample = indexed.select("group", "p").orderBy(F.xxhash64("group"), "group").limit(SAMPLE).select("p")
    points = _matrix([r["p"] for r in sample.toLocalIterator()], DIMS)
    cells = max(1, min(MOST_CELLS, total // CELL_ROWS))
    tree, _ = grow(points, max(1, math.ceil(len(points) / cells)))
    held = spark.sparkContext.broadcast(tree)
    cell_of = F.pandas_udf(lambda p: pd.Series(held.value.cells(_matrix(p, DIMS))), "int")
    placed = stored(indexed.withColumn("cell", cell_of("p")), "cells")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row a cell
    blocks = {c: math.ceil(n / BLOCK) for c, n in sizes.items()}

    # queries: distinct vectors of the rows asked for
    asked = marked.filter(F.col("id") % every == 0).select("id", "h1", "h2")
    wanted = (
        asked.groupBy("h1", "h2").agg(F.min("id").alias("one")).join(placed, ["h1", "h2"]).select(F.col("group").alias("q"), "v", "cell")
    )
    project_queries = F.pandas_udf(lambda v: pd.Series(list(space.queries(_matrix(v, dim)))), "array<double>")
    asking = stored(wanted.withColumn("p", project_queries("v")), "queries")

    def searched(side: DataFrame) -> DataFrame:
        side = stored(side, "visits")
        visits = {r["cell"]: r["n"] for r in side.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        chunks = _per_cell({c: math.ceil(n / QUERIES) for c, n in visits.items()})
        n_blocks = _per_cell(blocks)
        asked_ = side.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))).withColumn(
            "chunk", F.pmod(F.xxhash64("q"), chunks).cast("int")
        )
        parts = placed.select(
            "cell",
            F.pmod(F.xxhash64("group"), n_blocks).cast("int").alias("block"),
            "group",
            "v",
            "p",
            F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"),
        )

        def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"q": np.empty(0, np.int64), "group": np.empty(0, np.int64), "score": np.empty(0)})
            return _search(left, right, space, dim, k + 1)

        keys = ["cell", "block", "chunk"]
        return asked_.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInPandas(both, _FOUND)

    own = stored(searched(asking.withColumn("d2", F.lit(float("inf")))), "own")
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "group")
    kth = own.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") == k + 1).select("q", F.col("score").alias("kth"))
    bounded = asking.join(kth, "q", "left")
    factor = chi_square_quantile(CONFIDENCE, DIMS)

    def visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = held.value
        for batch in batches:
            frame = batch.to_pandas()
            for start in range(0, len(frame), 1000):
                part = frame.iloc[start : start + 1000]
                v = _matrix(part["v"], dim)
                d2 = 2 * space.most**2 - 2 * part["kth"].to_numpy(float) * space.most / np.linalg.norm(v, axis=1)
                d2 = np.where(np.isnan(d2), np.inf, np.maximum(d2, 0))
                near = box_distance(_matrix(part["p"], DIMS), tree.low, tree.high) <= (factor * d2)[:, None]
                near[np.arange(len(part)), part["cell"].to_numpy()] = False
                at, cell = np.nonzero(near)
                out = part.iloc[at][["q", "v", "p"]].assign(d2=d2[at], cell=cell.astype(np.int32))
                yield pa.RecordBatch.from_pandas(
                    out[["q", "v", "p", "cell", "d2"]],
                    schema=pa.schema(
                        [("q", pa.int64()), ("v", pa.list_(pa.float64())), ("p", pa.list_(pa.float64())), ("cell", pa.int32()), ("d2", pa.float64())]
                    ),
                    preserve_index=False,
                )

    others = bounded.select("q", "v", "p", "cell", "kth").mapInArrow(
        visits, "q long, v array<double>, p array<double>, cell int, d2 double"
    )
    found = own.unionByName(searched(others))
    best = found.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= k + 1).drop("r")

    # back to ids: every asked row of a distinct query vector, every kept owner of a distinct found vector
    keys = indexed.select("group", "h1", "h2")
    answers = (
        asked.join(keys.withColumnRenamed("group", "q"), ["h1", "h2"])
        .select("q", F.col("id").alias("query_id"))
        .join(best, "q")
        .join(keys.join(owners.select("id", "h1", "h2"), ["h1", "h2"]).select("group", F.col("id").alias("vec_id")), "group")
        .filter("vec_id <> query_id")
    )
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
