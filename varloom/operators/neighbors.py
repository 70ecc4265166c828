"""Exact k nearest reference samples: a tree of medians whose cells are visited only where a box can be close enough.

Everything that grows with the references (the tree, its boxes, the rows by cell) is a written table; the driver sees only counts.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from varloom import vocab
from varloom.operators.materialize import stored
from varloom.operators.projection import scaled
from varloom.operators.scale import balanced_sides

#: Reference samples a cell aims at, and queries that meet one copy of a cell's rows.  Vectors that are sent per pair fall with
#: both; a part of 8 MB of doubles at 64 components is still small for a task.
CELL_ROWS, QUERIES = 16_000, 8_000
#: Rows per open node that its cuts are fitted on.
FITTED = 400
#: Axes cut in one pass over the rows, and the bits they take in a node's number.
AXES = 3
#: Passes: 2^60 cells.
DEPTH = 20
ROOT = 1


@dataclass
class Tree:
    """Cells of the references: ``rows`` (with ``node``, the leaf), the cuts of every level, all boxes, and the number of levels."""

    rows: DataFrame
    cuts: list[DataFrame]
    boxes: DataFrame

    @property
    def depth(self) -> int:
        return len(self.cuts)


def _root(key: str) -> Column:
    """The root's number, computed from a column: joins on a constant would be planned as nested loops."""
    return F.lit(ROOT).cast("long") + F.pmod(F.xxhash64(key), F.lit(1))


def _moved(vector: str) -> Column:
    """The child of ``node`` that a vector falls in, by the node's cuts; the node itself when it has none."""
    bits = F.aggregate(
        F.transform("cuts", lambda c, i: F.when(F.get(F.col(vector), c["axis"]) >= c["at"], F.pow(F.lit(2), i).cast("long")).otherwise(0)),
        F.lit(0).cast("long"),
        lambda total, bit: total + bit,
    )
    return F.when(F.col("cuts").isNull(), F.col("node")).otherwise(F.col("node") * (1 << AXES) + bits)


def _descended(df: DataFrame, vector: str, cuts: DataFrame) -> DataFrame:
    names = df.columns
    return df.join(cuts, "node", "left").withColumn("node", _moved(vector)).select(*names)


def _cuts(placed: DataFrame, open_nodes: DataFrame, share: float, id_col: str) -> DataFrame:
    """Medians of the widest axes of every open node, as many as its size asks for, fitted on a share of the rows chosen by hash."""
    picked = placed.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) <= int(share * (1 << 30)))
    axes = picked.join(open_nodes, "node").select("node", "axes", F.posexplode("u").alias("axis", "x"))
    stats = axes.groupBy("node", "axes", "axis").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile_approx("x", 0.5, 200).alias("mid")
    )
    at = F.when(F.col("mid") > F.col("lo"), F.col("mid")).otherwise((F.col("lo") + F.col("hi")) / 2)
    wide = stats.where("lo < hi").groupBy("node", "axes").agg(
        F.sort_array(F.collect_list(F.struct((F.col("hi") - F.col("lo")).alias("width"), "axis", at.alias("at"))), False).alias("all")
    )
    return wide.select("node", F.slice("all", F.lit(1), F.col("axes")).alias("cuts"))


def tree(refs: DataFrame, cell_rows: int, id_col: str = "reference_sample_id") -> Tree:
    """Cuts ``refs`` (a written table with a vector ``u``) until cells hold at most ``cell_rows`` rows or rows of one place.

    A pass cuts up to three axes of every open node at once.  Medians come from a sample whose size follows the number of open nodes.
    """
    placed = refs.withColumn("node", _root(id_col)).withColumn("can_cut", F.lit(True))
    cuts = []
    for _ in range(DEPTH):
        sizes = placed.where("can_cut").groupBy("node").count().where(F.col("count") > cell_rows)
        axes = F.least(F.lit(AXES), F.ceil(F.log2(F.col("count") / cell_rows))).cast("int")
        nodes, rows = sizes.agg(F.count("*"), F.sum("count")).first()
        if not nodes:
            break
        found = stored(_cuts(placed, sizes.select("node", axes.alias("axes")), min(1.0, FITTED * nodes / rows), id_col), "cuts")
        moved = placed.drop("can_cut").join(found, "node", "left")
        placed = stored(
            moved.withColumn("can_cut", F.col("cuts").isNotNull()).withColumn("node", _moved("u")).drop("cuts"), "cells"
        )
        cuts.append(found)
    leaves = placed.select("node").distinct()
    # the box of a node holds those of all leaves under it
    corners = placed.select("node", F.posexplode("u").alias("axis", "x")).groupBy("node", "axis").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lifted = corners.withColumn("up", F.explode(F.sequence(F.lit(0), F.lit(len(cuts)))))
    lifted = lifted.withColumn("node", F.expr(f"shiftright(node, up * {AXES})")).where(F.col("node") >= ROOT)
    whole = lifted.groupBy("node", "axis").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    boxes = whole.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("axis", "lo", "hi"))).alias("sides"))
    boxes = boxes.join(leaves.withColumn("leaf", F.lit(True)), "node", "left").select(
        "node", F.shiftright("node", AXES).alias("parent"), F.coalesce("leaf", F.lit(False)).alias("leaf"), "sides"
    )
    return Tree(placed.drop("can_cut"), cuts, stored(boxes, "boxes"))


def own_cells(queries: DataFrame, cells: Tree) -> DataFrame:
    """``queries`` (with a vector ``z``) with ``node``: the leaf whose side of every cut they lie on."""
    found = queries.withColumn("node", _root("query_id"))
    for cuts in cells.cuts:
        found = _descended(found, "z", cuts)
    return found


def _gap(vector: Column, sides: Column) -> Column:
    """Distance from a point to a box."""
    off = F.zip_with(vector, sides, lambda x, s: F.greatest(F.lit(0.0), s["lo"] - x, x - s["hi"]))
    return F.sqrt(F.aggregate(off, F.lit(0.0), lambda total, g: total + g * g))


def visits(queries: DataFrame, cells: Tree) -> DataFrame:
    """(query_id, z, reach, node) of every leaf but the own one whose box is within ``reach``; ``queries``: query_id, z, own, reach.

    Descends level by level and keeps only nodes that are close enough, so its work follows the visits.
    """
    # a relative margin keeps cells that touch the bound up to rounding
    close = _gap(F.col("z"), F.col("sides")) <= F.col("reach") * (1 + 1e-9)
    children = cells.boxes.select(F.col("parent").alias("node"), F.col("node").alias("child"), "leaf", "sides")
    front = queries.withColumn("node", _root("query_id"))
    found = []
    for _ in range(cells.depth):
        met = front.join(children, "node").where(close).drop("sides", "node").withColumnRenamed("child", "node")
        met = stored(met, "front")
        found.append(met.where("leaf and node <> own").select("query_id", "z", "reach", "node"))
        front = met.where("not leaf").drop("leaf")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def sent(queries: DataFrame, cells: Tree, cell_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """What meets in the cells: queries (query_id, z, reach, node) and the rows of visited cells, copied once per ``QUERIES`` visits."""
    visited = cells.rows.join(queries.select("node").distinct(), "node", "left_semi")
    return balanced_sides(queries, visited, ["node"], QUERIES, cell_rows)


def _candidates(q: np.ndarray, u: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, reference) positions among which are the ``count`` nearest of every query, found by one matrix product.

    |q|^2 + |u|^2 - 2 qu is a squared distance up to rounding; whatever is not above the ``count``-th by more than the error
    of both is a candidate, so exact distances are needed for few pairs.  A product that is no number rules nothing out.
    """
    if len(u) <= count:
        return np.repeat(np.arange(len(q)), len(u)), np.tile(np.arange(len(u)), len(q))
    own, other = (q * q).sum(axis=1), (u * u).sum(axis=1)
    about = other[None, :] - 2 * (q @ u.T)
    error = 8 * (u.shape[1] + 4) * np.finfo(float).eps
    bound = np.partition(about + error * other, count - 1, axis=1)[:, count - 1] + error * own
    return np.nonzero(~(about - error * other > bound[:, None]))


def _distances(q: np.ndarray, u: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distance of each pair of positions; at most 2^20 numbers of a side are held at a time."""
    far = np.empty(len(row))
    step = max(1, (1 << 20) // max(1, u.shape[1]))
    for start in range(0, len(row), step):
        gap = q[row[start : start + step]] - u[at[start : start + step]]
        far[start : start + step] = np.sqrt((gap * gap).sum(axis=1))
    return far


def nearest(points: DataFrame, scores: DataFrame, count: int = vocab.NEIGHBOURS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The ``count`` nearest reference samples of each point, ties by group then sample.

    Each query first bounds its ``count``-th distance in its own cell, then visits only cells whose bounding box can be
    closer.  A cell of more than ``cell_rows`` rows is dealt to parts by hash, so no group depends on how the vectors cluster.
    Of identical reference vectors only the first ``count`` in tie order can be answers; further copies are dropped first.
    """
    refs = scaled(scores, "scores", scores, "u").select("reference_sample_id", "reference_group_id", "u")
    copies = Window.partitionBy("u").orderBy("reference_group_id", "reference_sample_id")
    refs = stored(refs.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= count).drop("copy"), "references")
    cells = tree(refs, cell_rows)
    kind = points.schema["query_id"].dataType.simpleString()
    found = f"query_id {kind}, reference_sample_id string, reference_group_id string, distance double"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            # ties are settled by the order of the rows
            right = right.sort_values(["reference_group_id", "reference_sample_id"], kind="stable")
            u = np.array(right["u"].tolist(), dtype=float)
            q, reach = np.array(left["z"].tolist(), dtype=float), left["reach"].to_numpy()
            step = max(1, 4_000_000 // len(u))
            for start in range(0, len(q), step):
                part = q[start : start + step]
                row, at = _candidates(part, u, count)
                far = _distances(part, u, row, at)
                # what lies beyond a query's reach is no answer; ties and what is no number stay
                close = ~(far > reach[start : start + step][row])
                row, at, far = row[close], at[close], far[close]
                # rows of one query together, nearest first, ties in the order of the references
                order = np.lexsort((at, far, row))
                row, at, far = row[order], at[order], far[order]
                first = np.arange(len(row)) - np.searchsorted(row, row) < count
                near = right.iloc[at[first]]
                out.append(
                    pd.DataFrame(
                        {
                            "query_id": left["query_id"].to_numpy()[start : start + step][row[first]],
                            "reference_sample_id": near["reference_sample_id"].to_numpy(),
                            "reference_group_id": near["reference_group_id"].to_numpy(),
                            "distance": far[first],
                        }
                    )
                )
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in found.split(", ")})

    def searched(queries: DataFrame) -> DataFrame:
        a, b, keys = sent(queries, cells, cell_rows)
        return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(search, found)

    order = Window.partitionBy("query_id").orderBy("distance", "reference_group_id", "reference_sample_id")

    def best(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)

    endless = F.lit(float("inf"))
    z = own_cells(scaled(points, "coordinates", scores, "z").select("query_id", "z", endless.alias("reach")), cells)
    if not cells.depth:
        return best(searched(z))
    z = stored(z, "queries")
    first = stored(best(searched(z)), "nearest")
    bound = first.where(F.col("rank") == count).select("query_id", F.col("distance").alias("bound"))
    known = z.withColumnRenamed("node", "own").join(bound, "query_id", "left")
    known = known.withColumn("reach", F.coalesce("bound", "reach")).drop("bound")
    return best(first.drop("rank").unionByName(searched(visits(known, cells))))
