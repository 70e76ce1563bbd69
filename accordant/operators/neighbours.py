"""Exact nearest neighbours over several columns, and the Local Outlier Factor built on them.

Distinct points are dealt to the cells of pivots. A point's distance to its k-th neighbour is bounded from its
distances to the pivots, then by its own block; another block is searched only if the triangle inequality
leaves room for a neighbour there. Cells are cut into blocks by the distance to their pivot, so no task
holds a whole cell, however many points it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordant.functions.ids import shuffle_hash
from accordant.operators.outliers import NEIGHBOURS, flag_top_share
from accordant.operators.ranking import ordered_rank
from accordant.session import MOST_PARTS, durable

#: Most pivots, and points of a block.
PIVOTS, BLOCK = 1_024, 2_000
#: Points that are looked up in one block by one task.
PROBES = 50_000
_SLACK = 1 + 1e-9  # bounds are widened by more than rounding can be


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = np.zeros((len(x), len(y)))
    for a, b in zip(x.T, y.T):  # column by column: nothing larger than the result is held
        squares += (a[:, None] - b[None, :]) ** 2
    return np.sqrt(squares)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def distinct_points(df: DataFrame, columns: list[str]) -> DataFrame:
    """(``point``, ``x``, ``copies``) of the distinct values of ``columns``; missing values count as 0."""
    x = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) + F.lit(0.0) for c in columns])
    counted = df.select(x.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    return durable(counted.withColumn("point", F.monotonically_increasing_id()))


def _celled(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Points with their nearest pivot (``cell``) and the distance ``r`` to it."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)  # at most PIVOTS rows

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            far = _distances(_matrix(b["x"]), shared.value)
            cell = far.argmin(1)
            yield b.assign(cell=cell.astype(np.int32), r=far[np.arange(len(b)), cell])

    return points.mapInPandas(assign, "x array<double>, copies long, point long, cell int, r double")


def _nearest(far: np.ndarray, order: np.ndarray, copies: np.ndarray, need: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of ``far`` that hold the ``need`` nearest copies of each row, by (distance, order).

    ``near`` marks the entries that are looked at; those of a row are next to each other in the result.
    """
    row, column = np.nonzero(near & (need > 0)[:, None])
    place = np.lexsort((order[column], far[row, column], row))
    row, column = row[place], column[place]
    upto = np.cumsum(copies[column])
    before = upto - copies[column]
    start = np.searchsorted(row, row)  # the first entry of the same row
    taken = before - before[start] < need[row] if len(row) else np.empty(0, bool)
    return row[taken], column[taken]


def _within(far: np.ndarray, n: int) -> np.ndarray:
    """The entries of each row that are not farther than its ``n``-th nearest."""
    if far.shape[1] <= n:
        return np.isfinite(far)
    return (far <= np.partition(far, n - 1, axis=1)[:, [n - 1]]) & np.isfinite(far)


_LINKS = "point long, other long, gap double, copies long"


def nearest_neighbours(points: DataFrame, k: int, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(``point``, ``other``, ``gap``, ``weight``): the ``k`` nearest rows of each distinct point, by distance.

    ``points`` as ``distinct_points`` gives them, with more than ``k`` copies in all. ``weight`` tells how many
    copies of ``other`` are meant; the other copies of a point itself come first, with gap 0. Of several points at
    the same distance, those with smaller coordinates (column by column) come first.
    """
    total = points.count()
    count = int(min(pivots, max(1, total // (4 * (k + 1)))))
    chosen = points.orderBy(shuffle_hash(F.col("x").cast("string"), 42), "point").limit(count).select("x").collect()  # at most PIVOTS
    pivot = np.array([r.x for r in chosen], dtype=float)
    celled = durable(_celled(points, pivot))

    ranked = ordered_rank(celled, ["cell"], ["r", "point"], name="n")
    members = durable(ranked.withColumn("block", F.floor((F.col("n") - 1) / block).cast("int")).drop("n"))
    rings = members.groupBy("cell", "block").agg(F.min("r").alias("low"), F.max("r").alias("high")).toPandas()  # one row for a block
    # the distance from a pivot within which more than k copies of its cell lie
    order = Window.partitionBy("cell").orderBy("r", "point").rowsBetween(Window.unboundedPreceding, 0)
    inner = members.where(F.col("block") <= (k + 1) // block).withColumn("upto", F.sum("copies").over(order))
    within = inner.where(F.col("upto") > k).groupBy("cell").agg(F.min("r").alias("r")).toPandas()  # one row for a pivot
    reach = np.full(len(pivot), np.inf)  # none is known if there are few points: then every block is searched
    reach[within["cell"]] = within["r"]
    rings = rings.sort_values(["cell", "block"], ignore_index=True)
    shared = points.sparkSession.sparkContext.broadcast((pivot, reach, rings))

    def own_block(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """Neighbours in the block itself, and the searches that are left for each point."""
        pivot, reach, rings = shared.value
        x, copies, ids = _matrix(part["x"]), part["copies"].to_numpy(), part["point"].to_numpy()
        place = np.lexsort(x.T[::-1])
        rank = np.empty(len(x), np.int64)
        rank[place] = np.arange(len(x))
        links, asked = [], []
        for at in range(0, len(x), 256):
            some = slice(at, at + 256)
            far = _distances(x[some], x)
            here = np.arange(len(x))[some]
            far[np.arange(len(here)), here] = np.inf
            need = k - (copies[some] - 1)
            row, own = _nearest(far, rank, copies, need, _within(far, k))
            held = np.bincount(row, copies[own], len(here))
            farthest = np.zeros(len(here))
            np.maximum.at(farthest, row, far[row, own])
            to_pivot = _distances(x[some], pivot)
            bound = (to_pivot + reach[None, :]).min(1)
            bound = np.where(held >= need, np.minimum(bound, farthest), bound)
            gap = to_pivot[:, rings["cell"]]
            limit = bound[:, None] * _SLACK
            open_ = (gap - rings["high"].to_numpy()[None, :] <= limit) & (rings["low"].to_numpy()[None, :] - gap <= limit)
            open_ &= ~((rings["cell"].to_numpy() == key[0]) & (rings["block"].to_numpy() == key[1]))[None, :]
            # points of another cell are not nearer to this cell's pivot than to their own
            between = np.sqrt(((pivot[key[0]] - pivot) ** 2).sum(1))[rings["cell"]]
            with np.errstate(divide="ignore", invalid="ignore"):
                halfway = (gap**2 - (to_pivot[:, [key[0]]]) ** 2) / (2 * between[None, :])
            open_ &= ~(halfway > limit + 1e-12 * (gap + 1))
            open_ &= (need > 0)[:, None]
            links.append(pd.DataFrame({"point": ids[here[row]], "other": ids[own], "gap": far[row, own], "copies": copies[own], "x": None}))
            point, ring = np.nonzero(open_)
            asked.append(pd.DataFrame({"point": ids[here[point]], "cell": rings["cell"].to_numpy()[ring], "block": rings["block"].to_numpy()[ring],
                                       "x": list(x[here[point]]), "bound": bound[point]}))
        return pd.concat([*links, *asked], ignore_index=True).reindex(columns=["point", "other", "gap", "copies", "cell", "block", "x", "bound"]).astype(
            {"other": "Int64", "copies": "Int64", "cell": "Int32", "block": "Int32"})

    schema = "point long, other long, gap double, copies long, cell int, block int, x array<double>, bound double"
    # a task for about ``block`` points: adaptive execution would join them by their few bytes
    tasks = max(1, min(-(-total // block), MOST_PARTS))
    local = durable(members.repartition(tasks, "cell", "block").groupBy("cell", "block").applyInPandas(own_block, schema))
    probes = local.where(F.col("cell").isNotNull()).select("cell", "block", "point", "x", "bound")
    # a block that is looked up often is handed to several tasks
    sizes = probes.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / PROBES).alias("parts"))
    dealt = probes.join(sizes, ["cell", "block"]).select("cell", "block", "point", "x", "bound", F.pmod(F.xxhash64("point"), F.col("parts")).alias("part"))
    copies_of = sizes.select(F.col("cell").alias("_cell"), F.col("block").alias("_block"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1).alias("_parts"))
    held = members.join(copies_of, (F.col("cell") == F.col("_cell")) & (F.col("block") == F.col("_block"))).select(
        "cell", "block", "point", "x", "copies", F.explode("_parts").alias("part"))

    def search(key: tuple, mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        x, copies, ids = _matrix(mine["x"]), mine["copies"].to_numpy(), mine["point"].to_numpy()
        place = np.lexsort(x.T[::-1])
        rank = np.empty(len(x), np.int64)
        rank[place] = np.arange(len(x))
        found = []
        for at in range(0, len(asked), 256):
            part = asked.iloc[at : at + 256]
            far = _distances(_matrix(part["x"]), x)
            far[far > part["bound"].to_numpy()[:, None] * _SLACK] = np.inf
            row, own = _nearest(far, rank, copies, np.full(len(part), k), np.isfinite(far))
            found.append(pd.DataFrame({"point": part["point"].to_numpy()[row], "other": ids[own], "gap": far[row, own], "copies": copies[own]}))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=["point", "other", "gap", "copies"])

    keys = ["cell", "block", "part"]
    elsewhere = held.repartition(tasks, *keys).groupBy(*keys).cogroup(dealt.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(search, _LINKS)
    links = local.where(F.col("other").isNotNull()).select("point", "other", "gap", "copies").unionByName(elsewhere)
    itself = points.where("copies > 1").select("point", F.col("point").alias("other"), F.lit(-1.0).alias("gap"), (F.col("copies") - 1).alias("copies"))
    links = links.unionByName(itself).join(points.select(F.col("point").alias("other"), "x"), "other")
    before = Window.partitionBy("point").orderBy("gap", "x").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("copies").over(before), F.lit(0))
    weight = F.least("copies", F.lit(k) - taken)
    return links.withColumn("weight", weight).where("weight > 0").select("point", "other", F.greatest("gap", F.lit(0.0)).alias("gap"), "weight")


def local_outlier_factors(df: DataFrame, columns: list[str], neighbours: int = NEIGHBOURS, contamination: float = 0.05,
                          pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Rows with ``lof`` (to six decimals) and the flag ``local_outlier_factor`` over several columns together.

    Euclidean distances, missing values count as 0. Equal rows have equal factors; with two rows or fewer every
    factor is 1. Neighbours are exact.
    """
    x = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) + F.lit(0.0) for c in columns])
    rows = df.count()
    if rows < 3:
        return df.withColumns({"lof": F.lit(1.0), "local_outlier_factor": F.lit(False)})
    k = max(1, min(neighbours, rows - 1))
    points = distinct_points(df, columns)
    links = durable(nearest_neighbours(points, k, pivots, block))
    radius = links.groupBy(F.col("point").alias("other")).agg(F.max("gap").alias("radius"))
    reach = F.sum(F.greatest("gap", "radius") * F.col("weight")) / k
    density = links.join(radius, "other").groupBy("point").agg((1 / (reach + 1e-10)).alias("density"))
    around = links.join(density.select(F.col("point").alias("other"), F.col("density").alias("near")), "other")
    factor = (around.groupBy("point").agg((F.sum(F.col("near") * F.col("weight")) / k).alias("near")).join(density, "point")
              .select("point", F.round(F.col("near") / F.col("density"), 6).alias("lof")).join(points.select("point", F.col("x").alias("_x")), "point").drop("point"))
    scored = durable(df.withColumn("_x", x).join(factor, "_x").drop("_x"))
    return flag_top_share(scored, [], "lof", contamination, "local_outlier_factor")
