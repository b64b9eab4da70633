"""DBSCAN over weighted points, exact, in cells of bounded size.

Space is halved again and again until every cell holds few enough points. Points within
eps of a cut go to both sides, so each point has all its neighbours in its home cell.
Cells are clustered independently; clusters of different cells that share a core point
are the same cluster, which a few rounds of joins on labels find out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.session import written

NOISE = -1
CELL_POINTS = 4096
#: Points compared at once with as many others, and pairs near the limit decided at once.
BLOCK, EXACT = 512, 1 << 14


def standard_points(reduced: DataFrame) -> DataFrame:
    """Distinct vectors (point, n, x), every dimension with mean 0 and deviation 1 over
    all messages. ``point`` is the first row that has the vector."""
    size = reduced.select(F.size("reduced").alias("k")).first().k
    n = F.col("n")
    sums = [F.sum(n * F.get("reduced", F.lit(i))).alias(f"s{i}") for i in range(size)]
    squares = [F.sum(n * F.pow(F.get("reduced", F.lit(i)), F.lit(2))).alias(f"q{i}") for i in range(size)]
    total = reduced.agg(F.sum(n).alias("n"), *sums, *squares).first()
    means = [total[f"s{i}"] / total.n for i in range(size)]
    spreads = [max(total[f"q{i}"] / total.n - m * m, 0.0) ** 0.5 or 1.0 for i, m in enumerate(means)]
    scaled = F.zip_with(
        F.zip_with("reduced", F.array(*map(F.lit, means)), lambda v, m: v - m),
        F.array(*map(F.lit, spreads)),
        lambda v, s: v / s,
    )
    distinct = reduced.groupBy("reduced").agg(F.sum("n").alias("n"), F.min("first_row").alias("point"))
    return distinct.select("point", "n", "reduced", scaled.alias("x"))


def _sides(eps: float) -> Column:
    """The one or two sides of its cell's cut a point belongs to; one of them is its own."""
    offset = F.get("x", F.col("axis")) - F.col("at")
    low = F.when(offset <= eps, F.struct(F.lit("0").alias("side"), (offset < 0).alias("own")))
    high = F.when(offset >= -eps, F.struct(F.lit("1").alias("side"), (offset >= 0).alias("own")))
    return F.filter(F.array(low, high), lambda s: s.isNotNull())


def _cuts(cells: DataFrame, dimensions: int, eps: float, cell_points: int) -> DataFrame:
    """(cell, axis, at): a cut at the mean of the most varied dimension for every cell
    that is too large and that the cut really divides.

    Both sides must lose a fifth of the points. Where points crowd within eps of the cut
    that is not so, and cutting on would only copy them: such a cell stays whole.
    """
    value = [F.get("x", F.lit(i)) for i in range(dimensions)]
    stats = cells.groupBy("cell").agg(
        F.count("*").alias("points"),
        F.array(*(F.var_pop(v) for v in value)).alias("spreads"),
        F.array(*(F.avg(v) for v in value)).alias("means"),
    )
    axis = F.array_position("spreads", F.array_max("spreads")).cast("int") - 1
    large = stats.where(F.col("points") > cell_points).select(
        "cell", "points", axis.alias("axis"), F.get("means", axis).alias("at")
    )
    sides = cells.join(large, "cell").select("cell", "points", "axis", "at", F.inline(_sides(eps)))
    halves = sides.groupBy("cell", "points", "axis", "at").agg(
        F.count_if(F.col("side") == "0").alias("low"), F.count_if(F.col("side") == "1").alias("high")
    )
    return halves.where(F.greatest("low", "high") <= F.col("points") * 0.8).select("cell", "axis", "at")


def divide(points: DataFrame, dimensions: int, eps: float, cell_points: int = CELL_POINTS) -> DataFrame:
    """(cell, home, point, n, x): points in cells, with copies (home = false) near cuts."""
    cells = written(
        points.select(F.lit("").alias("cell"), F.lit(True).alias("home"), "point", "n", "x"), "cells"
    )
    while True:
        cuts = written(_cuts(cells, dimensions, eps, cell_points), "cuts")
        if cuts.isEmpty():
            return cells
        stay = F.array(F.struct(F.lit("").alias("side"), F.lit(True).alias("own")))
        moved = cells.join(cuts, "cell", "left").withColumn(
            "go", F.explode(F.when(F.col("at").isNull(), stay).otherwise(_sides(eps)))
        )
        cells = written(
            moved.select(
                F.concat("cell", "go.side").alias("cell"), (F.col("home") & F.col("go.own")).alias("home"),
                "point", "n", "x",
            ),
            "cells",
        )


def _near(x: np.ndarray, eps: float):
    """(rows, columns) of all pairs within eps, ``BLOCK`` points against ``BLOCK`` points at a time."""
    squared = (x * x).sum(axis=1)
    # the expanded form loses digits: pairs this near the limit are decided exactly
    unsure = 1e-6 + 1e-13 * squared.max(initial=0)
    for start in range(0, len(x), BLOCK):
        block = x[start : start + BLOCK]
        for other in range(0, len(x), BLOCK):
            close = squared[start : start + BLOCK, None] + squared[None, other : other + BLOCK]
            close -= 2 * block @ x[other : other + BLOCK].T
            close -= eps * eps
            within = close < -unsure
            rows, columns = np.nonzero(np.abs(close) <= unsure)
            for low in range(0, len(rows), EXACT):
                r, c = rows[low : low + EXACT], columns[low : low + EXACT]
                within[r, c] = ((block[r] - x[other + c]) ** 2).sum(axis=1) <= eps * eps
            rows, columns = np.nonzero(within)
            yield rows + start, columns + other


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the least point of its group) after the links between points a and b."""
    u, v = label[a], label[b]
    apart = u != v
    u, v = np.divmod(np.unique(u[apart] * len(label) + v[apart]), len(label))
    while len(u):
        lower = label.copy()
        np.minimum.at(lower, u, label[v])
        np.minimum.at(lower, v, label[u])
        while (lower[lower] != lower).any():
            lower = lower[lower]
        label = lower
        u, v = label[u], label[v]
        u, v = u[u != v], v[u != v]
    return label


def _core_points(eps: float, min_points: int):
    def find(cell: pd.DataFrame) -> pd.DataFrame:
        x, n = np.stack(cell["x"].to_numpy()), cell["n"].to_numpy()
        weight = np.zeros(len(x))
        for rows, columns in _near(x, eps):
            np.add.at(weight, rows, n[columns])
        found = cell["home"].to_numpy() & (weight >= min_points)
        return pd.DataFrame({"point": cell["point"].to_numpy()[found]})

    return find


def _local_clusters(eps: float):
    def find(cell: pd.DataFrame) -> pd.DataFrame:
        """Core points joined within the cell; border points listed with their clusters."""
        x, point = np.stack(cell["x"].to_numpy()), cell["point"].to_numpy()
        core, home = cell["core"].to_numpy(dtype=bool), cell["home"].to_numpy(dtype=bool)
        label, borders = np.arange(len(x)), []
        for rows, columns in _near(x, eps):
            linked = core[rows] & core[columns] & (rows < columns)
            label = _joined(label, rows[linked], columns[linked])
            # a home point that is no core point has few neighbours
            border = ~core[rows] & core[columns] & home[rows]
            borders.append((rows[border], columns[border]))
        members = np.concatenate([np.flatnonzero(core), *(b[0] for b in borders)])
        groups = np.concatenate([label[core], *(label[b[1]] for b in borders)])
        name = cell["cell"].iloc[0]
        out = pd.DataFrame({"point": point[members], "core": core[members], "group": groups}).drop_duplicates()
        out["part"] = name + "/" + out.pop("group").astype(str)
        return out

    return find


def merge_parts(members: DataFrame) -> DataFrame:
    """(part, label): parts that share a core point get the same label, the smallest
    core point among them."""
    core = written(members.where("core").select("point", "part"), "links")
    labels = written(core.groupBy("part").agg(F.min("point").alias("label")), "labels")
    # only points in several parts connect anything
    shared = core.groupBy("point").agg(F.count("*").alias("parts")).where("parts > 1").select("point")
    links = written(core.join(shared, "point"), "links")
    while True:
        by_point = links.join(labels, "part").groupBy("point").agg(F.min("label").alias("low"))
        by_part = links.join(by_point, "point").groupBy("part").agg(F.min("low").alias("low"))
        lowered = labels.join(by_part, "part", "left").select(
            "part", F.least("label", F.coalesce("low", "label")).alias("label"), F.col("label").alias("was")
        )
        lowered = written(lowered, "labels")
        labels = lowered.select("part", "label")
        if lowered.where("label < was").isEmpty():
            return labels


def dbscan(
    reduced: DataFrame, eps: float = 0.5, min_points: int = 5, cell_points: int = CELL_POINTS
) -> DataFrame:
    """Adds ``raw_cluster``: the first core row of the cluster, null for noise.

    ``reduced(n, first_row, reduced)`` holds distinct messages with their count. A border
    point belongs to the earliest of the clusters it touches.
    """
    points = written(standard_points(reduced), "points")
    dimensions = points.select(F.size("x").alias("k")).first().k
    cells = divide(points, dimensions, eps, cell_points)
    core = cells.groupBy("cell").applyInPandas(_core_points(eps, min_points), "point bigint")
    marked = cells.join(core.withColumn("core", F.lit(True)), "point", "left").withColumn(
        "core", F.coalesce("core", F.lit(False))
    )
    members = written(
        marked.groupBy("cell").applyInPandas(_local_clusters(eps), "point bigint, core boolean, part string"),
        "members",
    )
    labels = merge_parts(members)
    clusters = members.join(labels, "part").groupBy("point").agg(F.min("label").alias("raw_cluster"))
    found = points.join(clusters, "point", "left").select("reduced", "raw_cluster")
    return reduced.join(found, "reduced", "left")
