"""Isolation forest (Liu, Ting and Zhou 2008) on Spark, with labels and summaries.

Every tree needs 256 rows, so training reads the features once to draw all samples by
hash, and grows one tree per group. The forest is a table of at most 511 nodes per
tree; that bound is what allows it to be handed to every scoring task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import anomaly_severity, finite, percent
from loglake.operators.features import align_features
from loglake.operators.percentiles import exact_percentiles, linear_bucket
from loglake.session import written

SAMPLE_SIZE = 256
#: Rows that walk down the trees together.
WALKED = 4096
HASH_RANGE = 10**15
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"
)


def sanitize(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Infinite, NaN and null feature values become 0; other columns pass through."""
    return features.withColumns({n: finite(F.col(n)) for n in names})


def scaling(features: DataFrame, names: Sequence[str]) -> tuple[int, list[tuple[float, float]]]:
    """Rows, and mean and population deviation per feature (1 where there is no variation)."""
    stats = features.agg(
        F.count("*").alias("n"),
        *(F.avg(n).alias(f"m{i}") for i, n in enumerate(names)),
        *(F.stddev_pop(n).alias(f"s{i}") for i, n in enumerate(names)),
    ).first()
    return stats.n, [(stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 1.0) for i in range(len(names))]


def standardize(features: DataFrame, names: Sequence[str], scales: list[tuple[float, float]]) -> DataFrame:
    """Each feature centred and divided by its deviation; one projection."""
    return features.withColumns(
        {n: (F.col(n) - F.lit(mean)) / F.lit(dev) for n, (mean, dev) in zip(names, scales)}
    )


def tree_samples(
    rows: DataFrame, names: Sequence[str], key: str, n: int, trees: int, seed: int
) -> DataFrame:
    """(tree, values): exactly min(256, n) rows per tree, chosen by hash.

    A row enters a tree's draw when its hash falls below 1.5 times the wanted share, and
    the lowest hashes win. Only the drawn rows leave the scan, about 384 per tree.
    """
    size = min(SAMPLE_SIZE, n)
    limit = HASH_RANGE if n <= 1.5 * size else math.ceil(HASH_RANGE * 1.5 * size / n)

    def ticket(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(key), tree, F.lit(seed)), F.lit(HASH_RANGE))

    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: ticket(t) < limit)
    values = F.array(*(F.col(c).cast("double") for c in names)).alias("values")
    rows = rows.select(key, values, F.explode(drawn).alias("tree")).withColumn("ticket", ticket(F.col("tree")))
    # a fixed number of partitions: the samples are small in bytes but costly to grow
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.repartition(min(trees, 2 * cores), "tree")
    order = Window.partitionBy("tree").orderBy("ticket", key)
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)


def _grow(seed: int):
    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        """One isolation tree: random feature, random split, until rows are isolated."""
        tree = int(sample["tree"].iloc[0])
        x = np.stack(sample.sort_values("place")["values"].to_numpy())
        height = math.ceil(math.log2(max(len(x), 2)))
        random = np.random.default_rng([seed, tree])
        nodes: list[list] = []
        waiting = [(np.arange(len(x)), 0, None)]
        while waiting:
            rows, depth, parent = waiting.pop()
            here = len(nodes)
            if parent is not None:
                nodes[parent[0]][parent[1]] = here
            nodes.append([tree, here, -1, 0.0, -1, -1, len(rows), depth])
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth < height and len(varied):
                feature = int(random.choice(varied))
                threshold = float(random.uniform(low[feature], high[feature]))
                if threshold >= high[feature]:  # rounding: both sides must keep a row
                    threshold = float(low[feature])
                below = x[rows, feature] <= threshold
                nodes[here][2:4] = feature, threshold
                waiting.append((rows[~below], depth + 1, (here, 5)))
                waiting.append((rows[below], depth + 1, (here, 4)))
        columns = ["tree", "node", "feature", "threshold", "left", "right", "size", "depth"]
        return pd.DataFrame(nodes, columns=columns)

    return grow


def grow_trees(samples: DataFrame, seed: int) -> DataFrame:
    return samples.groupBy("tree").applyInPandas(_grow(seed), NODE_SCHEMA)


def average_path(size: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of ``size`` rows."""
    size = np.asarray(size, dtype=float)
    big = np.maximum(size, 3.0)
    path = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(size > 2, path, np.where(size == 2, 1.0, 0.0))


def forest_arrays(nodes: pd.DataFrame) -> dict:
    """The node table as arrays with one row per tree, ready to walk whole batches."""
    shape = (nodes["tree"].max() + 1, nodes["node"].max() + 1)
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())

    def grid(values, fill, dtype):
        out = np.full(shape, fill, dtype=dtype)
        out[at] = values
        return out

    leaf, own = nodes["feature"].to_numpy() < 0, nodes["node"].to_numpy()
    feature = grid(np.where(leaf, 0, nodes["feature"]), 0, np.intp)
    threshold = grid(np.where(leaf, np.inf, nodes["threshold"]), np.inf, float)
    # a leaf points at itself, so walking on from it changes nothing
    left = grid(np.where(leaf, own, nodes["left"]), 0, np.intp)
    right = grid(np.where(leaf, own, nodes["right"]), 0, np.intp)
    path = grid(nodes["depth"] + average_path(nodes["size"].to_numpy()), 0.0, float)
    # level by level, every node with both children: a row's place on a level is its place above, doubled, plus 1 on the right
    tree, place = np.arange(shape[0])[:, None], np.zeros((shape[0], 1), np.intp)
    levels = []
    for _ in range(int(nodes["depth"].max())):
        levels.append((feature[tree, place], threshold[tree, place]))
        place = np.stack((left[tree, place], right[tree, place]), axis=2).reshape(shape[0], -1)
    return {
        "levels": levels,
        "path": path[tree, place],
        "normal": float(average_path(np.array([nodes.loc[nodes["node"] == 0, "size"].max()]))[0]),
    }


def walk_trees(forest: dict, x: np.ndarray) -> np.ndarray:
    """Raw scores of a batch of rows, in slices that stay in a core's cache."""
    if forest["normal"] <= 0:
        return np.full(len(x), -0.5)
    total = np.zeros(len(x))
    for low in range(0, len(x), WALKED):
        part = np.ascontiguousarray(x[low : low + WALKED].T)
        count = part.shape[1]
        flat, base, sums = part.ravel(), np.arange(count), total[low : low + count]
        for tree, path in enumerate(forest["path"]):
            place = np.zeros(count, np.intp)
            for level, (feature, threshold) in enumerate(forest["levels"]):
                if level:
                    at = (feature[tree] * count).take(place)
                    at += base
                    below = flat.take(at) <= threshold[tree].take(place)
                    place += place
                else:  # all rows stand at the root
                    below = part[feature[tree, 0]] <= threshold[tree, 0]
                place += ~below
            sums += path.take(place)
    return -np.power(2.0, -total / len(forest["path"]) / forest["normal"])


def score(rows: DataFrame, names: Sequence[str], nodes: pd.DataFrame) -> DataFrame:
    """Adds ``raw_score``: towards -1 for outliers, about -0.5 for ordinary rows."""
    forest = rows.sparkSession.sparkContext.broadcast(forest_arrays(nodes))

    @F.pandas_udf("double")
    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(walk_trees(forest.value, np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    return rows.withColumn("raw_score", walk(*(F.col(n).cast("double") for n in names)))


@dataclass
class AnomalyDetector:
    """Isolation forest with a threshold that marks ``contamination`` of the training rows."""

    trees: int = 200
    contamination: float = 0.05
    seed: int = 42
    names: list[str] = field(default_factory=list)
    scales: list[tuple[float, float]] = field(default_factory=list)
    nodes: pd.DataFrame | None = None
    offset: float = 0.0
    stats: dict = field(default_factory=dict)

    def fit(self, features: DataFrame, names: Sequence[str], key: str = "row_id") -> "AnomalyDetector":
        """Train on the columns ``names`` of ``features``; ``key`` identifies a row."""
        self.names = list(names)
        rows = written(align_features(features, self.names, [key]), "features")
        n, self.scales = scaling(rows, self.names)
        if n == 0:
            raise ValueError("no rows to train on")
        scaled = standardize(rows, self.names, self.scales)
        samples = tree_samples(scaled, self.names, key, n, self.trees, self.seed)
        nodes = grow_trees(samples, self.seed).toPandas()
        self.nodes = nodes.sort_values(["tree", "node"], ignore_index=True)

        scored = written(score(scaled, self.names, self.nodes).select(key, "raw_score"), "scores")
        threshold = exact_percentiles(
            scored, [], "raw_score", {"offset": self.contamination}, linear_bucket(1e-6)
        )
        self.offset = threshold.first().offset
        self.stats = training_stats(self._label(scored), len(self.names)).first().asDict()
        return self

    def _label(self, scored: DataFrame) -> DataFrame:
        value = F.col("raw_score") - F.lit(self.offset)
        labelled = scored.withColumn("anomaly_score", value).drop("raw_score")
        outlier = F.col("anomaly_score") < 0
        return labelled.withColumns(
            {
                "anomaly_label": F.when(outlier, -1).otherwise(1),
                "is_anomaly": outlier.cast("int"),
                "anomaly_severity": anomaly_severity(F.col("anomaly_score")),
            }
        )

    def _require_fit(self) -> None:
        if self.nodes is None:
            raise RuntimeError("the model is not trained: call fit() or load() first")

    def predict(self, features: DataFrame) -> DataFrame:
        """Features with score, label and severity. Columns unknown to the model pass
        through, columns the model misses count as 0. No shuffle."""
        self._require_fit()
        inputs = {
            f"_f{i}": (finite(F.col(n) if n in features.columns else F.lit(0)) - F.lit(mean)) / F.lit(dev)
            for i, (n, (mean, dev)) in enumerate(zip(self.names, self.scales))
        }
        scored = score(features.withColumns(inputs), list(inputs), self.nodes)
        return self._label(scored.drop(*inputs))

    def save(self, spark: SparkSession, folder: str) -> None:
        self._require_fit()
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{folder}/nodes")
        scales = [(i, n, *s) for i, (n, s) in enumerate(zip(self.names, self.scales))]
        spark.createDataFrame(scales, "place int, name string, mean double, deviation double").write.mode(
            "overwrite"
        ).parquet(f"{folder}/scaling")
        metadata = {
            **self.stats,
            "feature_names": self.names,
            "n_estimators": self.trees,
            "contamination": self.contamination,
            "seed": self.seed,
            "score_offset": self.offset,
        }
        spark.createDataFrame([metadata], METADATA_SCHEMA).write.mode("overwrite").json(f"{folder}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "AnomalyDetector":
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{folder}/nodes").orderBy("tree", "node").toPandas()
        scales = spark.read.parquet(f"{folder}/scaling").orderBy("place").collect()
        meta = spark.read.schema(METADATA_SCHEMA).json(f"{folder}/metadata").first().asDict()
        return cls(
            trees=meta["n_estimators"],
            contamination=meta["contamination"],
            seed=meta["seed"],
            names=[r.name for r in scales],
            scales=[(r.mean, r.deviation) for r in scales],
            nodes=nodes,
            offset=meta["score_offset"],
            stats={k: meta[k] for k in STAT_NAMES},
        )


STAT_NAMES = (
    "n_samples", "n_features", "n_anomalies", "anomaly_rate", "score_mean", "score_std", "score_min",
    "score_max",
)
METADATA_SCHEMA = (
    "n_samples bigint, n_features int, n_anomalies bigint, anomaly_rate double, score_mean double, "
    "score_std double, score_min double, score_max double, feature_names array<string>, "
    "n_estimators int, contamination double, seed int, score_offset double"
)


def training_stats(labelled: DataFrame, n_features: int) -> DataFrame:
    """Rows, anomalies, rate and the spread of the scores (population deviation)."""
    s, n = F.col("anomaly_score"), F.count("*")
    anomalies = F.count_if(F.col("is_anomaly") == 1)
    return labelled.agg(
        n.alias("n_samples"),
        F.lit(n_features).alias("n_features"),
        anomalies.alias("n_anomalies"),
        percent(anomalies, n).alias("anomaly_rate"),
        F.round(F.avg(s), 4).alias("score_mean"),
        F.round(F.stddev_pop(s), 4).alias("score_std"),
        F.round(F.min(s), 4).alias("score_min"),
        F.round(F.max(s), 4).alias("score_max"),
    )


def anomaly_totals(labelled: DataFrame) -> DataFrame:
    """Records, anomalies, rate, score statistics and the highest anomalous score."""
    n, odd = F.count("*"), F.col("is_anomaly") == 1
    s = F.col("anomaly_score")
    return labelled.agg(
        n.alias("total_records"),
        F.count_if(odd).alias("total_anomalies"),
        percent(F.count_if(odd), n).alias("anomaly_rate"),
        F.round(F.avg(s), 4).alias("score_mean"),
        F.round(F.stddev_samp(s), 4).alias("score_std"),
        F.coalesce(F.round(F.max(F.when(odd, s)), 4), F.lit(0.0)).alias("anomaly_threshold"),
    )


def severity_distribution(labelled: DataFrame) -> DataFrame:
    """Anomalies per severity, zeros included."""
    odd = F.col("is_anomaly") == 1
    counts = labelled.agg(
        *(F.count_if(odd & (F.col("anomaly_severity") == s)).alias(s) for s in fv.ANOMALY_SEVERITIES)
    )
    rows = (F.struct(F.lit(s).alias("severity"), F.col(s).alias("records")) for s in fv.ANOMALY_SEVERITIES)
    return counts.select(F.inline(F.array(*rows)))


def top_anomalous_features(
    labelled: DataFrame, names: Sequence[str] = fv.NUMERIC_FEATURES, k: int = 10
) -> DataFrame:
    """Features whose mean differs most between anomalous and normal rows.

    Both means of every feature come from one pass; only one row is left to rank.
    """
    odd = F.col("is_anomaly") == 1
    stats = []
    for name in names:
        anomalous, normal = F.avg(F.when(odd, F.col(name))), F.avg(F.when(~odd, F.col(name)))
        shift = F.when(normal != 0, F.round(F.abs(anomalous - normal) / F.abs(normal), 4))
        stats.append(F.struct(F.lit(name).alias("feature"), shift.alias("shift")).alias(name))
    rows = labelled.agg(*stats).select(F.inline(F.array(*names)))
    return rows.where(F.col("shift").isNotNull()).orderBy(F.desc("shift"), "feature").limit(k)


def anomaly_listing(labelled: DataFrame, limit: int = 200, order: Sequence[str] = ("row_id",)) -> DataFrame:
    return labelled.where(F.col("is_anomaly") == 1).orderBy(*order).limit(limit)


def anomaly_rates(labelled: DataFrame) -> DataFrame:
    odd = F.col("is_anomaly") == 1
    return labelled.agg(
        F.count_if(odd).alias("total"),
        percent(F.count_if(odd), F.count("*"), 1).alias("rate"),
        F.count_if(odd & (F.col("anomaly_severity") == "critical")).alias("critical"),
    )
