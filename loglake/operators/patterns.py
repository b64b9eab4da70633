"""Message patterns: terms, TF-IDF, dimension reduction, clusters and their description.

All of it works on distinct messages that carry their number of occurrences. Log
messages repeat heavily, and the copies are folded by a partial aggregate before any
shuffle, so a message that makes up a third of the log is one weighted row here.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import percent
from loglake.functions.text_columns import identifiers, ngrams, once
from loglake.operators.density import NOISE, dbscan
from loglake.session import written

MAX_TERMS = 5000
COMPONENTS = 50
SEED = 42
#: Rounds in which K-Means draws starting points over all messages, points per round and cluster, and the step below which a run has settled.
START_ROUNDS = 5
START_POINTS = 2
SETTLED = 1e-4
#: Messages whose terms a Python task multiplies at once, each term with a row of the basis.
AT_ONCE = 500


def weighted_messages(df: DataFrame) -> DataFrame:
    """Distinct non-empty messages with their count ``n`` and first ``row_id``."""
    return (
        df.where(F.length("message") > 0)
        .groupBy("message")
        .agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))
    )


def message_terms(docs: DataFrame, stop_words: Sequence[str] = fv.TERM_STOP_WORDS) -> DataFrame:
    """(message, n, first_row, term, tf) for words and word pairs, stop words removed first.

    A message without terms keeps one row with a null term.
    The rows of one message stay where the message is, so counting its terms and
    gathering its vector need no further shuffle.
    """
    words = once(identifiers(F.col("message"), stop_words)).alias("words")
    terms = F.concat("words", ngrams(F.col("words"), 2))
    kept = ("message", "n", "first_row")
    rows = docs.select(*kept, words).select(*kept, F.explode_outer(terms).alias("term"))
    return rows.groupBy("message", "n", "first_row", "term").agg(F.count("term").alias("tf"))


def vocabulary(
    docs: DataFrame,
    max_terms: int = MAX_TERMS,
    min_df: int = 2,
    max_df: float = 0.95,
    stop_words: Sequence[str] = fv.TERM_STOP_WORDS,
) -> DataFrame:
    """At most ``max_terms`` terms by corpus count, with document counts and smoothed idf."""
    total = F.coalesce(docs.agg(F.sum("n")).scalar(), F.lit(0))
    counted = (
        message_terms(docs, stop_words)
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.sum("n").alias("df"), F.sum(F.col("n") * F.col("tf")).alias("corpus_count"))
        .where((F.col("df") >= min_df) & (F.col("df") <= total * max_df))
        .orderBy(F.desc("corpus_count"), "term")
        .limit(max_terms)
    )
    return counted.withColumn("idf", F.log((total + 1) / (F.col("df") + 1)) + 1)


def placed(vocab: DataFrame) -> DataFrame:
    """Numbers the terms alphabetically; a vocabulary is small by construction."""
    return vocab.withColumn("place", F.row_number().over(Window.orderBy("term")) - 1)


def message_vectors(
    docs: DataFrame, vocab: DataFrame, stop_words: Sequence[str] = fv.TERM_STOP_WORDS
) -> DataFrame:
    """(message, n, first_row, terms): TF-IDF of unit length, sparse, empty if no known term.

    ``vocab(term, place, idf)`` has at most ``max_terms`` rows, so it may be broadcast.
    """
    known = message_terms(docs, stop_words).join(
        F.broadcast(vocab.select("term", "place", "idf")), "term", "left"
    )
    entry = F.struct("place", "term", (F.col("tf") * F.col("idf")).alias("weight"))
    gathered = known.groupBy("message", "n", "first_row").agg(
        F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), entry))).alias("_raw")
    )
    length = F.sqrt(
        F.aggregate("_raw", F.lit(0.0), lambda acc, t: acc + t["weight"] * t["weight"])
    )
    unit = F.transform(
        "_raw",
        lambda t: F.struct(t["place"].alias("place"), t["term"].alias("term"), (t["weight"] / length).alias("weight")),
    )
    return gathered.select("message", "n", "first_row", unit.alias("terms"))


def tfidf(vectors: DataFrame) -> DataFrame:
    """Vectors in long form: (message, n, term, weight)."""
    return vectors.select("message", "n", F.inline("terms")).drop("place")


def _places(vectors: DataFrame) -> list[Column]:
    return [F.col("terms.place").alias("place"), F.col("terms.weight").alias("weight")]


def _project(batch: pd.DataFrame, components: np.ndarray) -> np.ndarray:
    """Sparse rows times ``components``; a row without terms becomes zero."""
    out = np.zeros((len(batch), components.shape[1]))
    sizes = batch["place"].str.len().to_numpy()
    filled = np.flatnonzero(sizes)
    for low in range(0, len(filled), AT_ONCE):
        some = filled[low : low + AT_ONCE]
        places = np.concatenate(batch["place"].to_numpy()[some]).astype(int)
        weights = np.concatenate(batch["weight"].to_numpy()[some]).astype(float)
        starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        out[some] = np.add.reduceat(weights[:, None] * components[places], starts)
    return out


def _gram_product(vectors: DataFrame, basis: np.ndarray) -> np.ndarray:
    """(X'X) basis over all messages, each counted n times.

    A task sends one partial row per term it has seen. What reaches the driver is
    terms x basis columns, at most 5000 x 60 numbers however many messages there are.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(basis)
    width = basis.shape[1]
    names = [f"b{i}" for i in range(width)]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = shared.value
        total = np.zeros_like(weights)
        for whole in batches:
            whole = whole[whole["place"].str.len() > 0]
            for start in range(0, len(whole), AT_ONCE):
                batch = whole[start : start + AT_ONCE]
                low = _project(batch, weights) * batch["n"].to_numpy()[:, None]
                sizes = batch["place"].str.len().to_numpy()
                places = np.concatenate(batch["place"].to_numpy()).astype(int)
                values = np.concatenate(batch["weight"].to_numpy()).astype(float)
                back = values[:, None] * np.repeat(low, sizes, axis=0)
                order = np.argsort(places, kind="stable")
                found, first = np.unique(places[order], return_index=True)
                total[found] += np.add.reduceat(back[order], first)
        seen = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(total[seen], columns=names).assign(place=seen)

    schema = ", ".join(f"{n} double" for n in names) + ", place int"
    parts = vectors.select("n", *_places(vectors)).mapInPandas(partial, schema)
    sums = parts.groupBy("place").agg({n: "sum" for n in names}).toPandas()
    product = np.zeros_like(basis)
    product[sums["place"].to_numpy()] = sums[[f"sum({n})" for n in names]].to_numpy()
    return product


def truncated_svd(
    vectors: DataFrame, terms: int, rows: int, k: int = COMPONENTS, passes: int = 5, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray] | None:
    """Right singular vectors (terms x k) and singular values, without centring.

    Randomised subspace iteration: each pass multiplies a thin random basis by X'X with
    one Spark job over the sparse vectors. None if fewer than two dimensions remain.
    """
    k = min(k, terms - 1, rows - 1)
    if k <= 1:
        return None
    width = min(k + 10, terms)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, width)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_gram_product(vectors, basis))[0]
    small = basis.T @ _gram_product(vectors, basis)
    values, rotation = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    components = basis @ rotation[:, order]
    # fix the sign: the entry of largest size is positive
    largest = components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])]
    return components * np.where(largest < 0, -1.0, 1.0), np.sqrt(np.maximum(values[order], 0))


def reduce_vectors(vectors: DataFrame, components: np.ndarray) -> DataFrame:
    """Adds ``reduced ARRAY<DOUBLE>``, batch by batch; no shuffle."""
    shared = vectors.sparkSession.sparkContext.broadcast(components)

    @F.pandas_udf("array<double>")
    def project(place: pd.Series, weight: pd.Series) -> pd.Series:
        return pd.Series(list(_project(pd.DataFrame({"place": place, "weight": weight}), shared.value)))

    return vectors.withColumn("reduced", project(*_places(vectors)))


def explained_variance(reduced: DataFrame, vectors: DataFrame) -> float:
    """Variance of the reduced data relative to that of the TF-IDF matrix."""
    size = reduced.select(F.size("reduced").alias("k")).first().k
    n = F.col("n")

    def variance(value: Column, total: Column) -> Column:
        mean = F.sum(n * value) / total
        return F.sum(n * value * value) / total - mean * mean

    kept = reduced.agg(
        sum(variance(F.get("reduced", F.lit(i)), F.sum(n)) for i in range(size)).alias("v")
    ).first().v
    rows = reduced.agg(F.sum("n")).scalar()
    by_term = tfidf(vectors).groupBy("term").agg(variance(F.col("weight"), F.first(rows)).alias("v"))
    whole = by_term.agg(F.sum("v").alias("v")).first().v
    return float(kept / whole) if whole else 0.0


def _cluster_sums(points: DataFrame, centers: dict[int, np.ndarray]) -> pd.DataFrame:
    """Weight, cost and weighted sum of every cluster of every restart, from one pass.

    A task returns one row per restart and cluster it has met, whatever the number of points.
    """
    width = next(iter(centers.values())).shape[1]
    names = [f"d{i}" for i in range(width)]
    shared = points.sparkSession.sparkContext.broadcast(centers)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {a: np.zeros((len(c), width + 2)) for a, c in shared.value.items()}
        for pdf in batches:
            if pdf.empty:
                continue
            x, n = np.stack(pdf["reduced"].to_numpy()), pdf["n"].to_numpy(float)
            own = (x * x).sum(axis=1)
            for a, c in shared.value.items():
                distance = (c * c).sum(axis=1)[None, :] - 2 * x @ c.T
                label = distance.argmin(axis=1)
                member = np.zeros((len(c), len(x)))
                member[label, np.arange(len(x))] = n
                totals[a][:, 0] += member.sum(axis=1)
                totals[a][:, 1] += member @ np.maximum(own + distance.min(axis=1), 0)
                totals[a][:, 2:] += member @ x
        for a, total in totals.items():
            seen = np.flatnonzero(total[:, 0])
            yield pd.DataFrame(total[seen], columns=["weight", "cost", *names]).assign(attempt=a, cluster=seen)

    schema = ", ".join(f"{c} double" for c in ("weight", "cost", *names)) + ", attempt int, cluster int"
    sums = {c: "sum" for c in ("weight", "cost", *names)}
    rows = points.select("n", "reduced").mapInPandas(partial, schema).groupBy("attempt", "cluster").agg(sums)
    return rows.toPandas().rename(columns=lambda c: c[4:-1] if c.startswith("sum(") else c)


def _first_centers(x: np.ndarray, n: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Points drawn in proportion to their weight times their distance to those drawn before."""
    chosen = [x[draw.choice(len(x), p=n / n.sum())]]
    while len(chosen) < k:
        near = np.min([((x - c) ** 2).sum(axis=1) for c in chosen], axis=0) * n
        total = near.sum()
        chosen.append(x[draw.choice(len(x), p=near / total) if total > 0 else draw.integers(len(x))])
    return np.array(chosen)


def _drawn(points: DataFrame, found: dict[int, np.ndarray], count: int, turn: int, seed: int) -> dict[int, np.ndarray]:
    """For every restart, ``count`` of all points in proportion to n times the squared distance to ``found``.

    Each point gets an exponential waiting time of that rate, from a hash of its message, and the
    first ones are drawn: one pass, ``count`` rows per task and restart, whatever the partitioning.
    """
    width = points.select(F.size("reduced").alias("k")).first().k
    names = [f"d{i}" for i in range(width)]
    shared = points.sparkSession.sparkContext.broadcast(found)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, pd.DataFrame] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            x, n = np.stack(pdf["reduced"].to_numpy()), pdf["n"].to_numpy(float)
            own, key = (x * x).sum(axis=1), pdf["key"].to_numpy(np.int64).view(np.uint64)
            for a, c in shared.value.items():
                far = np.ones(len(x))
                if len(c):
                    far = own + ((c * c).sum(axis=1)[None, :] - 2 * x @ c.T).min(axis=1)
                    far[far <= 1e-12 * (1 + own)] = 0.0
                h = key ^ np.uint64((turn * len(shared.value) + a + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
                    h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
                rate = n * far
                open_ = np.flatnonzero(rate)
                wait = -np.log(((h[open_] >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate[open_]
                first = np.argsort(wait, kind="stable")[:count]
                rows = pd.DataFrame(x[open_[first]], columns=names).assign(
                    attempt=a, wait=wait[first], message=pdf["message"].to_numpy()[open_[first]]
                )
                rows = rows if a not in held else pd.concat((held[a], rows))
                held[a] = rows.sort_values(["wait", "message"])[:count]
        yield from held.values()

    schema = ", ".join(f"{c} double" for c in names) + ", attempt int, wait double, message string"
    keyed = points.select("n", "reduced", "message", F.xxhash64("message", F.lit(seed)).alias("key"))
    by = Window.partitionBy("attempt").orderBy("wait", "message")
    rows = keyed.mapInPandas(partial, schema).withColumn("rank", F.row_number().over(by))
    rows = rows.where(F.col("rank") <= count).drop("message").toPandas().sort_values(["attempt", "rank"])
    return {a: rows.loc[rows["attempt"] == a, names].to_numpy() for a in found}


def _starts(points: DataFrame, clusters: int, restarts: int, seed: int) -> dict[int, np.ndarray]:
    """Starting centres of every restart by k-means||: candidates drawn over all points in a few rounds,
    weighted by the messages nearest to them, and thinned by draws among them."""
    width = points.select(F.size("reduced").alias("k")).first().k
    found = {a: np.zeros((0, width)) for a in range(restarts)}
    for turn in range(1 + START_ROUNDS):
        new = _drawn(points, found, START_POINTS * clusters if turn else 1, turn, seed)
        found = {a: np.concatenate((c, new[a])) for a, c in found.items()}
    weights = {a: np.zeros(len(c)) for a, c in found.items()}
    for r in _cluster_sums(points, found)[["attempt", "cluster", "weight"]].itertuples():
        weights[r.attempt][r.cluster] = r.weight
    return {a: _first_centers(c, weights[a], clusters, np.random.default_rng(seed + a)) for a, c in found.items()}


def kmeans(
    reduced: DataFrame, clusters: int, restarts: int = 10, iterations: int = 300, seed: int = SEED
) -> np.ndarray:
    """Centres of the best of ``restarts`` K-Means runs on weighted distinct messages.

    All runs move on together: one pass over the points serves every run that has not
    settled. Starting points are drawn over all points, whatever their number.
    """
    centers = _starts(reduced, clusters, restarts, seed)
    best, best_cost, active = centers[0], np.inf, dict(centers)
    for turn in range(iterations):
        sums = _cluster_sums(reduced, active)
        for a, rows in sums.groupby("attempt"):
            cost, old = rows["cost"].sum(), active[a]
            if cost < best_cost:
                best, best_cost = old, cost
            moved = old.copy()  # a cluster without points keeps its centre
            at = rows["cluster"].to_numpy()
            moved[at] = rows[[f"d{i}" for i in range(old.shape[1])]].to_numpy() / rows[["weight"]].to_numpy()
            if ((moved - old) ** 2).sum(axis=1).max() <= SETTLED**2:
                del active[a]
            else:
                active[a] = moved
        if not active:
            break
    return best


def nearest_center(points: DataFrame, centers: np.ndarray, name: str) -> DataFrame:
    """Adds the number of the nearest centre; of equally near ones the first."""
    shared = points.sparkSession.sparkContext.broadcast(centers)

    @F.pandas_udf("int")
    def nearest(reduced: pd.Series) -> pd.Series:
        x, c = np.stack(reduced.to_numpy()), shared.value
        return pd.Series(((c * c).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1))

    return points.withColumn(name, nearest("reduced"))


def number_clusters(labelled: DataFrame, raw: str = "raw_cluster") -> DataFrame:
    """Clusters numbered from 0 by size, largest first; noise keeps -1.

    How the numbers are joined back is left to the size check at run time: there is one
    row per cluster, few for K-Means, possibly many for density clusters.
    """
    sizes = (
        labelled.where(F.col(raw) != NOISE)
        .groupBy(raw)
        .agg(F.sum("n").alias("size"), F.min("first_row").alias("first"))
    )
    rank = F.row_number().over(Window.orderBy(F.desc("size"), "first")) - 1
    numbers = sizes.select(raw, rank.alias("cluster"))
    return labelled.join(numbers, raw, "left").withColumn(
        "cluster", F.coalesce("cluster", F.lit(NOISE))
    )


def cluster_terms(weights: DataFrame, sizes: DataFrame, k: int = 10) -> DataFrame:
    """Top terms per cluster by mean TF-IDF weight, zero weights left out.

    ``weights(cluster, term, n, weight)`` and ``sizes(cluster, size)``.
    """
    sums = weights.groupBy("cluster", "term").agg(F.sum(F.col("weight") * F.col("n")).alias("total"))
    mean = F.round(F.col("total") / F.col("size"), 4)
    ranked = Window.partitionBy("cluster").orderBy(F.desc("mean_weight"), "term")
    scored = sums.join(sizes, "cluster").select("cluster", "term", mean.alias("mean_weight"))
    return (
        scored.where(F.col("mean_weight") > 0)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
    )


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    """Size and percentage of every cluster, noise left out of the rows but not of the total."""
    total = labelled.agg(F.sum("n")).scalar()
    sizes = labelled.where(F.col("cluster") != NOISE).groupBy("cluster").agg(F.sum("n").alias("size"))
    return sizes.withColumn("percentage", percent(F.col("size"), total))


def cluster_representative(labelled: DataFrame, length: int = 200) -> DataFrame:
    """First message of each cluster."""
    first = F.min_by("message", "first_row")
    return (
        labelled.where(F.col("cluster") != NOISE)
        .groupBy("cluster")
        .agg(F.substring(first, 1, length).alias("representative"))
    )


def cluster_words(labelled: DataFrame, k: int = 10) -> DataFrame:
    """Commonest white-space separated words per cluster, case kept."""
    words = F.filter(
        F.split("message", f"[{fv.WHITESPACE_CLASS}]+"), lambda w: w != ""
    )
    rows = labelled.where(F.col("cluster") != NOISE).select("cluster", "n", F.explode(words).alias("word"))
    counts = rows.groupBy("cluster", "word").agg(F.sum("n").alias("count"))
    ranked = Window.partitionBy("cluster").orderBy(F.desc("count"), "word")
    return counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


@dataclass
class PatternModel:
    """Vocabulary (at most max_terms), reduction and centres, and the described clusters."""

    algorithm: str
    vocab: pd.DataFrame  # place, term, idf
    components: np.ndarray | None
    centers: np.ndarray | None
    clusters: DataFrame  # CLUSTER_SCHEMA; a table, since density clusters can be many

    def summary(self) -> DataFrame:
        """One row per pattern with its five strongest terms."""
        return self.clusters.select(
            F.concat(F.lit("pattern_"), F.col("cluster").cast("string")).alias("pattern"),
            "size",
            "percentage",
            F.array_join(F.slice("top_terms.term", 1, 5), ", ").alias("top_keywords"),
            "representative",
        )

    def assign(self, df: DataFrame) -> DataFrame:
        """Nearest centre for new messages (K-Means only)."""
        if self.centers is None:
            raise RuntimeError("only a K-Means model can label new messages")
        spark = df.sparkSession
        vocab = spark.createDataFrame(self.vocab, "place int, term string, idf double")
        vectors = message_vectors(weighted_messages(df), vocab)
        reduced = reduce_vectors(vectors, _components_or_identity(self.components, len(self.vocab)))
        return nearest_center(reduced, self.centers, "cluster").select("message", "n", "first_row", "cluster")

    def save(self, spark: SparkSession, folder: str) -> None:
        width = 0 if self.components is None else self.components.shape[1]
        vocab = self.vocab.assign(
            components=[[]] * len(self.vocab) if width == 0 else self.components.tolist()
        )
        spark.createDataFrame(
            vocab, "place int, term string, idf double, components array<double>"
        ).write.mode("overwrite").parquet(f"{folder}/vocabulary")
        centers = [] if self.centers is None else [(i, list(map(float, c))) for i, c in enumerate(self.centers)]
        spark.createDataFrame(centers, "cluster int, center array<double>").write.mode("overwrite").parquet(
            f"{folder}/centers"
        )
        self.clusters.write.mode("overwrite").json(f"{folder}/clusters")
        spark.createDataFrame([(self.algorithm,)], "algorithm string").write.mode("overwrite").json(
            f"{folder}/metadata"
        )

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "PatternModel":
        vocab = spark.read.parquet(f"{folder}/vocabulary").orderBy("place").toPandas()
        centers = spark.read.parquet(f"{folder}/centers").orderBy("cluster").toPandas()
        clusters = spark.read.schema(CLUSTER_SCHEMA).json(f"{folder}/clusters")
        algorithm = spark.read.schema("algorithm string").json(f"{folder}/metadata").first().algorithm
        components = np.array(vocab.pop("components").tolist(), dtype=float)
        return cls(
            algorithm,
            vocab,
            components if components.size else None,
            np.array(centers["center"].tolist()) if len(centers) else None,
            clusters,
        )


CLUSTER_SCHEMA = (
    "cluster int, size bigint, percentage double, representative string, "
    "top_terms array<struct<term: string, mean_weight: double>>, common_words array<string>"
)


def _components_or_identity(components: np.ndarray | None, terms: int) -> np.ndarray:
    return np.eye(terms) if components is None else components


def fit_patterns(
    df: DataFrame,
    algorithm: str = "kmeans",
    clusters: int = 10,
    max_terms: int = MAX_TERMS,
    restarts: int = 10,
) -> tuple[PatternModel, DataFrame]:
    """The whole pattern job on ``df(row_id, message)``.

    Returns the model and (message, n, first_row, cluster) for the distinct messages;
    join on ``message`` to label every row.
    """
    if algorithm not in ("kmeans", "dbscan"):
        raise ValueError(f"unknown algorithm {algorithm!r}: use 'kmeans' or 'dbscan'")
    spark = df.sparkSession
    docs = written(weighted_messages(df), "messages")
    rows = docs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first().rows
    vocab = vocabulary(docs, max_terms).select("term", "idf").toPandas()
    if not len(vocab):
        raise ValueError("no term occurs in at least two and at most 95 % of the messages")
    vocab = vocab.sort_values("term", ignore_index=True)
    vocab.insert(0, "place", np.arange(len(vocab), dtype="int32"))
    vocab_table = spark.createDataFrame(vocab, "place int, term string, idf double")
    vectors = written(message_vectors(docs, vocab_table), "vectors")

    svd = truncated_svd(vectors, len(vocab), rows)
    components = None if svd is None else svd[0]
    reduced = written(
        reduce_vectors(vectors, _components_or_identity(components, len(vocab))), "reduced"
    )
    centers = None
    if algorithm == "kmeans":
        found = kmeans(reduced, max(min(clusters, rows - 1), 2), restarts)
        labelled = nearest_center(reduced, found, "raw_cluster")
    else:
        labelled = dbscan(reduced)
    labelled = written(
        number_clusters(labelled.select("message", "n", "first_row", "terms", "raw_cluster")), "clusters"
    )
    if algorithm == "kmeans":
        numbers = labelled.select("cluster", "raw_cluster").distinct().orderBy("cluster").collect()
        centers = found[[r.raw_cluster for r in numbers]]

    sizes = cluster_sizes(labelled)
    terms = cluster_terms(labelled.select("cluster", "n", F.inline("terms")), sizes)
    top = terms.groupBy("cluster").agg(
        F.sort_array(F.collect_list(F.struct("rank", "term", "mean_weight"))).alias("ranked")
    ).select(
        "cluster",
        F.transform(
            "ranked", lambda t: F.struct(t["term"].alias("term"), t["mean_weight"].alias("mean_weight"))
        ).alias("top_terms"),
    )
    words = cluster_words(labelled).groupBy("cluster").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word")))["word"].alias("common_words")
    )
    info = (
        sizes.join(cluster_representative(labelled), "cluster")
        .join(top, "cluster", "left")
        .join(words, "cluster", "left")
        .select("cluster", "size", "percentage", "representative", "top_terms", "common_words")
    )
    model = PatternModel(algorithm, vocab, components, centers, written(info, "patterns"))
    return model, labelled.select("message", "n", "first_row", "cluster")


def pattern_counts(labelled: DataFrame) -> DataFrame:
    """Number of clusters and of messages labelled as noise."""
    return labelled.agg(
        F.countDistinct(F.when(F.col("cluster") != NOISE, F.col("cluster"))).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col("cluster") == NOISE, F.col("n"))), F.lit(0)).alias("n_noise"),
    )
