"""Registered queries: what models must satisfy whatever their random choices, as rows SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import anomaly_severity
from loglake.operators import anomaly, patterns
from loglake.plans import report
from loglake.registry import models, storage
from loglake.registry import sql_views as v
from loglake.sources import test_tables as t

CONTAMINATION_SLACK = 1.0


def scores_checked(spark, sf_dir):
    """Labels follow the sign of the score, severities its bins; the share of anomalies is as asked for."""
    scored = models.forest_scores(spark, sf_dir)
    return scored.select(
        "row_id",
        ((F.col("is_anomaly") == 1) == (F.col("anomaly_score") < 0)).alias("label_follows_score"),
        (F.col("anomaly_severity") == anomaly_severity(F.col("anomaly_score"))).alias("severity_follows_score"),
    )


def training_checked(spark, sf_dir):
    stats = models.training_stats(spark, sf_dir)
    return stats.select(
        "n_samples", "n_features",
        (F.abs(F.col("anomaly_rate") - 5) <= CONTAMINATION_SLACK).alias("rate_as_asked"),
        (F.col("score_min") <= F.col("score_mean")).alias("ordered"),
    )


def anomaly_results_checked(spark, sf_dir):
    """In the stored table, scores below 0 are anomalies and the severity is that of the score."""
    score = F.col("anomaly_score")
    severity = F.when(score <= -0.3, "critical").when(score <= -0.1, "high").when(score <= 0, "medium").otherwise("normal")
    follows = (F.col("is_anomaly") == (score < 0).cast("int")) & (F.col("anomaly_severity") == severity)
    return storage.anomaly_results(spark, sf_dir).select("row_id", "timestamp", "message", F.coalesce(follows, F.lit(False)).alias("labelled"))


def anomaly_roundtrip_checked(spark, sf_dir):
    rows = models.forest_roundtrip(spark, sf_dir)
    same = (F.abs(F.col("anomaly_score") - F.col("score_before")) < 1e-9) & (F.col("is_anomaly") == F.col("label_before"))
    return rows.select("row_id", same.alias("same"))


def anomaly_rates(spark, sf_dir):
    return anomaly.anomaly_rates(storage._labelled(spark, sf_dir))


def _labels_checked(algorithm):
    def labels(spark, sf_dir):
        rows = patterns.fit_patterns(t.messages(spark, sf_dir), algorithm)[1]
        return rows.select("message", "n", "first_row", (F.col("cluster") >= patterns.NOISE).alias("labelled"))

    return labels


def summary_checked(spark, sf_dir):
    """Sizes add up, clusters are numbered by size, and every one has words and a message of its own."""
    model, labelled = patterns.fit_patterns(t.messages(spark, sf_dir))
    held = labelled.groupBy("cluster").agg(F.sum("n").alias("held"))
    own = labelled.select("cluster", F.col("message").alias("representative"), F.lit(True).alias("own"))
    rows = model.clusters.join(held, "cluster").join(own, ["cluster", "representative"], "left")
    in_order = F.array_sort(F.collect_list(F.struct("cluster", "size")))["size"]
    return rows.agg(
        F.sum("size").alias("records"),
        F.bool_and(F.col("size") == F.col("held")).alias("sizes_match"),
        F.bool_and(F.coalesce("own", F.lit(False))).alias("own_message"),
        F.bool_and(F.size("common_words") > 0).alias("has_words"),
        (in_order == F.reverse(F.array_sort(in_order))).alias("by_size"),
    )


def pattern_roundtrip_checked(spark, sf_dir):
    rows = models.pattern_roundtrip(spark, sf_dir)
    return rows.select("message", (F.col("cluster") == F.col("cluster_before")).alias("same"))


def directions_checked(spark, sf_dir):
    """Squared lengths fall and stay below the squared size of the matrix, which has one unit row per message with terms."""
    vectors = models._vectors(spark, sf_dir)
    whole = vectors.select(F.col("n") * F.aggregate("terms", F.lit(0.0), lambda s, x: s + x["weight"] * x["weight"]))
    size = whole.toDF("s").agg(F.sum("s").alias("s")).first().s
    values = [r.singular_value for r in models.components(spark, sf_dir).orderBy("dimension").collect()]
    falling = all(a >= b - 1e-9 for a, b in zip(values, values[1:]))
    below = sum(x * x for x in values) <= size * (1 + 1e-9)
    return spark.createDataFrame([(falling, below)], "falling boolean, below boolean")


def report_checked(spark, sf_dir):
    """The report document read back: its sections and the number of entries of each."""
    whole = report.report_document(storage.sections(spark, sf_dir))
    sections = F.from_json("report", "map<string, string>")
    read = whole.select(F.explode(sections).alias("section", "content"))
    return read.select("section", F.size(F.map_keys(F.from_json("content", "map<string, double>"))).cast("bigint").alias("entries"))


QUERIES = {
    "iforest_scores_checked": scores_checked,
    "training_stats_checked": training_checked,
    "anomaly_results_checked": anomaly_results_checked,
    "anomaly_roundtrip_checked": anomaly_roundtrip_checked,
    "anomaly_rates": anomaly_rates,
    "kmeans_labels_checked": _labels_checked("kmeans"),
    "dbscan_labels_checked": _labels_checked("dbscan"),
    "pattern_summary_checked": summary_checked,
    "pattern_roundtrip_checked": pattern_roundtrip_checked,
    "svd_checked": directions_checked,
    "report_document_checked": report_checked,
}

_MESSAGES = "select message, count(*) as n, min(row_id) as first_row, true as labelled from logs group by message"
ORACLES = {
    "iforest_scores_checked": v.with_views(
        "select row_id, true as label_follows_score, true as severity_follows_score from logs", "logs"
    ),
    "training_stats_checked": v.with_views(
        f"select count(*) as n_samples, {len(fv.NUMERIC_FEATURES)} as n_features, true as rate_as_asked, true as ordered from logs",
        "logs",
    ),
    "anomaly_results_checked": v.with_views("select row_id, timestamp, message, true as labelled from logs", "logs"),
    "anomaly_roundtrip_checked": v.with_views("select row_id, true as same from logs", "logs"),
    "anomaly_rates": v.with_views(
        """select count(*) filter (where is_anomaly = 1) as total,
             round(count(*) filter (where is_anomaly = 1) / count(*) * 100, 1) as rate,
             count(*) filter (where is_anomaly = 1 and (300 - duration_ms) / 1000 <= -0.3) as critical from labelled""",
        "labelled",
    ),
    "kmeans_labels_checked": v.with_views(_MESSAGES, "logs"),
    "dbscan_labels_checked": v.with_views(_MESSAGES, "logs"),
    "pattern_summary_checked": v.with_views(
        "select count(*) as records, true as sizes_match, true as own_message, true as has_words, true as by_size from logs", "logs"
    ),
    "pattern_roundtrip_checked": v.with_views("select distinct message, true as same from logs", "logs"),
    "svd_checked": "select true as falling, true as below",
    "report_document_checked": f"select section, count(*) as entries from ({storage.ORACLES['report_sections']}) group by section",
}
