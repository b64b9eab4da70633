"""Registered queries: isolation forest and message patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import anomaly_severity
from loglake.functions.text_columns import identifiers, ngrams, once
from loglake.operators import anomaly, patterns
from loglake.operators.enrich import enrich_logs
from loglake.operators.features import record_features
from loglake.registry import sql_views as v
from loglake.session import by_key, scratch_path, written
from loglake.sources import test_tables as t


def _enriched(spark, sf_dir):
    return enrich_logs(t.logs(spark, sf_dir))


def _given_labels(spark, sf_dir):
    """Features with a given label in the place of the model's."""
    rows = record_features(_enriched(spark, sf_dir), keep=["row_id", "level"])
    score = (F.lit(300) - F.col("duration_ms")) / 1000
    return rows.withColumns(
        {
            "is_anomaly": (F.col("level") == "CRITICAL").cast("int"),
            "anomaly_score": score,
            "anomaly_severity": anomaly_severity(score),
        }
    )


def _fitted(spark, sf_dir):
    features = record_features(_enriched(spark, sf_dir), keep=["row_id", "timestamp", "message"])
    return anomaly.AnomalyDetector().fit(features, fv.NUMERIC_FEATURES), features


def forest_nodes(spark, sf_dir):
    detector, _ = _fitted(spark, sf_dir)
    return spark.createDataFrame(detector.nodes, anomaly.NODE_SCHEMA)


def forest_scores(spark, sf_dir):
    detector, features = _fitted(spark, sf_dir)
    return detector.predict(features).select(
        "row_id", "timestamp", "message", "anomaly_label", "is_anomaly", "anomaly_score", "anomaly_severity"
    )


def training_stats(spark, sf_dir):
    detector, features = _fitted(spark, sf_dir)
    return anomaly.training_stats(detector.predict(features), len(detector.names))


def forest_roundtrip(spark, sf_dir):
    """Labels of the saved and reloaded model next to those of the original."""
    detector, features = _fitted(spark, sf_dir)
    folder = scratch_path(spark, "anomaly-model")
    detector.save(spark, folder)
    again = anomaly.AnomalyDetector.load(spark, folder)
    first = detector.predict(features).select("row_id", "anomaly_score", "is_anomaly")
    renamed = first.withColumnsRenamed({"anomaly_score": "score_before", "is_anomaly": "label_before"})
    narrow = again.predict(features.drop("timestamp", "message")).select("row_id", "anomaly_score", "is_anomaly")
    return narrow.join(renamed, "row_id")


def summary_given(spark, sf_dir):
    """Totals and the features that set anomalous rows apart."""
    labelled = _given_labels(spark, sf_dir)
    top = anomaly.top_anomalous_features(labelled).select(F.col("feature").alias("key"), F.col("shift").alias("value"))
    totals = anomaly.anomaly_totals(labelled)
    names = totals.columns
    entries = F.array(*(F.struct(F.lit(n).alias("key"), F.col(n).cast("double").alias("value")) for n in names))
    severities = anomaly.severity_distribution(labelled)
    return (
        totals.select(F.inline(entries))
        .unionByName(severities.select(F.col("severity").alias("key"), F.col("records").cast("double").alias("value")))
        .unionByName(top)
    )


def term_rows(spark, sf_dir):
    words = once(identifiers(F.col("message"), fv.TERM_STOP_WORDS)).alias("words")
    # all terms of a row are counted where the row is: no shuffle of terms, and so many groups in a task
    rows = by_key(t.messages(spark, sf_dir), "row_id", 50_000).select("row_id", words)
    both = rows.select("row_id", F.explode(F.concat("words", ngrams(F.col("words"), 2))).alias("term"))
    return both.groupBy("row_id", "term").agg(F.count("*").alias("tf"))


def vocabulary(spark, sf_dir):
    vocab = patterns.vocabulary(patterns.weighted_messages(t.messages(spark, sf_dir)))
    return vocab.select("term", "df", "corpus_count", F.round("idf", 9).alias("idf"))


def _vectors(spark, sf_dir):
    docs = written(patterns.weighted_messages(t.messages(spark, sf_dir)), "messages")
    return patterns.message_vectors(docs, patterns.placed(patterns.vocabulary(docs)))


def weights(spark, sf_dir):
    return patterns.tfidf(_vectors(spark, sf_dir)).select("message", "n", "term", F.round("weight", 9).alias("weight"))


def _given_clusters(spark, sf_dir):
    """The severity in the place of a cluster number."""
    rows = _enriched(spark, sf_dir).withColumnRenamed("severity_num", "cluster")
    return rows.groupBy("cluster", "message").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))


def given_terms(spark, sf_dir):
    labelled = _given_clusters(spark, sf_dir)
    rows = labelled.join(_vectors(spark, sf_dir).select("message", "terms"), "message")
    top = patterns.cluster_terms(rows.select("cluster", "n", F.inline("terms")), patterns.cluster_sizes(labelled))
    return top.select("cluster", "rank", "term", "mean_weight")


def given_representatives(spark, sf_dir):
    labelled = _given_clusters(spark, sf_dir)
    return patterns.cluster_sizes(labelled).join(patterns.cluster_representative(labelled), "cluster")


def components(spark, sf_dir):
    """Length of each singular direction of the TF-IDF matrix."""
    docs = written(patterns.weighted_messages(t.messages(spark, sf_dir)), "messages")
    vocab = written(patterns.vocabulary(docs), "vocabulary")
    # every pass of the SVD reads the vectors
    vectors = written(patterns.message_vectors(docs, patterns.placed(vocab)), "vectors")
    rows = docs.agg(F.sum("n").alias("n")).first().n
    svd = patterns.truncated_svd(vectors, vocab.count(), rows)
    values = [] if svd is None else svd[1].tolist()
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], "dimension int, singular_value double")


def _patterns(algorithm):
    return lambda spark, sf_dir: patterns.fit_patterns(t.messages(spark, sf_dir), algorithm)[1]


def pattern_summary(spark, sf_dir):
    return patterns.fit_patterns(t.messages(spark, sf_dir))[0].summary()


def pattern_counts(spark, sf_dir):
    return patterns.pattern_counts(patterns.fit_patterns(t.messages(spark, sf_dir))[1])


def pattern_roundtrip(spark, sf_dir):
    """Clusters that the saved and reloaded model gives to the same messages."""
    model, labelled = patterns.fit_patterns(t.messages(spark, sf_dir))
    folder = scratch_path(spark, "pattern-model")
    model.save(spark, folder)
    again = patterns.PatternModel.load(spark, folder).assign(t.messages(spark, sf_dir))
    before = labelled.select("message", F.col("cluster").alias("cluster_before"))
    return again.join(before, "message")


QUERIES = {
    "iforest_nodes": forest_nodes,
    "iforest_scores": forest_scores,
    "training_stats": training_stats,
    "anomaly_model_roundtrip": forest_roundtrip,
    "anomaly_summary": summary_given,
    "pattern_terms": term_rows,
    "pattern_vocabulary": vocabulary,
    "tfidf": weights,
    "cluster_terms": given_terms,
    "cluster_representative": given_representatives,
    "cluster_words": lambda s, d: patterns.cluster_words(_given_clusters(s, d)),
    "svd_components": components,
    "kmeans_patterns": _patterns("kmeans"),
    "dbscan_patterns": _patterns("dbscan"),
    "pattern_summary": pattern_summary,
    "pattern_counts": pattern_counts,
    "pattern_model_roundtrip": pattern_roundtrip,
}

_LABELLED = """select *, (300 - duration_ms) / 1000 as score from (
  select f.*, l.is_anomaly from raw_features f join labelled l on f.row_id = l.row_id)"""
_SEVERITY_BINS = {
    "critical": "score <= -0.3", "high": "score > -0.3 and score <= -0.1", "medium": "score > -0.1 and score <= 0",
    "normal": "score > 0",
}
_TOTALS = f"""
select 'total_records' as key, cast(count(*) as double) as value from scored
union all select 'total_anomalies', cast(sum(is_anomaly) as double) from scored
union all select 'anomaly_rate', round(sum(is_anomaly) / count(*) * 100, 2) from scored
union all select 'score_mean', round(avg(score), 4) from scored
union all select 'score_std', round(stddev_samp(score), 4) from scored
union all select 'anomaly_threshold', round(max(score) filter (where is_anomaly = 1), 4) from scored
""" + "".join(
    f"union all select '{s}', cast(count(*) filter (where is_anomaly = 1 and {b}) as double) from scored\n"
    for s, b in _SEVERITY_BINS.items()
)
_SHIFTS = " union all ".join(
    f"select '{n}' as key, avg({n}) filter (where is_anomaly = 1) as a, avg({n}) filter (where is_anomaly = 0) as b from scored"
    for n in fv.NUMERIC_FEATURES
)

ORACLES = {
    "anomaly_summary": v.with_views(
        f"""select * from (with scored as ({_LABELLED}) {_TOTALS})
            union all select * from (with scored as ({_LABELLED})
              select key, round(abs(a - b) / abs(b), 4) as value from ({_SHIFTS}) where b <> 0 order by value desc, key limit 10)""",
        "raw_features", "labelled",
    ),
    "pattern_terms": v.with_views("select row_id, term, count(*) as tf from terms group by row_id, term", "terms"),
    "pattern_vocabulary": v.with_views(
        "select term, df, corpus_count, round(idf, 9) as idf from vocabulary", "vocabulary"
    ),
    "tfidf": v.with_views(
        "select message, count(*) as n, term, round(any_value(weight), 9) as weight from weights group by message, term",
        "weights",
    ),
    "cluster_terms": v.with_views(
        """select cluster, cast(rank as int) as rank, term, mean_weight from (
             select *, row_number() over (partition by cluster order by mean_weight desc, term) as rank from (
               select e.severity_num as cluster, w.term, round(sum(w.weight) / any_value(s.size), 4) as mean_weight
               from weights w join enriched e on w.row_id = e.row_id
               join (select severity_num, count(*) as size from enriched group by severity_num) s on s.severity_num = e.severity_num
               group by e.severity_num, w.term)
             where mean_weight > 0)
           where rank <= 10""",
        "weights", "enriched",
    ),
    "cluster_representative": v.with_views(
        """select severity_num as cluster, count(*) as size,
             round(count(*) / (select count(*) from enriched) * 100, 2) as percentage,
             substring(arg_min(message, row_id), 1, 200) as representative
           from enriched group by severity_num""",
        "enriched",
    ),
    "cluster_words": v.with_views(
        r"""select cluster, word, count, cast(rank as int) as rank from (
              select *, row_number() over (partition by cluster order by count desc, word) as rank from (
                select cluster, word, count(*) as count from (
                  select severity_num as cluster, unnest(regexp_split_to_array(message, '\s+')) as word from enriched)
                where word <> '' group by cluster, word))
            where rank <= 10""",
        "enriched",
    ),
}
