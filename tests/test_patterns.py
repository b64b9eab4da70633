import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loglake.operators import patterns as P
from loglake.registry import models
from loglake.session import by_key


@pytest.fixture(scope="module")
def messages(spark):
    kinds = ("disk quota exceeded on volume", "login accepted for account", "cache miss for shard")
    text = F.element_at(F.array(*map(F.lit, kinds)), (F.col("id") % 3 + 1).cast("int"))
    suffix = F.concat(F.lit(" n"), (F.col("id") % 5).cast("string"))
    return spark.range(300).select(F.col("id").alias("row_id"), F.concat(text, suffix).alias("message"))


def test_kmeans_separates_message_kinds(spark, messages, tmp_path):
    model, labelled = P.fit_patterns(messages, clusters=3, restarts=3)
    rows = labelled.toPandas()
    kinds = rows["message"].str.split().str[0]
    assert rows.groupby(kinds)["cluster"].nunique().eq(1).all() and rows["cluster"].nunique() == 3
    assert [r["size"] for r in model.clusters.collect()] == [100, 100, 100]
    model.save(spark, str(tmp_path / "model"))
    again = P.PatternModel.load(spark, str(tmp_path / "model")).assign(messages)
    assert model.summary().where("size(split(top_keywords, ', ')) = 5").count() == 3
    both = again.join(labelled.select("message", F.col("cluster").alias("before")), "message")
    assert both.count() == 15 and both.where("cluster <> before").isEmpty()


def test_kmeans_starts_are_drawn_over_all_points(spark):
    """Three remote points, the last of 5,000 in hash order, get a centre; so does one heavy message, also last."""
    names = spark.range(5000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("message"))
    names = [r.message for r in names.orderBy(F.xxhash64("message", F.lit(P.SEED)), "message").collect()]
    draw = np.random.default_rng(1)
    points = [(m, 1, [float(v) for v in draw.normal(size=2)]) for m in names[:-4]]
    points += [(m, 1, [200.0, 0.1 * i]) for i, m in enumerate(names[-4:-1])] + [(names[-1], 2500, [0.0, 30.0])]
    reduced = spark.createDataFrame(points, "message string, n bigint, reduced array<double>")
    centers = P.kmeans(reduced.repartition(3), 3, restarts=2)
    assert np.allclose(centers[centers[:, 0].argmax()], [200, 0.1]) and np.allclose(centers[centers[:, 1].argmax()], [0, 30])
    again = P._starts(reduced.repartition(7), 3, 2, P.SEED)
    for a, starts in P._starts(reduced.coalesce(1), 3, 2, P.SEED).items():
        assert np.allclose(starts, again[a])


def test_svd_matches_numpy(spark, messages):
    docs = P.weighted_messages(messages)
    vocab = P.placed(P.vocabulary(docs)).cache()
    vectors = P.message_vectors(docs, vocab)
    terms = vocab.count()
    dense = np.zeros((docs.count(), terms))
    for i, row in enumerate(vectors.collect()):
        for t in row.terms:
            dense[i, t.place] = t.weight * np.sqrt(row.n)
    _, values = P.truncated_svd(vectors, terms, 300, k=5)
    assert np.allclose(values, np.linalg.svd(dense)[1][:5], rtol=1e-6)


def test_messages_without_terms_are_kept(spark):
    rows = [(0, "alpha beta"), (1, "alpha beta"), (2, "gamma delta"), (3, "gamma delta"), (4, "123 456"), (5, "")]
    _, labelled = P.fit_patterns(spark.createDataFrame(rows, "row_id bigint, message string"), clusters=2, restarts=2)
    assert {r.message for r in labelled.collect()} == {"alpha beta", "gamma delta", "123 456"}


def test_errors(spark, messages):
    with pytest.raises(ValueError):
        P.fit_patterns(messages, algorithm="other")
    with pytest.raises(ValueError):
        P.fit_patterns(spark.createDataFrame([(1, "only once")], "row_id bigint, message string"))


def test_terms_of_a_row_are_counted_in_tasks_of_bounded_size(spark, sf_dir):
    """Messages are dealt by row before their terms are made; the terms themselves are not shuffled."""
    assert by_key(spark.range(1000), "id", 10).rdd.getNumPartitions() == 100
    plan = models.term_rows(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(row_id") == plan.count("hashpartitioning(") == 1


def test_projection_of_a_large_batch_takes_little_memory():
    """10,000 messages of 20 terms and 60 columns: 96 MB if all terms were multiplied at once."""
    draw = np.random.default_rng(0)
    batch = pd.DataFrame({"place": list(draw.integers(0, 500, (10000, 20))), "weight": list(draw.random((10000, 20)))})
    basis = draw.random((500, 60))
    tracemalloc.start()
    out = P._project(batch, basis)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    assert np.allclose(out[77], batch["weight"][77] @ basis[batch["place"][77]])


def test_svd_query_reads_written_vectors(spark, sf_dir, monkeypatch):
    """The passes of the SVD do not make the vectors again."""
    seen = []
    monkeypatch.setattr(P, "truncated_svd", lambda vectors, *rest: seen.append(vectors._jdf.queryExecution().executedPlan().toString()))
    models.components(spark, sf_dir)
    assert "FileScan parquet" in seen[0] and "Exchange" not in seen[0]
