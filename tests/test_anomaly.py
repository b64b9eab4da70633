import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loglake.operators import anomaly
from loglake.operators.anomaly import AnomalyDetector, anomaly_totals, average_path, severity_distribution

NAMES = [f"feat_{i}" for i in range(5)]


@pytest.fixture(scope="module")
def features(spark):
    random = np.random.default_rng(42)
    x = np.vstack([random.normal(size=(500, 5)), random.normal(size=(25, 5)) * 10 + 5])
    rows = [(i, *map(float, row)) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"{n} double" for n in NAMES)).cache()


@pytest.fixture(scope="module")
def detector(features):
    return AnomalyDetector(trees=100).fit(features, NAMES)


def test_training(detector):
    assert detector.stats["n_samples"] == 525
    assert 0 < detector.stats["n_anomalies"] <= 27
    assert detector.nodes.groupby("tree")["size"].max().eq(256).all()


def test_planted_outliers_are_found(detector, features):
    rows = detector.predict(features).toPandas()
    assert set(rows["is_anomaly"]) == {0, 1}
    assert {"anomaly_score", "anomaly_severity", "anomaly_label"} <= set(rows)
    planted = rows[rows["row_id"] >= 500]
    assert planted["is_anomaly"].mean() > 0.8
    assert rows[rows["row_id"] < 500]["is_anomaly"].mean() < 0.02


def test_same_forest_for_any_partitioning(detector, features):
    again = AnomalyDetector(trees=100).fit(features.repartition(7), NAMES)
    assert again.nodes.drop(columns="threshold").equals(detector.nodes.drop(columns="threshold"))
    assert np.allclose(again.nodes["threshold"], detector.nodes["threshold"])
    assert again.offset == pytest.approx(detector.offset)


def test_summary(detector, features):
    labelled = detector.predict(features)
    totals = anomaly_totals(labelled).first()
    assert totals.total_records == 525 and totals.total_anomalies == detector.stats["n_anomalies"]
    assert severity_distribution(labelled).agg(F.sum("records")).first()[0] == totals.total_anomalies


def test_save_and_load(spark, detector, features, tmp_path):
    detector.save(spark, str(tmp_path / "model"))
    again = AnomalyDetector.load(spark, str(tmp_path / "model"))
    a = detector.predict(features).orderBy("row_id").toPandas()
    b = again.predict(features).orderBy("row_id").toPandas()
    assert np.allclose(a["anomaly_score"], b["anomaly_score"])


def test_missing_and_broken_features(detector, features):
    odd = features.drop("feat_4").withColumn("feat_0", F.lit(float("nan"))).withColumn("extra", F.lit(1))
    rows = detector.predict(odd)
    assert rows.where("anomaly_score is null or isnan(anomaly_score)").isEmpty() and "extra" in rows.columns


def test_predict_before_fit(features):
    with pytest.raises(RuntimeError):
        AnomalyDetector().predict(features)


def test_average_path():
    assert average_path([1, 2, 3]).tolist() == pytest.approx([0, 1, 2 * (np.log(2) + np.euler_gamma) - 4 / 3])


def test_all_rows_walk_a_level_without_looking_up_children():
    """Levels are whole, so places are computed; scores are those of a walk from node to node."""
    draw = np.random.default_rng(1)
    x = np.round(draw.normal(size=(5000, 4)), 1)
    x[0, 2] = np.nan
    grow = anomaly._grow(3)
    nodes = pd.concat([grow(pd.DataFrame({"tree": t, "place": range(64), "values": list(x[1 + t :: 70][:64])})) for t in range(5)])
    forest = anomaly.forest_arrays(nodes)
    assert [feature.shape for feature, _ in forest["levels"]] == [(5, 1 << k) for k in range(len(forest["levels"]))]
    rows = {(n.tree, n.node): n for n in nodes.itertuples()}
    paths = np.zeros(len(x))
    for tree in range(5):
        for i, row in enumerate(x):
            at = rows[tree, 0]
            while at.feature >= 0:
                at = rows[tree, at.left if row[at.feature] <= at.threshold else at.right]
            paths[i] += at.depth + average_path(np.array([at.size]))[0]
    assert np.array_equal(anomaly.walk_trees(forest, x), -np.power(2.0, -paths / 5 / forest["normal"]))
