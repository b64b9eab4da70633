"""DBSCAN against a plain brute-force run on a small fixture."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from loglake.operators.density import _core_points, _local_clusters, dbscan, standard_points


def brute_force(x, n, eps, min_points):
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = (near * n[None, :]).sum(axis=1) >= min_points
    label = np.full(len(x), -1)
    for start in range(len(x)):
        if not core[start] or label[start] != -1:
            continue
        label[start] = start
        waiting = [start]
        while waiting:
            for q in np.flatnonzero(near[waiting.pop()]):
                if label[q] == -1:
                    label[q] = start
                    if core[q]:
                        waiting.append(q)
    return label


@pytest.mark.parametrize("cell_points", [4096, 12])
def test_same_clusters_as_brute_force(spark, cell_points):
    random = np.random.default_rng(7)
    centers = random.normal(size=(6, 3)) * 3
    x = np.concatenate([c + random.normal(size=(25, 3)) * 0.25 for c in centers] + [random.normal(size=(20, 3)) * 4])
    x = x[random.permutation(len(x))]
    n = random.integers(1, 4, len(x))
    rows = [(i, int(n[i]), x[i].tolist()) for i in range(len(x))]
    df = spark.createDataFrame(rows, "first_row bigint, n bigint, reduced array<double>")

    scaled = {r.point: r.x for r in standard_points(df).collect()}
    expected = brute_force(np.array([scaled[i] for i in range(len(x))]), n, 0.5, 5)
    assert len(set(expected)) > 3 and (expected == -1).any()

    got = {r.first_row: r.raw_cluster for r in dbscan(df, 0.5, 5, cell_points).collect()}
    assert len(got) == len(x)
    assert [-1 if got[i] is None else got[i] for i in range(len(x))] == expected.tolist()


def test_a_crowded_cell_takes_little_memory():
    """All points of a cell near each other: no list of all pairs, no differences of all pairs."""
    x = np.random.default_rng(0).normal(size=(2000, 50)) * 0.01
    x[1000:] += 10
    cell = pd.DataFrame({"cell": "", "home": True, "point": np.arange(2000), "n": 1, "x": list(x), "core": True})
    tracemalloc.start()
    core = _core_points(0.5, 5)(cell)
    members = _local_clusters(0.5)(cell)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(core) == 2000 and peak < 50e6
    assert members.groupby("part")["point"].agg(["min", "max", "size"]).values.tolist() == [[0, 999, 1000], [1000, 1999, 1000]]
