import numpy as np

from loglake.llm import ann
from loglake.llm.queries.op9_ann import EVERY, op9_ann


def brute(ids, x, queries, k):
    x = np.array(x, np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        score = (x * x[ids.index(q)]).sum(axis=1)
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(score[i], 12), ids[i]))[:k]
        out[q] = [(ids[i], score[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_on_the_test_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids = table.vec_id.tolist()
    want = brute(ids, table.embedding.tolist(), [i for i in ids if i % EVERY == 0], 5)
    got = found(op9_ann(spark, folder))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    known = dict(zip(ids, np.array(table.embedding.tolist(), np.float64)))
    for q, rows in got.items():
        assert len(rows) == 5 and rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        for i, score in rows:
            a, b = known[q], known[i]
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-9


def test_few_odd_and_equal_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 3), 2.0]) for i in range(12)]
    odd = [(20, None), (21, [0.0, 0.0, 0.0]), (22, [nan, 1.0, 1.0]), (23, [inf, 1.0, 1.0]), (24, [1.0, None, 2.0]), (25, []), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id bigint, embedding array<float>, list string, block int")
    got = found(ann.search(table, table, "vec_id", "embedding"))
    want = brute([i for i, _ in rows], [v for _, v in rows], range(12), 5)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    two = table.where("vec_id < 2")
    assert {q: [i for i, _ in r] for q, r in found(ann.search(two, two, "vec_id", "embedding")).items()} == {0: [1], 1: [0]}
    assert ann.search(table.limit(0), table, "vec_id", "embedding").isEmpty()
    assert ann.search(table, table.limit(0), "vec_id", "embedding").isEmpty()


def test_walk_finds_the_nearest_centroids():
    draw = np.random.default_rng(1)
    index = ann.fit(draw.normal(size=(3000, 16)))
    hits = 0
    for q in ann.unit(draw.normal(size=(50, 16))):
        best = set(np.argsort(-index.centroids @ q)[:5].tolist())
        hits += len(best & {n for _, n in index.walk(q, 32)[:5]})
    assert hits >= 0.9 * 250
    assert np.bincount([lists[0] for lists in index.posting(ann.unit(draw.normal(size=(3000, 16))))]).max() < 3000 / 4
