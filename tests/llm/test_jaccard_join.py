from collections import defaultdict

import numpy as np

from conftest_llm import odd_rows, words_of
from loglake.llm import jaccard_join
from loglake.llm.components import components
from loglake.llm.queries.op4_jaccard_join import op4_jaccard_join
from loglake.session import arrow_rows

LOW = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = words_of((text or "").translate(LOW))
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        seen = {m for g in s for m in holders[g]}
        for m in seen:
            other = sets[m][1]
            if 100 * len(s & other) >= 80 * len(s | other):
                parent[root(n)] = root(m)
        for g in s:
            holders[g].append(n)
    least = defaultdict(lambda: None)
    for n, (i, s) in enumerate(sets):
        if i is not None:
            r = root(n)
            least[r] = i if least[r] is None else min(least[r], i)
    out = [(i, len(s), least[root(n)] if s else i) for n, (i, s) in enumerate(sets)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_odd_rows(spark, odd, no_docs):
    assert got(jaccard_join.groups(odd)) == brute([r[:2] for r in odd_rows()])
    assert jaccard_join.groups(no_docs).isEmpty()


def test_query(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    assert got(op4_jaccard_join(spark, small_dir)) == brute([(r.doc_id, r.text) for r in rows])


def test_large_groups_of_near_copies_around_the_limit(spark):
    """Copies of texts that are not there themselves; pairs lie on both sides of the limit."""
    rows = []
    for edits in (2, 5):
        draw = np.random.default_rng(edits)
        for i in range(150):
            w = [f"b{edits}x{k}" for k in range(100)]
            for k in draw.integers(0, 100, draw.integers(0, edits + 1)):
                w[k] = f"e{edits}x{i}x{k}"
            rows.append((i + 200 * edits, " ".join(w)))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(2000 + i, passage + " " + " ".join(f"own{i}w{k}" for k in range(9 + i % 9))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(jaccard_join.groups(docs)) == brute(rows)


def test_components_of_chains_stars_and_self_links(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {200: 200}
    assert {r.node: r.component for r in rows} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).isEmpty()


def test_repeats_are_counted_across_batches_and_tasks_get_few_rows(spark):
    """Every text once in each of two batches of distinct sets: what they share is a repeat of neither batch alone."""
    rows = [(i, " ".join(f"s{i % 30}w{k}" for k in range(6)) + f" own{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with arrow_rows(spark, 30):
        counted = jaccard_join._count_sets(docs).select("repeats").collect()
    assert spark.conf.get(name) == before
    # two shingles of each of the 30 passages, held by two sets
    assert sorted(r.n for row in counted for r in row.repeats) == [2] * 60


def test_rounds_end_where_nothing_is_open(spark, monkeypatch):
    """Pairs of near copies are tied to their region's pivot: no region holds several components after that."""
    texts = [" ".join(f"t{i}w{k}" for k in range(60)) for i in range(20)]
    rows = [(2 * i + more, text + more * " more") for i, text in enumerate(texts) for more in (0, 1)]
    docs, names, real = spark.createDataFrame(rows, "doc_id bigint, text string"), [], jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name: names.append(name) or real(df, name))
    assert got(jaccard_join.groups(docs)) == brute(rows)
    assert names.count("members") == names.count("measured") == 1
