import numpy as np
import pandas as pd
import pytest

from conftest_llm import odd_rows, words_of
from loglake.llm import mixing
from loglake.llm.queries.op1_mixing import op1_mixing


def brute_targets(sizes):
    """Targets by source, with the excess of full sources shared again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2.0 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > 2.0 * sizes[s]}
        if not over:
            return target
        full |= over


def highest_quotients(votes, seats):
    won = {p: 0 for p in votes}
    for _ in range(seats):
        best = min(votes, key=lambda p: (-votes[p] / (2 * won[p] + 1), p))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 40, 333])
def test_apportionment_is_that_of_the_highest_quotients(spark, seats):
    draw = np.random.default_rng(seats)
    votes = {f"p{i:02}": float(v) for i, v in enumerate(draw.integers(0, 60, 23))} | {"zz": 900.0, "zy": 900.0}
    rows = spark.createDataFrame([(0, p, v, seats) for p, v in votes.items()], "g int, p string, v double, s bigint")
    got = {r.p: r.won for r in mixing.apportion(rows, "g", "v", "s", "p", "won").collect()}
    want = highest_quotients(votes, seats)
    assert sum(got.values()) == seats
    assert got == want


def check(rows, docs):
    frame = pd.DataFrame([tuple(r) for r in rows], columns=["doc_id", "size", "source_size", "target", "taken"])
    assert len(frame) == len(docs)
    assert (frame.taken <= 2 * frame["size"]).all() and (frame.taken >= 0).all()
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    target = brute_targets(sizes)
    known = {d[0]: d for d in docs}
    frame["source"] = [known[None if pd.isna(i) else int(i)][2] for i in frame.doc_id]
    for source, part in frame.groupby("source", dropna=False):
        source = None if pd.isna(source) else source
        assert part.source_size.eq(sizes[source]).all()
        assert part.target.iloc[0] == pytest.approx(target[source])
        assert abs(part.taken.sum() - target[source]) <= max(0.02 * target[source], 2 * mixing.BLOCK_WORDS)


def test_odd_rows(spark, odd, no_docs):
    rows = mixing.mix(odd).select("doc_id", "size", "source_size", "target", "taken").collect()
    check(rows, [(r[0], r[1], r[3]) for r in odd_rows()])
    assert mixing.mix(no_docs).isEmpty() and mixing.mix(no_docs, with_text=True).isEmpty()


def test_query_agrees_on_rerun_and_in_any_partitioning(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    first = sorted(map(tuple, op1_mixing(spark, small_dir).select(*columns).collect()))
    check(first, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    again = sorted(map(tuple, mixing.mix(docs.repartition(7)).select(*columns).collect()))
    assert first == again


def test_text_has_the_words_that_are_counted(spark, odd):
    counted = {}
    for r in mixing.mix(odd).collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + r.taken
    whole = {r[0]: words_of(r[1]) for r in odd_rows()}
    taken = {}
    for r in mixing.mix(odd, with_text=True).collect():
        own = words_of(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(own)
        assert set(own) <= set(whole[r.doc_id]) and r.n_chars == len(r.text)
    total = sum(counted.values())
    assert abs(sum(taken.values()) - total) <= 0.02 * total


def test_texts_are_not_stored(spark, odd, monkeypatch):
    stored, real = [], mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, name: stored.append((name, df.columns)) or real(df, name))
    assert mixing.mix(odd, with_text=True).count()
    assert "sized" in dict(stored) and not [name for name, columns in stored if "text" in columns]
