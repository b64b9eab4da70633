from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest_llm import odd_rows, sha, words_of
from loglake.llm import substring_dedup as dedup
from loglake.llm.queries.op10_substring_dedup import op10_substring_dedup

LAST = (1 << 63) - 1


def brute(rows, window=dedup.WINDOW):
    """Rows of an id see only words at a smaller (id, start)."""
    first = {}
    key = lambda i: LAST if i is None else i
    for i, text in rows:
        w = words_of(text)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, (key(i), s)), (key(i), s))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (key(i), s):
                gone[s : s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), sha(kept)))
    return sorted(out, key=lambda r: (r[0] is None, r))


def got(df):
    rows = [(r.doc_id, r.n_words, r.n_removed, sha(r.kept)) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_odd_rows(spark, odd, no_docs):
    assert got(dedup.remove(odd, dedup.factors(odd))) == brute([r[:2] for r in odd_rows()])
    assert dedup.remove(no_docs, dedup.factors(no_docs)).isEmpty()


def test_query(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    rows = sorted(tuple(r) for r in op10_substring_dedup(spark, small_dir).collect())
    assert rows == brute([(r.doc_id, r.text) for r in docs])


WORDS = st.lists(st.sampled_from(["a", "b", "c"]), min_size=0, max_size=70)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(WORDS, min_size=1, max_size=6))
def test_few_words_repeat_in_every_way(spark, texts):
    rows = [(i, " ".join(w * 2)) for i, w in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(dedup.remove(docs, dedup.factors(docs))) == brute(rows)
