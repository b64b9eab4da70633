from collections import Counter

import oracle
from conftest_llm import odd_rows, words_of
from loglake.llm import quality_rules as rules
from loglake.llm.queries import op3_quality_rules as op3


def brute(text):
    text = text or ""
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_of_odd_rows(spark, odd, no_docs):
    got = rules.measure(odd).collect()
    text = {r[0]: r[1] for r in odd_rows()}
    assert len(got) == len(odd_rows())
    for r in got:
        assert tuple(r[c] for c in rules.COUNTS) == brute(text[r.doc_id])
    judged = rules.judge(odd).collect()
    assert len(judged) == len(odd_rows())
    assert all(r.base_failed and not r.kept for r in judged if r.n_words < 50)
    assert rules.judge(no_docs).isEmpty()


def test_same_rows_as_sql(spark, small_dir):
    con = oracle.connect(small_dir)
    assert oracle.difference(spark, small_dir, op3.op3_quality_rules, op3.SQL, con) is None


def test_junk_goes_and_clean_text_stays(spark):
    clean = [(i, " ".join(f"word{(i * 31 + k * 7) % 911}" for k in range(120)), "en", "a") for i in range(80)]
    junk = [(1000 + i, " ".join(f"word{(i * 31 + k * 7) % 911}%%%" for k in range(120)), "en", "a") for i in range(5)]
    docs = spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id for r in rules.judge(docs).where("kept").collect()}
    assert kept == {i for i, *_ in clean}
