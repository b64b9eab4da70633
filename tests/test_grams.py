"""N-grams: how the messages are dealt out to tasks."""

from collections import Counter

from loglake.operators import text


def test_long_input_is_counted_in_small_tasks(spark, monkeypatch):
    """All rows come in one split; tasks hold a bounded share of the text."""
    rows = [(f"alpha{'x' * (i % 5)} beta gamma delta",) for i in range(400)]
    df = spark.createDataFrame(rows, "message string").coalesce(1)
    monkeypatch.setattr(text, "BYTES_A_TASK", 400)
    sizes = [n for n in text.dealt(df).rdd.glom().map(len).collect()]
    assert len(sizes) >= 20 and max(sizes) <= 40
    want = Counter()
    for (line,) in rows:
        words = line.split()
        want.update(" ".join(words[i : i + 3]) for i in range(len(words) - 2))
    got = {r.gram: r["count"] for r in text.gram_counts(df, (3,)).collect()}
    assert got == want
