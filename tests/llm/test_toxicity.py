import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from conftest_llm import odd_rows
from loglake.llm import toxicity
from loglake.llm.queries.op2_toxicity import op2_toxicity, scores
from loglake.llm.words import slices

BAD = ["vilest", "vilely", "vileness", "rotten"]


def corpus(n=600, seed=3):
    """Every fifth text has a sentence with bad words; some labels are wrong."""
    draw = np.random.default_rng(seed)
    texts, labels = [], []
    for i in range(n):
        said = [" ".join(f"word{k}" for k in draw.integers(0, 400, 9)) for _ in range(draw.integers(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            said[draw.integers(0, len(said))] += f" {draw.choice(BAD)} {draw.choice(BAD)}"
        texts.append(". ".join(said) + ".")
        labels.append(int(toxic) if draw.random() > 0.02 else int(not toxic))
    return texts, np.array(labels), np.arange(n) % 5 == 0


def all_scores(model, texts):
    out = []
    for piece in slices(pa.array(texts, pa.string())):
        found = toxicity.instances(piece)
        out.append(toxicity.noisy_or(model.sentences(found), found.text, piece.size))
    return np.concatenate(out)


def test_held_out_accuracy_and_offending_sentences(spark):
    texts, labels, _ = corpus()
    model = toxicity.fit(texts, labels)
    fresh, _, truth = corpus(seed=4)
    assert ((all_scores(model, fresh) >= 0.5) == truth).mean() > 0.97
    text = "A word1 word2. The vilest rotten word3! É word4."
    docs = spark.createDataFrame([(1, text), (2, "word1 word2. word3.")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [text[s.start : s.end].strip() for s in rows[1].offending] == ["The vilest rotten word3"]
    assert rows[1].score >= 0.5 > rows[2].score and rows[2].offending == []


def test_noisy_or_is_one_minus_the_product():
    logits, bag = np.array([-1.0, 0.5, 2.0]), np.array([0, 0, 2])
    p = 1 / (1 + np.exp(-logits))
    assert np.allclose(toxicity.noisy_or(logits, bag, 3), [1 - (1 - p[0]) * (1 - p[1]), 0, p[2]])


def test_held_out_labels_do_not_matter_and_test_labels_are_learned(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = {r.doc_id: r.score for r in scores(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in scores(docs, turned).collect()}
    rows = op2_toxicity(spark, folder).toPandas()
    assert len(rows) == docs.count() and rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    joined = rows.merge(labels.toPandas(), on="doc_id")
    assert (joined.predicted == joined.toxic).mean() > 0.92


def test_odd_rows_and_missing_labels(spark, odd, no_docs):
    labels = spark.createDataFrame([(None, 1), (0, None), (99, 1), (2, 1), (2, 0)], "doc_id bigint, toxic int")
    rows = scores(odd, labels).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert scores(no_docs, labels).isEmpty()
    assert scores(odd, labels.limit(0)).count() == len(odd_rows())
    assert isinstance(toxicity.fit([], np.zeros(0)), toxicity.NoisyOr) and pd.notna(toxicity.fit(["a"], np.ones(1)).bias)


def test_a_capped_sample_weighs_like_all_labels_and_holds_long_texts(spark):
    """900 clean and 100 toxic documents, a fifth of the clean ones longer than 20,000 characters, drawn 60 to 60."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(1000):
        toxic, long = i % 10 == 0, i % 5 == 1
        said = [" ".join(f"word{k}" for k in draw.integers(0, 400, 9)) for _ in range(400 if long else 6)]
        if toxic and i % 130:
            said[2] += f" {draw.choice(BAD)} {draw.choice(BAD)}"
        rows.append((i, ". ".join(said) + ".", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    got = toxicity.sample(docs, docs.select("doc_id", "toxic"), "toxic", F.lit(True), 60)
    assert got.groupby("label").weight.sum().round(6).to_dict() == {0: 900, 1: 100}
    assert got.label.value_counts().to_dict() == {0: 60, 1: 60} and (got.text.str.len() > 20_000).sum() > 5
    model = toxicity.fit(got.text.tolist(), got.label.to_numpy(), got.weight.to_numpy())
    clean = [t for _, t, toxic in rows if not toxic]
    assert (all_scores(model, clean) >= 0.5).mean() < 0.02
    few = toxicity.sample(docs, docs.select("doc_id", "toxic"), "toxic", F.lit(True), 60, 100_000)
    clean_few = few[few.label == 0]
    assert 100_000 <= clean_few.text.str.len().sum() < 150_000
    assert few.groupby("label").weight.sum().round(6).to_dict() == {0: 900, 1: 100}
