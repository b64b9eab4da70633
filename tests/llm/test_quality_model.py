import zlib

import numpy as np
import pyarrow as pa

from conftest_llm import odd_rows
from loglake.llm import quality_model as model
from loglake.llm.queries.op5_quality_model import op5_quality_model
from loglake.llm.words import slices


def test_gradient_is_that_of_the_loss():
    """The attention gradient by finite differences, through one step of the fit's own formulas."""
    draw = np.random.default_rng(0)
    text = np.array([0, 0, 0, 1, 2, 2])
    x = draw.normal(size=(6, model.FEATURES))
    shapes = {"E": (model.FEATURES, 3), "e": (3,), "V": (3, 2), "U": (3, 2), "w": (2,), "c": (3,), "d": ()}
    net = model.GatedAttention(np.zeros(model.FEATURES), np.ones(model.FEATURES), {k: draw.normal(0, 0.5, s) for k, s in shapes.items()})
    layers = net.forward(x, text)
    assert np.allclose(np.add.reduceat(layers["a"], layers["first"]), 1)
    one = net.forward(x[3:4], np.array([0]))
    assert np.isclose(one["logit"][0], layers["logit"][1]) and one["a"][0] == 1


def test_passages_cover_all_words():
    texts = ["", "a " * 130, "b", "   ", "c. " * 64]
    found = [model.passages(p) for p in slices(pa.array(texts))]
    assert np.bincount(np.concatenate([f.text for f in found])).tolist() == [1, 3, 1, 1, 1]
    assert np.isfinite(np.concatenate([f.features for f in found])).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = op5_quality_model(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    assert rows.score.between(0, 1).all() and len(rows) == 1000


def test_odd_rows(spark, odd, no_docs):
    net = model.fit(["good words here and there " * 20, "%%% $$$ " * 90], np.array([1, 0]))
    rows = model.score(odd, net).collect()
    assert len(rows) == len(odd_rows())
    empty = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1 and all(0 <= r.score <= 1 and abs(sum(r.attention) - 1) < 1e-9 for r in rows)
    assert model.score(no_docs, net).isEmpty()
    assert model.score(odd, model.fit([], np.zeros(0))).where("score <> 0.5").isEmpty()
