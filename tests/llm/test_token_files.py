"""Token files: ids of the library, places, and what indexes and filters leave unread."""

import glob
from zlib import crc32

import numpy as np
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

from loglake.llm import token_files as tf
from loglake.llm.queries.op12_token_files import op12_token_files
from loglake.llm.queries.op7_bpe import tokenizer_path


def plain(rows):
    """doc_id, start, n_tokens and CRC by the library, a text at a time."""
    library, start, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, tf.END_ID]
        out.append((key, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def stored(spark, path):
    rows = tf.placed(spark, tf.with_crc(tf.read(spark, path)), path)
    return sorted((tuple(r) for r in rows.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_query_equals_the_library(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(map(tuple, op12_token_files(spark, small_dir).collect()))
    assert got == plain([(r.doc_id, r.text) for r in docs])


def test_odd_rows(spark, odd, tmp_path):
    tf.write(odd, str(tmp_path / "t"), tokenizer_path())
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert stored(spark, str(tmp_path / "t")) == plain(rows)


def test_texts_whose_blanks_are_no_blanks(spark, tmp_path):
    texts = ["ab,. cd'', ef's, gh_i! 'tis ÀÉ), ÿ_ ß. x² y½. ªº, ab,. don't, l'eau? Ünï+cöde##",
             "a\x1cb c", "x <|endoftext|> y", "<|startoftext|>don't STOP", "ΣΣ  é  it's\x85ok", "café Å", "�‍\U0001f469‍\U0001f4bb 12a3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    tf.write(docs, str(tmp_path / "t"), tokenizer_path())
    assert stored(spark, str(tmp_path / "t")) == plain(list(enumerate(texts)))


def test_forgetting_changes_nothing(spark, monkeypatch):
    texts = [f"word{i % 50} other{i}" for i in range(200)]
    one = tf.Encoder(tokenizer_path())
    monkeypatch.setattr(tf, "REMEMBERED", 10)
    two = tf.Encoder(tokenizer_path())
    assert one.encode(texts) == [x for t in texts for x in two.encode([t])]


def test_no_rows(spark, no_docs, tmp_path):
    tf.write(no_docs, str(tmp_path / "t"), tokenizer_path())
    found = spark.read.schema("doc_id bigint, shard int, before bigint, n_tokens bigint, token_ids array<int>").orc(str(tmp_path / "t"))
    assert found.count() == 0


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """60,000 documents with even ids in four shards of many stripes."""
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    docs = spark.range(60_000).selectExpr("id * 2 as doc_id", "repeat(concat('w', id % 97, ' x', id % 89, ' '), 40) as text")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tf.write(docs, path, tokenizer_path(), stripe_bytes=1 << 17)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    return path


def _scanned(spark, rows):
    """Rows that the scan hands on, and the result's rows."""
    result = rows._jdf.queryExecution()
    n = len(rows.collect())
    stack, seen = [result.executedPlan()], 0
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
        if name.startswith("Scan orc"):
            seen = node.metrics().apply("numOutputRows").value()
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return seen, n


def test_files_have_several_stripes_and_shards(spark, many):
    files = glob.glob(f"{many}/*.orc")
    assert len(files) == 8 and all(orc.ORCFile(f).nstripes > 1 for f in files)
    assert all(orc.ORCFile(f).row_index_stride == tf.STRIDE for f in files)
    ids = spark.read.orc(many).select("doc_id", "shard").orderBy("doc_id").collect()
    assert [r.shard for r in ids] == sorted(r.shard for r in ids)


def test_indexes_leave_row_groups_unread(spark, many):
    seen, n = _scanned(spark, tf.read(spark, many, low=20_000, high=20_100))
    assert n == 51 and seen <= 3 * tf.STRIDE
    # odd ids lie inside the indexes' ranges; only the Bloom filters rule them out
    seen, n = _scanned(spark, tf.read(spark, many, ids=[20_001]))
    assert n == 0 and seen == 0
    seen, n = _scanned(spark, tf.read(spark, many, ids=[20_000, 90_002]))
    assert n == 2 and seen <= 4 * tf.STRIDE
    assert {f.name for f in tf.read(spark, many).select("doc_id").schema} == {"doc_id"}
