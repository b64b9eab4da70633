import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest_llm import odd_rows, sha
from loglake.llm import bpe
from loglake.llm.queries.op7_bpe import op7_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello WORLD's it's 'LL 12345 ½²", "ΣΑΣ İx", "x<|endoftext|>y<|startoftext|><|endoftext|>",
    "é ﬁ", "\x1c\x1d a\x85b​", "日本語\U0001f642", "a" * 3000, "!?" * 500, "\x00\x01", "",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_and_text_as_the_library(library, text):
    vocab = bpe.vocabulary(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    mine = vocab.encode(text)
    assert list(memoryview(mine).cast("I")) == ids if mine else not ids
    assert vocab.decode(mine) == library.decode(ids, skip_special_tokens=False)


def _expected(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    return doc_id, len(ids), sha(packed), sha(library.decode(ids, skip_special_tokens=False))


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


def test_odd_rows(spark, odd, no_docs, library):
    got = _sorted(bpe.digests(odd, PATH).collect())
    assert got == _sorted(_expected(library, r[0], r[1]) for r in odd_rows())
    assert bpe.digests(no_docs, PATH).isEmpty()


def test_query(spark, small_dir, library):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    assert _sorted(op7_bpe(spark, small_dir).collect()) == _sorted(_expected(library, r.doc_id, r.text) for r in rows)


def test_decode_is_its_own_operator(spark, odd):
    encoded = bpe.encode(odd, PATH, decoded=True)
    again = bpe.decode(encoded.drop("decoded"), PATH)
    assert _sorted(again.collect()) == _sorted(encoded.select("doc_id", "decoded").collect())


def test_workers_forget_many_words_when_a_task_ends(spark):
    letters = "translate(hex(w), '0123456789', 'ghijklmnop')"
    text = f"array_join(transform(sequence(0, {bpe.LEFT + 5000}), w -> {letters}), ' ') AS text"
    docs = spark.range(0, 16, 1, 16).selectExpr("id AS doc_id", text)
    assert bpe.encode(docs, PATH).where("length(token_ids) > 0").count() == 16

    def held(batches):
        for batch in batches:
            yield batch.from_pydict({"n": [len(bpe.vocabulary(PATH).known)]})

    left = [r.n for r in spark.range(0, 16, 1, 16).mapInArrow(held, "n bigint").collect()]
    assert max(left) <= bpe.LEFT
