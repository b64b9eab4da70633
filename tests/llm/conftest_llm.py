import hashlib
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, "
    "`key` int, shard int, n_words string, component string, _text string, spans int"
)
SENTENCE = "the quick brown fox jumps over one lazy dog while seven small birds sing a song about rain and sun today"


def words_of(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, near copies."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    other = " ".join(f"near{i}" for i in range(100))
    rows = [
        (0, SENTENCE, "en", "a"),
        (1, SENTENCE, "en", "a"),
        (1, SENTENCE, "en", "a"),
        (2, SENTENCE.upper() + " énd\u000b.", "en", "b"),
        (3, None, None, None),
        (4, "", "en", ""),
        (5, " \n\t ", "de", "b"),
        (6, long, "en", "a"),
        (7, other, "fr", None),
        (8, other.replace("near3 ", "far3 "), "fr", "c"),
        (9, "one two", "fr", "c"),
        (10, "One two", "fr", "c"),
        (11, SENTENCE + "\n" + SENTENCE + "\n" + SENTENCE, None, "a"),
        (12, "mail a.b@c.example.org or +1 (234) 555-0199, 10.0.0.1 and 4111 1111 1111 1111 \U0001f600 x@y.zz", "en", "b"),
        (13, "x" * 200_000, "en", "c"),
        (14, "line\nline\nline\n" * 40, "en", "c"),
        (None, "a text without an id " * 12, "en", "a"),
    ]
    return [(i, t, l, s, len(t) if t else None, "x", "y", 1, 2, "z", "c", "t", 3) for i, t, l, s in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
