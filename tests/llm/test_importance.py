"""Importance resampling against plain Python."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from loglake.llm import importance as imp

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, shortest, longest):
    w = WORD.findall((text or "").translate(FOLD))
    return w, [" ".join(w[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=10, shortest=1, longest=1, buckets=10_000, least_words=20, seed=2024):
    bucket = lambda g: crc32(g.encode()) % buckets
    rows = [(i, *grams(t, shortest, longest)) for i, t in docs]
    s = Counter(bucket(g) for _, _, gs in rows for g in gs)
    t = Counter(bucket(g) for x in target for g in grams(x, shortest, longest)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * big_t**0 * big_s / ((s[b] + 1) * big_t)))
    out = []
    for i, w, gs in rows:
        weight = sum(gain(bucket(g)) for g in gs) // max(len(gs), 1)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(gs), weight, score, len(w) >= least_words])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_crc_of_any_range_from_two_prefixes():
    words = [b"a", b"bc", "été".encode(), b"x" * 70_001, b"0", b"zz9"] * 3
    known = imp.Prefixes([b" ".join(words), None, b"", b"  A-b  C "])
    assert known.counts.tolist() == [18, 0, 0, 3]
    for n in (1, 2, 5):
        crcs, owner = known.ngrams(n)
        runs = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        tail = [b"a", b"b", b"c"]
        runs += [b" ".join(tail[i : i + n]) for i in range(len(tail) - n + 1)]
        assert crcs.tolist() == [crc32(r) for r in runs]
        assert owner.tolist() == [0] * (len(words) - n + 1) + [3] * max(0, 4 - n)


def test_shift_appends_zero_bytes():
    values = np.array([0, 1, 0xFFFFFFFF, 0x12345678], np.uint32)
    for length in (0, 1, 3, 8, 1000, 65537):
        # crc(zeros) from a register: both complements cancel
        want = [crc32(b"\0" * length, v ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for v in values.tolist()]
        assert imp.shift(values, np.full(4, length)).tolist() == want


@pytest.mark.parametrize("options", [{}, {"shortest": 1, "longest": 3, "buckets": 100_000, "percent": 40, "least_words": 3}, {"longest": 2, "buckets": 7, "percent": 100}])
def test_equals_plain_python(spark, small_dir, odd, options):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    wanted = [r.text for r in target.collect()]
    for table in (docs, odd):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        assert rows_of(imp.resample(table, target, **options)) == brute(rows, wanted, **options)


def test_empty_tables(spark, odd, no_docs):
    assert imp.resample(no_docs, odd).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(imp.resample(odd, no_docs, percent=50)) == brute(rows, [], percent=50)


def test_ties_go_to_the_smaller_id(spark, odd):
    # one text, and a seed that hashes few ids: equal rows share id and score
    docs = spark.createDataFrame([(k % 7, "one two three " * 9) for k in range(70)], "doc_id bigint, text string")
    got = imp.resample(docs, docs, percent=50).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 36))
    assert rows_of(imp.resample(docs, docs, percent=50)) == brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in docs.collect()], percent=50)
