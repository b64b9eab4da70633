"""Phrases against plain Python, and the filter that counts them."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from loglake.llm import phrases as ph

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, longest=4, most=2000, part_percent=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    often = {k: v for k, v in f.items() if v >= least}
    around = Counter()
    for (lang, w), a in often.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                around[lang, w[i : i + size]] = max(around[lang, w[i : i + size]], a)
    out = []
    for (lang, w), a in often.items():
        if len(w) > 1 and not ((lang, w) in around and 100 * around[lang, w] >= part_percent * a):
            score, _, l, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    ranked, place = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        place[lang] += 1
        if place[lang] <= most:
            ranked.append((lang, place[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(ranked)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def invented(seed, texts=60):
    """Texts over few words, with fixed phrases, punctuation, blanks of all kinds and other alphabets."""
    draw = random.Random(seed)
    words = ["a", "B", "ça", "日本", "x\x00y", "d-e", "f'g", "\xa0", "🙂"] + [f"w{i}" for i in range(30)]
    fixed = ["New York City", "in order to", "as well as the", "日本 ça a", "one two three four five"]
    rows = []
    for _ in range(texts):
        parts = []
        for _ in range(draw.randrange(0, 120)):
            parts.append(draw.choice(fixed) if draw.random() < 0.3 else draw.choice(words))
            parts.append(draw.choice([" "] * 12 + ["  ", "\t", ", ", ".", "\n", "\x0b", ";", "! ? "]))
        rows.append((draw.choice(["en", "de", None, "und", ""]), "".join(parts)))
    return rows + [("en", None), (None, ""), ("fr", " .,\n"), ("fr", "only once here"), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.fixture(scope="module")
def texts(spark):
    rows = invented(1)
    return rows, spark.createDataFrame(rows, "lang string, text string").repartition(5)


def test_equals_plain_python(texts):
    rows, docs = texts
    assert rows_of(ph.phrases(docs)) == brute(rows) != []


@pytest.mark.parametrize("options", [{"least": 2, "longest": 5}, {"least": 5, "longest": 2}, {"least": 3, "most": 7}, {"least": 4, "part_percent": 101}])
def test_other_parameters(texts, options):
    rows, docs = texts
    assert rows_of(ph.phrases(docs, **options)) == brute(rows, **options) != []


def test_bounds_of_memory_change_nothing(spark, texts, monkeypatch):
    """Several dictionary parts, filters handed on early, many ranges, a full bitmap."""
    rows, docs = texts
    for name, value in {"DICTIONARY": 7, "COUNTED": 20, "GATHERED": 50, "KEPT": 90, "RANGE": 16, "BITS": 1 << 15}.items():
        monkeypatch.setattr(ph, name, value)
    assert rows_of(ph.phrases(docs, least=3)) == brute(rows, least=3) != []


def test_odd_rows(odd):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert rows_of(ph.phrases(odd, least=2)) == brute(rows, least=2) != []


def test_no_rows(spark, no_docs):
    assert ph.phrases(no_docs).count() == 0
    assert ph.phrases(spark.createDataFrame([("en", None), (None, "a b")], "lang string, text string")).count() == 0


@pytest.mark.parametrize("length, bits", [(2, 1), (2, 5), (3, 9), (4, 15), (4, 32), (3, 32), (5, 21)])
def test_filter_is_lossless(length, bits):
    rng = np.random.default_rng(length * bits)
    layout = ph.Layout(length, bits)
    top = min(1 << bits, 1 << 31)
    grams = [rng.integers(max(0, top - 40), top, 5000) for _ in range(length)]
    for ranges in (0, min(3, layout.upper)):
        parts = [ph.Filter.of(layout, *layout.permute(*layout.pack([g[k::3] for g in grams]))) for k in range(3)]
        packed = [(n, p.pack(ranges)) for part in parts for n, p in part.ranges(ranges)]
        assert len({n for n, _ in packed}) <= 1 << ranges
        whole = ph.Filter.merged([ph.Filter.unpack(layout, ranges, n, *p) for n, p in packed])
        assert np.all((whole.upper[1:] > whole.upper[:-1]) | ((whole.upper[1:] == whole.upper[:-1]) & (whole.lower[1:] > whole.lower[:-1])))
        back = zip(*(g.tolist() for g in layout.unpack(*layout.restore(whole.upper, whole.lower))))
        assert dict(zip(back, whole.count.tolist())) == Counter(zip(*(g.tolist() for g in grams)))


def test_counts_beyond_one_byte():
    layout = ph.Layout(2, 4)
    one = ph.Filter.of(layout, np.array([3, 3, 13], np.uint64), np.array([1, 1, 9], np.uint64), np.array([1 << 40, 5, 255]))
    ((number, part),) = one.ranges(0)
    back = ph.Filter.unpack(layout, 0, number, *part.pack(0))
    assert back.upper.tolist() == [3, 13] and back.count.tolist() == [(1 << 40) + 5, 255]


def test_products_beyond_64_bits(spark, monkeypatch):
    """a, l and r near 2**62: the score's product and the share of a part stay exact."""
    big = 1 << 62
    found = spark.createDataFrame([([1], big), ([2], big - 7), ([1, 2], big - 9), ([1, 2, 1], big // 5 * 4), ([2, 1], big // 5 * 4 + 1)], "words array<bigint>, a bigint")
    words = spark.createDataFrame([(1, "en", "x", 0, big), (2, "en", "y", 0, big)], "id bigint, lang string, word string, key bigint, n bigint")
    totals = spark.createDataFrame([("en", big)], "lang string, n bigint")
    monkeypatch.setattr(ph, "ngrams", lambda *a: (found, words, totals))
    got = {r.phrase: r for r in ph.phrases(None).collect()}
    # x y is a part of x y x, whose count is just under 80 % of its own
    assert set(got) == {"x y x"} | ({"x y"} if 100 * (big // 5 * 4) < 80 * (big - 9) else set())
    for phrase, r in got.items():
        assert r.score == 2_000_000 * r.a // (r.l + r.r)
