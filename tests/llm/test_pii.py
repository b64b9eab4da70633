import random
import re

import pytest

from conftest_llm import odd_rows, sha
from loglake.llm import pii
from loglake.llm.queries.op8_pii import op8_pii


def brute(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_patterns_equal_the_plain_ones():
    draw = random.Random(1)
    for _ in range(20_000):
        t = "".join(draw.choice("a1@.+- (9%2\n0bé") for _ in range(draw.randint(0, 40)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("1" * 200_000 + "@") == [] and pii.base_spans("a" * 200_000 + "@" * 1000) == []


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_links_carry_a_label_to_another_form(field):
    text = "Call +1 (487) 555-7209 now. They also wrote (487) 555-7209 on the back, near page 12."
    found = pii.find([text, "page 12 of 40", ""], field)
    assert [(text[s:e], pii.KINDS[k], base) for s, k, e, base in found[0]] == [
        ("+1 (487) 555-7209", "phone", True), ("(487) 555-7209", "phone", False),
    ]
    assert found[1:] == [[], []]


def test_beliefs_on_a_chain_are_exact(field):
    import itertools

    import numpy as np

    net = pii.field_of(["1 22 333"], [[]])
    net.skip = net.skip[:0]
    draw = np.random.default_rng(2)
    model = pii.SkipChain(field.index, field.emit, draw.normal(size=(5, 5)), np.zeros((5, 5)))
    unary, weight = model.unary(net), np.zeros((3, 5))
    for y in itertools.product(range(5), repeat=3):
        p = np.exp(sum(unary[i, y[i]] for i in range(3)) + model.follow[y[0], y[1]] + model.follow[y[1], y[2]])
        for i in range(3):
            weight[i, y[i]] += p
    assert np.allclose(model.marginals(net), weight / weight.sum(axis=1, keepdims=True), atol=5e-3)


def test_query_and_odd_rows(spark, small_dir, odd, no_docs, field):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = op8_pii(spark, small_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert r.base_sha256 == sha(joined(base))
        assert set(joined(base).split(",")) <= set(r.spans.split(","))
    got = pii.detect(odd, field).collect()
    text = {r[0]: r[1] or "" for r in odd_rows()}
    assert len(got) == len(odd_rows())
    assert all([(s.start, pii.KINDS.index(s.kind), s.end) for s in r.spans if s.base] == brute(text[r.doc_id]) for r in got)
    clean = {r.doc_id: r for r in pii.redact(odd, field).collect()}
    assert clean[12].text.startswith("mail <EMAIL> or <PHONE>, <IP> and <CARD> ") and clean[12].n_chars == len(clean[12].text)
    assert clean[3].text is None and clean[0].text == text[0] and set(clean[0].asDict()) == set(odd.columns)
    assert pii.detect(no_docs, field).isEmpty() and pii.train(no_docs).index == {}


def test_values_in_unspaced_text_are_tokens_of_their_own():
    line = '{"id":12,"note":"' + "x" * 300 + '","phone":"(487)555-7209","mail":"a.b@c.example","n":[1,2]}'
    assert [line[a:b] for a, b in pii.tokens(line)] == ["12", "(487)555-7209", "a.b@c.example", "1", "2"]
    prose = "電話は0312345678です、" * 30 + "番号4875557209。"
    assert [prose[a:b] for a, b in pii.tokens(prose)] == ["0312345678"] * 30 + ["4875557209"]


def test_nothing_is_read_by_prefix(field):
    """A number far inside an unspaced run is linked, and tokens that differ behind 200 characters are not."""
    text = "Call +1 (487) 555-7209 now. " + '{"note":"' + "x" * 400 + '","phone":"4875557209"}'
    net = pii.field_of([text], [[]])
    piece = {text[a:b]: i for i, (a, b) in enumerate(net.span)}
    assert [piece["555-7209"], piece["4875557209"]] in net.skip.tolist()
    one, two = "9" * 250 + "1234567", "9" * 250 + "7654321"
    assert pii.field_of([f"{one} {two}"], [[]]).skip.tolist() == []
    assert pii.field_of([f"{one} {one}"], [[]]).skip.tolist() == [[0, 1]]
    assert pii._shape("1" * 300 + "." + "ab") == "9" * 300 + ".a"


def test_long_tokens_take_linear_time():
    import time

    start = time.process_time()
    long = "1a.@" * 500_000
    assert pii.tokens(long) == [(0, len(long))]
    pii.field_of([long], [[]])
    assert time.process_time() - start < 60
