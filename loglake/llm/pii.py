"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and telephone numbers. The random field
labels every token that holds a digit or an at sign: neighbours are linked as a chain, and
tokens that repeat, or end in the same seven digits, are linked however far apart they
stand. Loopy message passing over these links makes repeated tokens agree, so a number
that a pattern finds once is also found where it stands in another form. It is fitted by
pseudo-likelihood on a bounded sample, with the pattern spans as labels; what it finds is
added to the pattern spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.session import released

KINDS = ("email", "ip", "card", "phone")
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number starts where its run of digits starts: a later start in the run fails or succeeds alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_HINT = re.compile(r"[0-9@]+")
_PIECE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789@._%+()-")

#: Bounds of the training sample: texts, and characters of one.
SAMPLE = 2000
SAMPLE_CHARS = 20_000
EPOCHS = 200
RATE = 0.1
DECAY = 1e-3
#: While fitting, this share of the tokens shows no features of its own, so that links have to speak for them.
BLANK = 0.3
SEED = 11
#: Where the sample has few repeats, linked tokens agree with this weight.
AGREE = 4.0
ROUNDS = 20
#: An added span needs so many digits, or an at sign.
LEAST_DIGITS = 7
CERTAIN = 0.9
#: Texts whose fields are passed messages together.
TOGETHER = 512


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches in order of start, then kind."""
    spans = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        m = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            spans.append((start, 0, m.end()))
        # what stands before a failed at sign is no part of a later address
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    spans.sort()
    return spans


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs of the characters that numbers and addresses are made of, if they hold a digit or an
    at sign. Blanks, quotes, colons, commas, brackets of other kinds and letters of other alphabets end a
    run, so values in unspaced text (JSON, CSV, prose without blanks) are tokens of their own."""
    found, floor, size = [], 0, len(text)
    for m in _HINT.finditer(text):
        if m.start() < floor:
            continue
        start, end = m.start(), m.end()
        while start > floor and text[start - 1] in _PIECE:
            start -= 1
        while end < size and text[end] in _PIECE:
            end += 1
        found.append((start, end))
        floor = end
    return found


def _shape(token: str) -> str:
    token = re.sub(r"[0-9]", "9", token)
    return re.sub(r"[^\W\d_]+", "a", token)


def _features(token: str) -> list[str]:
    digits = _NOT_DIGIT.sub("", token)
    shape = _shape(token)
    found = [
        "1",
        "s:" + shape,
        "t:" + shape.strip(".,;:!?#*$%&|<>\"'"),
        f"n:{min(len(digits), 20)}",
        f"d:{min(token.count('.'), 4)}",
        "at" if "@" in token else "no at",
        "plus" if token.startswith("+") else "no plus",
    ]
    if 14 <= len(digits) <= 19:
        found.append(f"luhn:{luhn(digits)}")
    if token.count(".") >= 3:
        parts = token.strip(".,;:!?#*$%&|<>\"'").split(".")
        found.append(f"octets:{all(p.isascii() and p.isdigit() and _small(p) for p in parts)}")
    return found


def _keys(token: str) -> list[str]:
    """What tokens that speak of the same thing share: letters and digits, or the last seven digits."""
    plain = "".join(c for c in token.lower() if c.isalnum())
    digits = _NOT_DIGIT.sub("", token)
    return [plain] + (["#" + digits[-7:]] if len(digits) >= 7 else [])


@dataclass
class Field:
    """Tokens of some texts and the links between them."""

    features: list[list[str]]
    text: np.ndarray
    span: list[tuple[int, int]]
    alone_before: np.ndarray  # the word before is no token
    alone_after: np.ndarray
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs of repeated or similar tokens
    gold: np.ndarray


def field_of(texts: list[str], bases: list[list]) -> Field:
    """Each repeated token is linked with its last occurrence, so links grow with the tokens."""
    features, owner, span, chain, skip, gold = [], [], [], [], [], []
    for t, (text, base) in enumerate(zip(texts, bases)):
        last: dict[str, int] = {}
        b, before = 0, None
        for start, end in tokens(text):
            i = len(span)
            token = text[start:end]
            features.append(_features(token))
            owner.append(t)
            span.append((start, end))
            while b < len(base) and base[b][2] <= start:
                b += 1
            gold.append(base[b][1] + 1 if b < len(base) and base[b][0] < end else 0)
            if before is not None and text[before:start].isspace() and start - before < 4:
                chain.append((i - 1, i))
            before = end
            linked = set()
            for key in _keys(token):
                if key in last and last[key] not in linked:
                    skip.append((last[key], i))
                    linked.add(last[key])
                last[key] = i
    n = len(span)
    chain_, skip_ = (np.array(x, np.int64).reshape(-1, 2) for x in (chain, skip))
    before_, after_ = np.ones(n, bool), np.ones(n, bool)
    before_[chain_[:, 1]] = False
    after_[chain_[:, 0]] = False
    return Field(features, np.array(owner, np.int64), span, before_, after_, chain_, skip_, np.array(gold, np.int64))


def _normal(x: np.ndarray) -> np.ndarray:
    return x - np.logaddexp.reduce(x, axis=1, keepdims=True)


@dataclass
class SkipChain:
    index: dict[str, int]
    emit: np.ndarray  # features x labels
    follow: np.ndarray  # labels x labels
    alike: np.ndarray  # labels x labels, symmetric

    def unary(self, field: Field) -> np.ndarray:
        rows = [(i, self.index[f]) for i, found in enumerate(field.features) for f in found if f in self.index]
        out = np.zeros((len(field.span), len(KINDS) + 1))
        if rows:
            at = np.array(rows)
            np.add.at(out, at[:, 0], self.emit[at[:, 1]])
        out[field.alone_before] += self.follow[0]
        out[field.alone_after] += self.follow[:, 0]
        return out

    def marginals(self, field: Field) -> np.ndarray:
        """Beliefs after loopy sum-product message passing with damping."""
        unary = self.unary(field)
        edges = np.concatenate((field.chain, field.skip))
        if not len(edges):
            return np.exp(_normal(unary))
        pair = np.concatenate(
            (np.repeat(self.follow[None], len(field.chain), 0), np.repeat(self.alike[None], len(field.skip), 0))
        )
        source = np.concatenate((edges[:, 0], edges[:, 1]))
        target = np.concatenate((edges[:, 1], edges[:, 0]))
        pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
        messages = np.zeros((len(source), unary.shape[1]))
        belief = unary
        for _ in range(ROUNDS):
            sent = (belief[source] - messages[back])[:, :, None] + pair
            new = _normal(np.logaddexp.reduce(sent, axis=1))
            moved = np.abs(np.exp(new) - np.exp(_normal(messages))).max()
            messages = 0.5 * messages + 0.5 * new
            belief = unary.copy()
            np.add.at(belief, target, messages)
            if moved < 1e-3:
                break
        return np.exp(_normal(belief))


def fit(texts: list[str]) -> SkipChain:
    """Pseudo-likelihood: every token's label given the labels of those it is linked with."""
    field = field_of(texts, [base_spans(t) for t in texts])
    labels, n = len(KINDS) + 1, len(field.span)
    seen: dict[str, int] = {}
    for found in field.features:
        for f in found:
            seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, c in seen.items() if c >= 2))}
    agree = AGREE * np.eye(labels)
    model = SkipChain(index, np.zeros((len(index), labels)), np.zeros((labels, labels)), agree.copy())
    if not n or not index:
        model.follow[:, 0] = 10.0
        return model
    blank = np.random.default_rng(SEED).random(n) < BLANK
    field.features = [found[:1] if b else found for b, found in zip(blank, field.features)]
    at = np.array([(i, index[f]) for i, found in enumerate(field.features) for f in found if f in index])
    truth = np.eye(labels)[field.gold]
    both = np.concatenate((field.skip, field.skip[:, ::-1]))
    parameters = [model.emit, model.follow, model.alike]
    m, v = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, EPOCHS + 1):
        logits = model.unary(field)
        np.add.at(logits, field.chain[:, 1], model.follow[field.gold[field.chain[:, 0]]])
        np.add.at(logits, field.chain[:, 0], model.follow.T[field.gold[field.chain[:, 1]]])
        np.add.at(logits, both[:, 1], model.alike[field.gold[both[:, 0]]])
        error = (np.exp(_normal(logits)) - truth) / n
        emit, follow, alike = (np.zeros_like(p) for p in parameters)
        np.add.at(emit, at[:, 1], error[at[:, 0]])
        follow[0] += error[field.alone_before].sum(0)
        follow[:, 0] += error[field.alone_after].sum(0)
        np.add.at(follow, field.gold[field.chain[:, 0]], error[field.chain[:, 1]])
        np.add.at(follow.T, field.gold[field.chain[:, 1]], error[field.chain[:, 0]])
        np.add.at(alike, field.gold[both[:, 0]], error[both[:, 1]])
        gradients = [emit, follow, (alike + alike.T) / 2]
        for k, (p, g, prior) in enumerate(zip(parameters, gradients, (0.0, 0.0, agree))):
            g = g + DECAY * (p - prior) / 10
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return model


_EDGE = re.compile(r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9)]+$")


def find(texts: list[str], model: SkipChain) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, from a pattern) of all spans of each text, in order."""
    bases = [base_spans(t) if _HINT.search(t) else [] for t in texts]
    out = [[(s, k, e, True) for s, k, e in base] for base in bases]
    field = field_of(texts, bases)
    if not field.span:
        return out
    beliefs = model.marginals(field)
    label = np.where(beliefs.max(axis=1) >= CERTAIN, beliefs.argmax(axis=1), 0)
    label[field.gold > 0] = 0
    joined = np.zeros(len(label) + 1, bool)
    joined[field.chain[:, 1]] = label[field.chain[:, 1]] == label[field.chain[:, 0]]
    added = np.flatnonzero(label)
    for i in added:
        if joined[i]:
            continue
        last = i
        while joined[last + 1] and label[last + 1] == label[i]:
            last += 1
        t = int(field.text[i])
        start, end = field.span[i][0], field.span[last][1]
        piece = texts[t][start:end]
        digits = len(_NOT_DIGIT.sub("", piece))
        lead = re.match(r"[^A-Za-z0-9+(]*", piece).end()
        piece_end = end - (len(piece) - len(re.sub(r"[^A-Za-z0-9)]+$", "", piece)))
        if (digits >= LEAST_DIGITS or "@" in piece) and start + lead < piece_end:
            out[t].append((start + lead, int(label[i]) - 1, piece_end, False))
    for t in set(field.text[added].tolist()):
        out[t].sort()
    return out


def train(docs: DataFrame) -> SkipChain:
    """Fits on up to ``SAMPLE`` texts that hold a digit or an at sign, chosen by hash."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    fit_for = texts.where((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]"))
    # about twice as many pass a threshold on the hash, so what tasks send does not grow with their number
    draw = F.xxhash64("doc_id")
    share = min(1.0, 2 * SAMPLE / max(fit_for.count(), 1))
    few = fit_for.where(F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = few.orderBy(draw, "doc_id", "text").limit(SAMPLE).select("text").collect()
    return fit([r.text for r in rows])


def detect(docs: DataFrame, model: SkipChain, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans``: kind, start, end (code points, end exclusive) and whether a
    pattern found it, in order of start, then kind.

    Null and empty texts have none. Repeated rows are searched each. Only ``keep`` and
    ``text`` are read.
    """
    slim = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(low, TOGETHER)
                texts = [t or "" for t in rows.column("_text").to_pylist()]
                spans = [
                    [{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in each]
                    for each in find(texts, model)
                ]
                columns = [*(rows.column(c) for c in keep), pa.array(spans, pa.list_(kind))]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "spans"])

    spans = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
    return slim.mapInArrow(run, ", ".join([*fields, f"spans {spans}"]))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def redact(docs: DataFrame, model: SkipChain) -> DataFrame:
    """Documents with every span replaced by its kind in angle brackets; texts without one stay.

    Spans that overlap are replaced as one, under the first one's kind. Null texts stay null.
    """
    columns = docs.columns
    rest = tuple(c for c in columns if c not in ("text", "n_chars"))
    raw = "_text"
    while raw in rest:
        raw += "_"
    slim = docs.select(*rest, F.col("text").cast("string").alias(raw))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*rest).schema.fields]

    def clean(text: str, spans: list) -> str:
        parts, at = [], 0
        for start, kind, end, _ in spans:
            if start >= at:
                parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(low, TOGETHER)
                texts = rows.column(raw).to_pylist()
                found = find([t or "" for t in texts], model)
                new = [clean(t, s) if s else t for t, s in zip(texts, found)]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in rest), pa.array(new, pa.string())], [*rest, "text"])

    cleaned = slim.mapInArrow(released(run), ", ".join([*fields, "text string"]))
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*(c for c in columns))
