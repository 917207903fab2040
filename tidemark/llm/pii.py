"""Personal data: patterns, and a skip-chain conditional random field over the tokens that may hold some."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.samples import hash_sample
from tidemark.llm.words import utf8

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_DOCS = 4_000
ROUNDS = 10
DAMPING = 0.5
LEAST = 0.8

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits are taken whole at each step, so that long runs of them are read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_MAYBE = re.compile(r"[0-9@]")
_MAYBE_BYTES = re.compile(rb"[0-9@]")
_TRIM = "\"'`()[]{}<>.,;:!?*#$%&|=~^_/\\"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in _LOCAL_CHARS:
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield "email", low, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and then place: leftmost, without overlaps inside a kind."""
    spans = list(_emails(text))
    if not _MAYBE.search(text):
        return spans
    for match in _IP.finditer(text):
        # Leading zeros go first: there may be more of them than a number is read with.
        parts = [part.lstrip("0") or "0" for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
            spans.append(("phone", *match.span()))
    return spans


@dataclass
class Tokens:
    """The tokens of a text that hold a digit or an at sign, trimmed, with links between them."""

    start: list[int]
    end: list[int]
    form: list[str]
    features: list[list[str]]
    #: Neighbours in the text, and the nearest earlier token of the same form or, failing that, shape.
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _shape(form: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "0", form))


def _describe(form: str, before: str, after: str) -> list[str]:
    digits = re.sub(r"[^0-9]", "", form)
    groups = re.sub(r"[0-9]+", "0", re.sub(r"[^\W\d_]+", "a", form))
    found = [
        "bias", f"shape={groups[:12]}", f"digits={min(len(digits), 20)}", f"pair={groups[:12]},{min(len(digits), 20)}",
        f"before={_shape(before)[:6]}", f"after={_shape(after)[:6]}",
    ]
    if "@" in form:
        found.append("at")
        found.append(f"domain={'.' in form.rpartition('@')[2]}")
    if form.startswith("+"):
        found.append("plus")
    if len(digits) >= 12:
        found.append(f"luhn={luhn(digits)}")
    if groups == "0.0.0.0":
        found.append(f"bytes={all(len(p) < 4 and int(p) < 256 for p in form.split('.'))}")
    return found


def tokens_of(text: str) -> Tokens:
    result = Tokens([], [], [], [], [], [])
    if not _MAYBE.search(text):
        return result
    places = list(_TOKEN.finditer(text))
    last_number, by_form, by_shape = -2, {}, {}
    for number, match in enumerate(places):
        word = match[0]
        if not _MAYBE.search(word):
            continue
        low = len(word) - len(word.lstrip(_TRIM))
        form = word.strip(_TRIM)
        if not form:
            continue
        at = len(result.form)
        result.start.append(match.start() + low)
        result.end.append(match.start() + low + len(form))
        result.form.append(form)
        before = places[number - 1][0] if number else ""
        after = places[number + 1][0] if number + 1 < len(places) else ""
        result.features.append(_describe(form, before, after))
        if number == last_number + 1:
            result.chain.append((at - 1, at))
        shape = _shape(form)
        other = by_form.get(form, by_shape.get(shape))
        if other is not None:
            result.skip.append((other, at))
        by_form[form] = by_shape[shape] = at
        last_number = number
    return result


def labels_of(tokens: Tokens, spans: list[Span]) -> list[int]:
    """The kind of the span that a token overlaps."""
    labels = [0] * len(tokens.form)
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        for i in range(np.searchsorted(tokens.end, start, "right"), len(labels)):
            if tokens.start[i] >= end:
                break
            labels[i] = LABELS.index(kind)
    return labels


@dataclass
class Field:
    """Weights of a trained field: by feature and label, and by the labels at both ends of a link."""

    weights: dict[str, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, tokens: Tokens, rounds: int = ROUNDS) -> np.ndarray:
        """Probabilities of the labels of each token, by loopy sum-product messages over all links."""
        zero = np.zeros(len(LABELS))
        local = np.array([sum((self.weights.get(f, zero) for f in found), zero) for found in tokens.features])
        links = [*tokens.chain, *tokens.skip]
        if not links:
            return _softmax(local)
        ends = np.array(links)
        factor = np.exp(np.concatenate([np.repeat(m[None], n, axis=0) for m, n in ((self.chain, len(tokens.chain)), (self.skip, len(tokens.skip)))]))
        # Every link carries a message in either direction.
        source = np.concatenate([ends[:, 0], ends[:, 1]])
        target = np.concatenate([ends[:, 1], ends[:, 0]])
        factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(ends)) + len(ends), np.arange(len(ends))])
        messages = np.zeros((len(source), len(LABELS)))
        for _ in range(rounds):
            belief = local.copy()
            np.add.at(belief, target, messages)
            sent = _softmax(belief[source] - messages[back])
            new = np.log(np.einsum("ni,nij->nj", sent, factor))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if change < 1e-3:
                break
        belief = local.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief)


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def train_field(texts: Iterable[str], steps: int = 150, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """Piecewise training on the labels that the patterns give: token weights by a linear model, link weights by counts."""
    found = [(tokens, labels_of(tokens, base_spans(text))) for text in texts if (tokens := tokens_of(text)).form]
    names = sorted({f for tokens, _ in found for features in tokens.features for f in features})
    place = {name: i for i, name in enumerate(names)}
    rows, columns, target = [], [], []
    for tokens, labels in found:
        for features, label in zip(tokens.features, labels):
            rows += [len(target)] * len(features)
            columns += [place[f] for f in features]
            target.append(label)
    weights = np.zeros((len(names), len(LABELS)))
    if target:
        rows, columns = np.array(rows), np.array(columns)
        truth = np.eye(len(LABELS))[target]
        speed = np.zeros_like(weights)
        for _ in range(steps):
            logits = np.zeros((len(target), len(LABELS)))
            np.add.at(logits, rows, weights[columns])
            slope = np.zeros_like(weights)
            np.add.at(slope, columns, (_softmax(logits) - truth)[rows])
            slope = slope / len(target) + decay * weights
            speed += slope**2
            weights -= rate * slope / (np.sqrt(speed) + 1e-8)
    return Field(dict(zip(names, weights)), *(_agreement(found, which) for which in ("chain", "skip")))


def _agreement(found: list[tuple[Tokens, list[int]]], which: str) -> np.ndarray:
    """log P(both labels) / (P(one) P(other)) at linked tokens, smoothed, and the same in both directions."""
    counts = np.ones((len(LABELS), len(LABELS)))
    for tokens, labels in found:
        for i, j in getattr(tokens, which):
            counts[labels[i], labels[j]] += 1
    counts = counts + counts.T
    shares = counts / counts.sum()
    single = shares.sum(axis=1)
    return np.log(shares / np.outer(single, single))


def extra_spans(text: str, field: Field, base: list[Span], least: float = LEAST) -> list[Span]:
    """Spans that the field adds: tokens it labels with at least this probability, off the patterns' own spans."""
    tokens = tokens_of(text)
    if not tokens.form:
        return []
    taken = labels_of(tokens, base)
    chances = field.marginals(tokens)
    best = chances.argmax(axis=1)
    chosen = [int(k) if k and chances[i, k] >= least and not taken[i] else 0 for i, k in enumerate(best)]
    near = set(tokens.chain)
    spans: list[list] = []
    for i, kind in enumerate(chosen):
        if kind and spans and i and chosen[i - 1] == kind and (i - 1, i) in near:
            spans[-1][2] = tokens.end[i]
        elif kind:
            spans.append([LABELS[kind], tokens.start[i], tokens.end[i]])
    return [tuple(span) for span in spans]


def _ordered(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def find_personal_data(
    docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the personal data in its whole text.

    Patterns give the base: e-mail addresses, IP addresses, card numbers that pass Luhn's check and international phone
    numbers. A skip-chain conditional random field adds what stands in the same role: it labels the tokens that hold a
    digit or an at sign, with links between neighbours and skip links to the nearest earlier token of the same form, or
    of the same shape, so that labels agree over the whole document. It is trained on the labels that the patterns give
    to about ``train_docs`` texts with such tokens, picked by their hash; marginals come from loopy message passing.
    Each token has one skip link back at most, so the work follows the text's length, however often a token repeats.

    Null texts count as empty. Ids, null ones too, are handed through and repeated rows are repeated. Other columns are
    not read. Offsets are code points.

    Columns: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (all, as kind:start:end).
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = hash_sample(texts.where(F.col("text").rlike("[0-9@]")), ["doc_id", "text"], train_docs)
    field = train_field(row["text"] for row in sample.select("text").toLocalIterator())
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            counts, prints, spans = [], [], []
            for value in batch["_text"]:
                data = value.as_py()
                # Most texts have neither digits nor at signs.
                if not _MAYBE_BYTES.search(data):
                    counts.append((0, 0, 0, 0))
                    prints.append(empty)
                    spans.append("")
                    continue
                text = data.decode()
                base = base_spans(text)
                counts.append(tuple(sum(kind == k for k, _, _ in base) for kind in KINDS))
                prints.append(hashlib.sha256(_ordered(base).encode()).hexdigest())
                spans.append(_ordered(base + extra_spans(text, field, base, least)))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            columns = [batch["doc_id"], *columns, pa.array(prints, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
    rows = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return rows.mapInArrow(run, shape)
