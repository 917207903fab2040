"""Toxicity by classifier chains: one linear model per category, each fed with the probabilities of those before it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.decontamination import without
from tidemark.llm.samples import hash_sample
from tidemark.llm.words import plain_words, utf8
from tidemark.session import settle

TRAIN_ROWS = 8_000
FOLDS = 3
#: Least share of labelled texts among those that are taken to be in the category to decide by, on out-of-fold predictions.
PRECISION = 0.95
#: The features kept: so many at most, of those that so many texts of the sample hold.
VOCABULARY = 20_000
MIN_DOCS = 5
_STEPS, _RATE, _LASSO, _RIDGE = 120, 0.5, 0.35, 1e-4
_SCREENED = 500
_DOCS = 200
_PREFIXES = range(4, 9)

#: Categories of a table of labels with quality and toxic, 0 or 1 each.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def features(text: bytes, prefixes: Iterable[int] = _PREFIXES) -> set[bytes]:
    """The words of a text and, marked by a star, the beginnings of its longer words."""
    words = set(plain_words(text))
    return words.union(*({word[:size] + b"*" for word in words if len(word) > size} for size in prefixes))


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, so that the words of few texts are held at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, _DOCS):
            yield batch.slice(low, _DOCS)


@dataclass
class Rows:
    """Bags of words as the places of each row's words in a vocabulary, one row after the other."""

    words: np.ndarray
    lengths: np.ndarray

    def sums(self, weights: np.ndarray) -> np.ndarray:
        number = np.repeat(np.arange(len(self.lengths)), self.lengths)
        return np.bincount(number, weights[self.words], len(self.lengths))

    def take(self, chosen: np.ndarray) -> Rows:
        return Rows(self.words[np.repeat(chosen, self.lengths)], self.lengths[chosen])


@dataclass
class Linear:
    """A logistic model of the words that a text holds and of the probabilities of earlier categories."""

    bias: float
    words: np.ndarray
    earlier: np.ndarray

    def chances(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(self.bias + rows.sums(self.words) + earlier @ self.earlier)


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def fit(rows: Rows, earlier: np.ndarray, labels: np.ndarray, vocabulary: int) -> Linear:
    """Least logistic loss in two rounds: a lasso on words, then the words that it kept without it.

    Only the words that differ most between the classes enter. The lasso is as strong as chance makes a word that tells
    nothing look, for so many words and rows. Steps shrink for each weight by what it has been moved before. Labels of one
    class give that class for sure.
    """
    count = len(labels)
    if not count or labels.min() == labels.max():
        sure = 40.0 if count and labels[0] else -40.0
        return Linear(sure, np.zeros(vocabulary), np.zeros(earlier.shape[1]))
    share = labels.mean()
    # How far the share of rows with a feature differs between the classes, in standard deviations.
    with_one = np.bincount(rows.words, np.repeat(labels, rows.lengths), vocabulary)
    held = np.bincount(rows.words, minlength=vocabulary)
    spread = np.sqrt(np.maximum(held * (1 - held / count) * share * (1 - share), 1e-9))
    tell = np.argsort(-np.abs(with_one - held * share) / spread, kind="stable")[:_SCREENED]
    place = np.full(vocabulary, -1)
    place[tell] = np.arange(len(tell))
    inside = place[rows.words] >= 0
    owner = np.repeat(np.arange(count), rows.lengths)[inside]
    small = Rows(place[rows.words][inside], np.bincount(owner, minlength=count))

    lasso = _LASSO * np.sqrt(share * (1 - share) * np.log(max(vocabulary, 2)) / count)
    bias, words, before = float(np.log(share / (1 - share))), np.zeros(len(tell)), np.zeros(earlier.shape[1])
    kept = np.ones(len(tell), bool)
    for penalty, ridge in ((lasso, 0.0), (0.0, _RIDGE)):
        moved, moved_words, moved_before = 1e-8, np.full(len(tell), 1e-8), np.full(earlier.shape[1], 1e-8)
        for _ in range(_STEPS):
            wrong = (_sigmoid(bias + small.sums(words) + earlier @ before) - labels) / count
            slope = (np.bincount(small.words, np.repeat(wrong, small.lengths), len(tell)) + ridge * words) * kept
            moved_words += slope**2
            rate = _RATE / np.sqrt(moved_words)
            words = words - rate * slope
            words = np.sign(words) * np.maximum(np.abs(words) - rate * penalty, 0)
            slope = earlier.T @ wrong
            moved_before += slope**2
            before = before - _RATE * slope / np.sqrt(moved_before)
            moved += wrong.sum() ** 2
            bias -= _RATE * wrong.sum() / np.sqrt(moved)
        kept = words != 0
    weights = np.zeros(vocabulary)
    weights[tell] = words
    return Linear(bias, weights, before)


@dataclass
class Chain:
    """A trained chain, with the words that have a weight in any of its models and what they weigh in each."""

    categories: list[str]
    weights: dict[bytes, tuple[float, ...]]
    models: list[tuple[float, list[float]]]
    threshold: float
    prefixes: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.prefixes = sorted({len(feature) - 1 for feature in self.weights if feature.endswith(b"*")})

    def chances(self, text: bytes) -> list[float]:
        """The probability of each category."""
        known = [self.weights[found] for found in self.weights.keys() & features(text, self.prefixes)]
        sums = [sum(column) for column in zip(*known)] or [0.0] * len(self.models)
        result: list[float] = []
        for (bias, earlier), total in zip(self.models, sums):
            result.append(float(_sigmoid(bias + total + sum(w * p for w, p in zip(earlier, result)))))
        return result


def best_threshold(chances: np.ndarray, labels: np.ndarray, precision: float = PRECISION) -> float:
    """The probability from which on predictions are best by the harmonic mean of precision and recall.

    Only thresholds with the given ``precision`` count, if there are any: documents are deleted by them.
    """
    if not labels.any():
        return 1.1
    order = np.argsort(-chances, kind="stable")
    ranked, hits = chances[order], np.cumsum(labels[order])
    taken = np.arange(1, len(labels) + 1)
    value = 2 * hits / (taken + hits[-1])
    value[:-1][ranked[1:] == ranked[:-1]] = -1  # equal chances are not parted
    sure = (hits >= precision * taken) & (value > 0)
    if sure.any():
        value[~sure] = -1
    at = int(value.argmax())
    return float((ranked[at] + (ranked[at + 1] if at + 1 < len(ranked) else 0)) / 2)


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    train_rows: int = TRAIN_ROWS,
    folds: int = FOLDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """Fit one model per category, in their order; the last category is the one to decide by.

    About ``train_rows`` of the labelled ids, picked by their hash, are the sample, whatever the size of the corpus.
    Features are the words that occur in a text and the first four to eight bytes of longer ones, which stand for stems
    with many endings, out of the most frequent ones that at least five texts of the sample hold; and the probabilities
    of the earlier categories. While training, these come from models that have not seen the row (``folds`` folds), as
    they will when scoring. The threshold is the one with which out-of-fold predictions of the last category agree best
    with its labels, of those with a precision of ``PRECISION`` or more.

    ``categories`` names conditions in SQL over the columns of ``labels``. Labels of an id that occurs repeatedly count
    once, by the largest value; rows with a null id, or with null in a category, are no labels. Categories with labels
    of one class are never, or always, taken to hold, and without labels never.
    """
    names = list(categories)
    marks = [F.max(F.expr(value).cast("int")).alias(f"_c{i}") for i, value in enumerate(categories.values())]
    known = settle(labels.groupBy(F.col(id_col).alias("_id")).agg(*marks).dropna())
    # At most twice train_rows labels are broadcast.
    sample = F.broadcast(hash_sample(known, ["_id"], train_rows))
    texts = docs.select(F.col(id_col).alias("_id"), utf8(text_col).alias("_text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words = [sorted(features(text.as_py())) for text in batch["_text"]]
            columns = [batch["_id"], *(batch[f"_c{i}"] for i in range(len(names))), pa.array(words, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", *(f"_c{i}" for i in range(len(names))), "_words"])

    rows = texts.join(sample, "_id")
    kind = rows.schema["_id"].dataType.simpleString()
    shape = f"_id {kind}, " + ", ".join(f"_c{i} int" for i in range(len(names))) + ", _words array<binary>"
    rows = settle(rows.mapInArrow(split, shape).dropDuplicates(["_id"]))
    counted = rows.select(F.explode("_words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    vocabulary = [bytes(r["word"]) for r in counted.where(F.col("n") >= MIN_DOCS).orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()]
    place = {word: i for i, word in enumerate(vocabulary)}

    columns = rows.columns

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = [[place[word] for word in words if word in place] for words in batch["_words"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.int32()))], columns)

    # The words of at most twice train_rows texts that are in the vocabulary.
    table = rows.mapInArrow(index, shape.replace("array<binary>", "array<int>")).orderBy("_id").toArrow()
    lists = table["_words"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    bags = Rows(lists.flatten().to_numpy().astype(np.int64), lengths)
    fold = np.arange(len(lists)) % folds
    earlier = np.zeros((len(lists), 0))
    models = []
    for i in range(len(names)):
        truth = np.array(table[f"_c{i}"].to_pylist(), float)
        unseen = np.zeros(len(lists))
        for part in range(folds):
            rest, own = fold != part, fold == part
            model = fit(bags.take(rest), earlier[rest], truth[rest], len(vocabulary))
            unseen[own] = model.chances(bags.take(own), earlier[own])
        models.append(fit(bags, earlier, truth, len(vocabulary)))
        earlier = np.column_stack([earlier, unseen])
    weights = np.array([model.words for model in models])
    used = np.flatnonzero(weights.any(axis=0))
    return Chain(
        names,
        {vocabulary[i]: tuple(weights[:, i].tolist()) for i in used},
        [(model.bias, model.earlier.tolist()) for model in models],
        best_threshold(earlier[:, -1], truth) if len(lists) else 1.1,
    )


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: the probability of each category and whether the last one is taken to hold.

    Trains a chain (see `train_chain`) and scores the whole texts with it, without a shuffle. Null texts count as
    empty; ids, null ones too, are handed through; repeated rows are scored each. Other columns are not read.

    Columns: doc_id, ``p_`` and the name of each category, a boolean with the name of the last one, and version (a hash
    of the text, which tells rows with the same id apart).
    """
    chain = train_chain(docs, labels, categories, train_rows, id_col=id_col, text_col=text_col)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = ["doc_id", *(f"p_{name}" for name in chain.categories), chain.categories[-1], "version"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in batches:
            chances = np.array([chain.chances(text.as_py()) for text in batch["_text"]]).reshape(-1, len(chain.categories))
            columns = [pa.array(column) for column in chances.T]
            columns = [batch["doc_id"], *columns, pa.array(chances[:, -1] >= chain.threshold), batch["version"]]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"),
        utf8(text_col).alias("_text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = ", ".join([f"doc_id {kind}", *(f"{name} double" for name in names[1:-2]), f"{names[-2]} boolean", "version long"])
    return rows.mapInArrow(run, shape)


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all columns, for which the last category is not taken to hold."""
    scored = toxicity(docs, labels, categories, train_rows, id_col, text_col)
    return without(docs, scored.where(f"`{list(categories)[-1]}`"), id_col, text_col)
