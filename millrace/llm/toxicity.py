"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document is labelled. Each
sentence gets a probability from a linear model of its words; the document's is
their noisy-or, ``1 - (1 - leak) * prod(1 - p)``, so one bad sentence is enough and
the model learns from document labels which sentences those are.

The model is fitted on ``max_documents`` labelled documents at most, a
documented bound: the ones with the smallest hash of their id. Their ids are
broadcast, so that the corpus is scanned without moving a text. Features are
words and their first letters, chosen by how much their document frequency
differs between the labels. The sample's feature numbers are written once and stay
in their table: a round sends the weights out and adds up a gradient per
partition, so the driver holds weights, however long the documents are.
Scoring is a pass over all documents in Arrow batches.

A NULL or empty text has no sentence and scores the leak, near 0. Labels that
are NULL are ignored, ids that repeat are learned from once; with labels of a single kind, or none, or an empty table, every score is the leak.
Equal texts score equally. Labels, ids and other columns never enter a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, fresh

SENTENCE_END = r"[.!?\n]+"
LETTERS = r"\p{L}+"
STEM = 4
MAX_FEATURES = 4096
MAX_DOCUMENTS = 20_000
MIN_DOCUMENTS = 3
ROUNDS = 100
RATE = 0.25
PENALTY = 2e-4
CACHED_WORDS = 1 << 16  # weights that a scoring task remembers

_sentence_end = re.compile(SENTENCE_END)
_letters = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Weights of words and of first letters (under ``stem*``), a bias and the leak."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    leak: float = 1e-3

    def sentences(self, text: str | None) -> list[str]:
        return [s for s in _sentence_end.split(text or "") if s.strip()]

    def sentence_scores(self, text: str | None, cache: dict[str, float]) -> np.ndarray:
        """Probabilities of the text's sentences, in order."""
        totals = []
        for sentence in self.sentences((text or "").lower()):
            value = self.bias
            for word in _letters.findall(sentence):
                weight = cache.get(word)
                if weight is None:
                    weight = self.weights.get(word, 0.0) + self.weights.get(word[:STEM] + "*", 0.0)
                    if len(cache) < CACHED_WORDS:
                        cache[word] = weight
                value += weight
            totals.append(value)
        return 1 / (1 + np.exp(-np.clip(np.array(totals, dtype=float), -50, 50)))

    def score(self, sentence_scores: np.ndarray) -> float:
        """Noisy-or of the sentences."""
        return float(1 - (1 - self.leak) * np.exp(np.log1p(-np.minimum(sentence_scores, 1 - 1e-12)).sum()))


def feature_lists(text):
    """Distinct words of a text, each as itself and as its first letters."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LETTERS), F.lit(0)))
    stems = F.array_distinct(F.transform(words, lambda word: F.concat(F.substring(word, 1, STEM), F.lit("*"))))
    return F.concat(words, stems)


def choose_features(labelled: DataFrame, n: int = MAX_FEATURES, min_documents: int = MIN_DOCUMENTS) -> list[str]:
    """The ``n`` features whose share of documents differs most between the labels."""
    sizes = labelled.agg(F.count_if(F.col("label") == 1).alias("bad"), F.count_if(F.col("label") == 0).alias("good")).first()
    if not sizes["bad"] or not sizes["good"]:
        return []
    counts = (
        labelled.select("label", F.explode(feature_lists(F.col("text"))).alias("feature"))
        .groupBy("feature")
        .agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
        .where(F.col("n") >= min_documents)
    )
    bad, good = F.col("bad") / sizes["bad"], (F.col("n") - F.col("bad")) / sizes["good"]
    share = F.col("n") / (sizes["bad"] + sizes["good"])
    statistic = (bad - good) * (bad - good) / (share * (1 - share) + 1e-9)
    return [row["feature"] for row in counts.orderBy(statistic.desc(), "feature").select("feature").limit(n).collect()]


def _bags(labelled: DataFrame, features: list[str]) -> DataFrame:
    """Label and chosen features of each document, sentence by sentence; -1 ends a sentence."""
    numbers = {name: i for i, name in enumerate(features)}

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model()
        for batch in batches:
            bags = []
            for text in batch.column("text").to_pylist():
                bag: list[int] = []
                for sentence in model.sentences((text or "").lower()):
                    for word in _letters.findall(sentence):
                        bag += [numbers[f] for f in (word, word[:STEM] + "*") if f in numbers]
                    bag.append(-1)
                bags.append(np.array(bag, dtype=np.int16))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(bags, pa.list_(pa.int16()))], names=["label", "bag"])

    return labelled.select("text", "label").mapInArrow(listed, "label int, bag array<smallint>")


@dataclass
class Point:
    """Where the fit stands: weights, bias, and the leak's log-odds; ``balance`` are the label weights, ``n`` the documents."""

    weights: np.ndarray
    bias: float
    leak: float
    balance: tuple[float, float]
    n: int


def slope(at: Point, labels: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The gradient of the noisy-or likelihood over some documents; a sentence's share is its responsibility.

    ``flat`` are the documents' features one after the other, -1 at the end of each sentence; ``ends`` is where each document ends.
    """
    breaks = flat < 0
    closing, used = np.flatnonzero(breaks), flat[~breaks]
    sentence_of = (np.cumsum(breaks, dtype=np.int32) - breaks)[~breaks]
    doc_of = np.searchsorted(ends, closing, side="right")
    z = np.bincount(sentence_of, at.weights[used], len(closing)) + at.bias
    p = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-12, 1 - 1e-12)
    p_leak = 1 / (1 + np.exp(-at.leak))
    log_good = np.bincount(doc_of, np.log1p(-p), len(labels)) + np.log1p(-p_leak)
    bad = np.clip(-np.expm1(log_good), 1e-9, 1)
    # d(-log likelihood)/dz of a sentence: p for a good document, -p * (1 - bad) / bad for a bad one.
    outer = np.where(labels == 1, -at.balance[1] * (1 - bad) / bad, at.balance[0]) / at.n
    by_sentence = p * outer[doc_of]
    return np.concatenate([np.bincount(used, by_sentence[sentence_of], len(at.weights)), [by_sentence.sum(), p_leak * outer.sum()]])


def _gradient(bags: DataFrame, at: Point) -> np.ndarray:
    """One pass over the bags: partitions sum theirs, and the driver adds a row per partition, in their order."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(at.weights) + 2)
        for batch in batches:
            bag = batch.column("bag")
            total += slope(at, batch.column("label").to_numpy(), bag.flatten().to_numpy(), np.cumsum(bag.value_lengths().to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["gradient"])

    rows = bags.mapInArrow(summed, "gradient binary").collect()
    return np.sum([np.frombuffer(row["gradient"]) for row in rows], axis=0)


def _optimise(bags: DataFrame, n_features: int) -> tuple[np.ndarray, float, float] | None:
    """Adam over passes of the bags, which stay in their table: the driver holds the weights. None with labels of a single kind."""
    sentences = F.size(F.filter("bag", lambda f: f < 0))
    n, n_bad, n_sentences = bags.agg(F.count("*"), F.sum("label"), F.sum(sentences)).first()
    if not n_bad or n_bad == n:
        return None
    share = n_bad / n
    balance = ((0.5 / (1 - share)) ** 0.5, (0.5 / share) ** 0.5)
    at = Point(np.zeros(n_features), np.log(share / (1 - share)) - np.log(max(1.0, n_sentences / n)), -6.0, balance, n)
    moment = [np.zeros(n_features + 2), np.zeros(n_features + 2)]
    for step in range(1, ROUNDS + 1):
        gradient = _gradient(bags, at)
        gradient[:-2] += PENALTY * at.weights / 10
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.99 * moment[1] + 0.01 * gradient**2
        move = RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        at = Point(at.weights - move[:-2], at.bias - move[-2], at.leak - move[-1], balance, n)
    return at.weights, float(at.bias), float(1 / (1 + np.exp(-at.leak)))


def train(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS, max_features: int = MAX_FEATURES) -> Model:
    """Fit on documents (``id``, ``text``) by their labels (``id``, ``label``, 0 or 1). Runs jobs."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where("label IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_documents)
    found = docs.select("id", "text").join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    labelled = scratch.write("sample", found)
    features = choose_features(labelled, max_features)
    if not features:
        return Model()
    fitted = _optimise(scratch.write("bags", _bags(labelled, features)), len(features))
    if fitted is None:
        return Model()
    weights, bias, leak = fitted
    return Model({name: float(w) for name, w in zip(features, weights) if abs(w) > 1e-3}, bias, leak)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``score``, ``predicted`` (score >= 0.5), and the place and number of offending sentences.

    Columns of these names in the input are replaced. ``worst_sentence`` counts
    from 0 over non-blank sentences and is NULL without any.
    """
    added = "score double, predicted int, worst_sentence int, n_offending int"

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, float] = {}
        for batch in texts:
            rows = []
            for value in batch:
                each = model.sentence_scores(value, cache)
                result = model.score(each)
                worst = int(each.argmax()) if len(each) else None
                rows.append((result, int(result >= 0.5), worst, int((each >= 0.5).sum())))
            yield pd.DataFrame(rows, columns=["score", "predicted", "worst_sentence", "n_offending"]).astype({"worst_sentence": "Int32"})

    judged = F.pandas_udf(scored, added)  # type: ignore[call-overload]
    held = docs.drop("score", "predicted", "worst_sentence", "n_offending")
    (name,) = fresh(held, "_judged")
    return held.withColumn(name, judged(F.col(text))).select(*held.columns, f"{name}.*")


def offending_sentences(docs: DataFrame, model: Model, key: str, text: str = "text", least: float = 0.5) -> DataFrame:
    """``key``, place, text and probability of every sentence at or above ``least``."""
    schema = "place int, sentence string, probability double"

    def located(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for batch in texts:
            yield pd.Series([
                [
                    {"place": i, "sentence": s, "probability": float(p)}
                    for i, (s, p) in enumerate(zip(model.sentences(value), model.sentence_scores(value, cache)))
                    if p >= least
                ]
                for value in batch
            ])

    found = F.pandas_udf(located, f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")  # type: ignore[call-overload]
    return docs.select(F.col(key), F.inline(found(F.col(text))))
