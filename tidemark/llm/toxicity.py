"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over words and word beginnings; each model is
also fed the probabilities of the categories before it, in training the out-of-fold ones, so that it learns
from what earlier models will say about texts they have not seen. The chain is: ``insult`` (labelled toxic,
with a word of the insult list), ``veiled`` (labelled toxic, without one), ``toxic`` (labelled toxic); the
last decides.

Training uses at most ``SAMPLE_PER_CLASS`` labelled documents of each class, the first in the order of a hash
of doc_id; that bound is a parameter. Their hashed features go to the driver, which keeps the ``FEATURES``
that tell the classes apart best. All documents are scored, whole, where they are read.

Defined results: null and empty texts are not toxic; without labelled toxic (or labelled clean) documents
there is nothing to learn and all probabilities are the base rate; contradicting labels of a document count
as toxic; repeated rows are scored alike; labels without a document are ignored; other columns are passed
through by ``keep_clean``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import Words, byte_chunks, hash_words

CATEGORIES = ("insult", "veiled", "toxic")
BUCKETS = 1 << 20
PREFIXES = (4, 6, 8)
SAMPLE_PER_CLASS = 3000
FEATURES = 1024
LEAST_DOCS = 3
FOLDS = 4
PENALTY = 0.2
STEPS = 300
THRESHOLD = 0.5
HEAD = 16
INSULTS = """
idiot idiots idiotic stupid moron moronic loser losers scum trash worthless pathetic clown dumb dumbass fool
jerk creep filth garbage disgusting imbecile pig swine bastard bitch
""".split()


@dataclass
class Link:
    features: np.ndarray  # buckets, sorted
    weights: np.ndarray
    earlier: np.ndarray  # weights of the probabilities before
    bias: float


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the different words of each row and of their beginnings, each once per row."""
    letters = _word_bytes()[data]
    words = Words(data, offsets, letters)
    rows, parts = [], []
    for salt, hashes in enumerate([words.hashes, *[words.prefixes(size) for size in PREFIXES]]):
        bucket = (hashes + np.uint64(salt)) % np.uint64(BUCKETS)
        both = np.unique(words.rows.astype(np.int64) * BUCKETS + bucket.astype(np.int64))
        rows.append(both // BUCKETS)
        parts.append(both % BUCKETS)
    return np.concatenate(rows), np.concatenate(parts)


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'")] = True
    table[128:] = True
    return table


def _has_insult(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words = Words(data, offsets, _word_bytes()[data])
    found = np.zeros(len(offsets) - 1, dtype=bool)
    found[words.rows[np.isin(words.hashes, hash_words(INSULTS))]] = True
    return found


def _training_rows(batches):
    for batch in batches:
        for low, data, offsets in byte_chunks(batch.column(1)):
            rows, buckets = _features(data, offsets)
            order = np.argsort(rows, kind="stable")
            parts = np.split(buckets[order].astype(np.int32), np.cumsum(np.bincount(rows, minlength=len(offsets) - 1))[:-1])
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column(0).slice(low, len(parts)),
                    "insult": pa.array(_has_insult(data, offsets)),
                    "buckets": pa.array(parts, pa.list_(pa.int32())),
                }
            )


def _sigmoid(values):
    return 1 / (1 + np.exp(-np.clip(values, -35, 35)))


def _fit_linear(design: np.ndarray, target: np.ndarray) -> np.ndarray:
    """L2 logistic regression by accelerated gradient steps; the last column of ``design`` is ones, whose weight (the bias) is not penalised."""
    weights = np.zeros(design.shape[1], dtype=design.dtype)
    penalty = np.full(len(weights), PENALTY, dtype=design.dtype)
    penalty[-1] = 0
    # largest curvature, by power iteration
    vector = np.ones(len(weights), dtype=design.dtype)
    for _ in range(20):
        vector = design.T @ (design @ vector)
        top = float(np.linalg.norm(vector))
        vector /= top or 1.0
    step = 1 / (top / 4 + PENALTY)
    ahead = weights.copy()
    for number in range(STEPS):
        slope = design.T @ (_sigmoid(design @ ahead) - target) + penalty * ahead
        new = ahead - step * slope
        ahead = new + (number / (number + 3)) * (new - weights)
        weights = new
    return weights


def _matrix(rows: list[np.ndarray], features: np.ndarray, more: int = 0) -> np.ndarray:
    """A row of 0 and 1 for each document, with room for ``more`` columns."""
    found = np.zeros((len(rows), len(features) + more), dtype=np.float32)
    if len(features):
        for number, buckets in enumerate(rows):
            place = np.minimum(np.searchsorted(features, buckets), len(features) - 1)
            found[number, place[features[place] == buckets]] = 1
    return found


def _select(rows: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """The features with the largest chi-square against the target."""
    positive, negative = np.zeros(BUCKETS, dtype=np.int32), np.zeros(BUCKETS, dtype=np.int32)
    for buckets, is_one in zip(rows, target):
        (positive if is_one else negative)[np.unique(buckets)] += 1
    ones, zeros = max(target.sum(), 1), max((~target).sum(), 1)
    known = np.flatnonzero(positive + negative >= LEAST_DOCS)  # the others have no score
    positive, negative = positive[known].astype(np.float64), negative[known].astype(np.float64)
    mean = (positive + negative) / (ones + zeros)
    spread = mean * (1 - mean) * (1 / ones + 1 / zeros)
    score = np.where(spread > 0, (positive / ones - negative / zeros) ** 2 / np.maximum(spread, 1e-12), 0)
    best = np.argsort(-score, kind="stable")[:FEATURES]
    return np.sort(known[best[score[best] > 10.8]])  # p < 0.001


def _fit_link(rows, earlier, target) -> Link:
    features = _select(rows, target) if 0 < target.sum() < len(target) else np.zeros(0, dtype=np.int64)
    if not len(features):
        rate = (target.sum() + 0.5) / (len(target) + 1)
        return Link(features, np.zeros(0, np.float32), np.zeros(earlier.shape[1], np.float32), float(np.log(rate / (1 - rate))))
    # filled where it stands: the driver holds one such matrix at a time
    count = len(features)
    design = _matrix(rows, features, earlier.shape[1] + 1)
    design[:, count:-1] = earlier
    design[:, -1] = 1
    weights = _fit_linear(design, target.astype(np.float32))
    return Link(features, weights[:count], weights[count:-1], float(weights[-1]))


def _predict_link(link: Link, rows, earlier) -> np.ndarray:
    return _sigmoid(_matrix(rows, link.features) @ link.weights + earlier @ link.earlier + link.bias)


def fit_chain(rows: list[np.ndarray], targets: np.ndarray) -> list[Link]:
    """One link per column of ``targets``; ``rows`` holds the buckets of each document."""
    fold = np.arange(len(rows)) % FOLDS
    earlier = np.zeros((len(rows), 0), dtype=np.float32)
    chain = []
    for number in range(targets.shape[1]):
        target = targets[:, number]
        chain.append(_fit_link(rows, earlier, target))
        if number == targets.shape[1] - 1:
            break
        unseen = np.zeros(len(rows), dtype=np.float32)
        for held in range(FOLDS):
            train, test = np.flatnonzero(fold != held), np.flatnonzero(fold == held)
            if len(train) and len(test):
                link = _fit_link([rows[i] for i in train], earlier[train], target[train])
                unseen[test] = _predict_link(link, [rows[i] for i in test], earlier[test])
        earlier = np.hstack([earlier, unseen[:, None]])
    return chain


def _views(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a column of lists of numbers, where they lie in Arrow's memory."""
    rows = []
    for chunk in lists.chunks:
        values, edges = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        rows.extend(values[low:high] for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()))
    return rows


def _in_order(toxic: np.ndarray, insult: np.ndarray, rows: list[np.ndarray]) -> list[int]:
    """The places of the rows by (toxic, insult, bytes of the buckets); whole rows are copied only where their beginnings are equal."""

    def begin(i):
        return toxic[i], insult[i], rows[i][:HEAD].tobytes()

    order = []
    for _, alike in groupby(sorted(range(len(rows)), key=begin), key=begin):
        alike = list(alike)
        order.extend(sorted(alike, key=lambda i: rows[i].tobytes()) if len(alike) > 1 else alike)
    return order


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list[Link]:
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = [marks.where(marks["toxic"] == value).orderBy(order, "doc_id").limit(per_class) for value in (True, False)]
    sample = F.broadcast(chosen[0].unionAll(chosen[1]))  # at most 2 x per_class rows
    known = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).select("toxic", "text")
    table = known.mapInArrow(_training_rows, "toxic boolean, insult boolean, buckets array<int>").toArrow()
    if not table.num_rows:
        return [Link(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(n, np.float32), -35.0) for n in range(len(CATEGORIES))]
    rows = _views(table.column("buckets"))
    # the order of arrival differs between runs: sort, so that folds do not
    toxic, insult = table.column("toxic").to_numpy().astype(bool), table.column("insult").to_numpy().astype(bool)
    order = _in_order(toxic, insult, rows)
    rows, toxic, insult = [rows[i] for i in order], toxic[order], insult[order]
    return fit_chain(rows, np.column_stack([toxic & insult, toxic & ~insult, toxic]))


def score_texts(column: pa.Array, chain: list[Link]) -> np.ndarray:
    found = np.zeros((len(column), len(chain)))
    for low, data, offsets in byte_chunks(column):
        count = len(offsets) - 1
        rows, buckets = _features(data, offsets)
        for number, link in enumerate(chain):
            total = np.full(count, link.bias)
            if len(link.features):
                place = np.minimum(np.searchsorted(link.features, buckets), len(link.features) - 1)
                hit = link.features[place] == buckets
                total += np.bincount(rows[hit], weights=link.weights[place[hit]], minlength=count)
            total += found[low : low + count, :number] @ link.earlier
            found[low : low + count, number] = _sigmoid(total)
        empty = np.bincount(rows, minlength=count) == 0
        found[low : low + count][empty] = 0
    return found


def score(text: Column, chain: list[Link], spark) -> Column:
    """Struct of the probability of each category."""
    shared = spark.sparkContext.broadcast(chain)

    @F.arrow_udf(", ".join(f"{name} double" for name in CATEGORIES))
    def scored(column: pa.Array) -> pa.Array:
        found = score_texts(column, shared.value)
        return pa.StructArray.from_arrays([pa.array(found[:, i].copy()) for i in range(len(CATEGORIES))], list(CATEGORIES))

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, insult, veiled, toxic, rejected) of every document."""
    found = docs.select("doc_id", score(F.col("text"), fit(docs, labels), docs.sparkSession).alias("p"))
    return found.select("doc_id", *[f"p.{name}" for name in CATEGORIES], (F.col("p.toxic") >= THRESHOLD).alias("rejected"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the chain does not reject, with all their columns."""
    return docs.where(score(F.col("text"), fit(docs, labels), docs.sparkSession)["toxic"] < THRESHOLD)
