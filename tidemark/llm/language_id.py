"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams (1 to 3 letters or word gaps, lower-cased) of every labelled row in one scan; each
task sends one row per (language, bucket), so what is gathered is bounded by languages x buckets. The
log-probability matrix is broadcast and texts are scored in numpy, whole, in bounded chunks.

Defined results: a null text or one without a letter gets ``und`` and 0; without any training row every text
does; equal scores go to the language that sorts first; copies and repeated rows are scored alike; other
columns are ignored. More than ``MAX_LANGUAGES`` labels raise, as the matrix would outgrow its bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .texts import string_chunks

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
MAX_LANGUAGES = 256
UNKNOWN = "und"
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prob: np.ndarray  # (BUCKETS + 1, languages); the last row is for windows that cross texts
    log_prior: np.ndarray


@lru_cache(maxsize=None)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each followed by 0; runs of non-letters are one blank."""
    joined = "\0".join(text.lower().replace("\0", " ") for text in texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    gap = ~_letters()[points]
    points = np.where(gap & (points != 0), np.uint32(32), points)
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~((points[1:] == 32) & (points[:-1] == 32))
    points = points[keep]
    return points, np.flatnonzero(points == 0)


def _buckets(points: np.ndarray, order: int) -> np.ndarray:
    count = len(points) - order + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int64)
    mixed = np.full(count, order * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
    crossing = np.zeros(count, dtype=bool)
    for place in range(order):
        part = points[place : place + count]
        mixed = (mixed ^ part) * _MULTIPLIERS[place]
        mixed ^= mixed >> np.uint32(15)
        crossing |= part == 0
    found = (mixed >> np.uint32(17)).astype(np.int64)
    found[crossing] = BUCKETS
    return found


def _count_batches(batches):
    """(language, bucket, n) of a partition; bucket -1 counts its rows."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = np.array(batch.column(1).to_pylist(), dtype=object)
        for low, texts in string_chunks(batch.column(0)):
            points, ends = _symbols(texts)
            row = np.searchsorted(ends, np.arange(len(points)))
            names, index = np.unique(labels[low : low + len(texts)].astype(str), return_inverse=True)
            sums = np.zeros((len(names), BUCKETS + 1), dtype=np.int64)
            for order in ORDERS:
                found = _buckets(points, order)
                flat = index[row[: len(found)]] * (BUCKETS + 1) + found
                sums += np.bincount(flat, minlength=sums.size).reshape(sums.shape)
            sums[:, BUCKETS] = np.bincount(index, minlength=len(names))
            for name, counts in zip(names, sums):
                totals[name] = totals[name] + counts if name in totals else counts
    for name, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "language": pa.array([name] * len(used), pa.string()),
                "bucket": pa.array(np.where(used == BUCKETS, -1, used).astype(np.int32)),
                "n": pa.array(counts[used]),
            }
        )


def fit(labelled: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Learn from every row with a text and a language."""
    rows = labelled.select(F.col(text).alias("text"), F.col(language).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(_count_batches, "language string, bucket int, n bigint")
    totals = materialize(counts.groupBy("language", "bucket").agg(F.sum("n").alias("n")))
    number = totals.where("bucket = -1").count()
    if number > MAX_LANGUAGES:
        raise ValueError(f"{number} languages: more than {MAX_LANGUAGES}, the bound of the broadcast matrix")
    if not number:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0, np.float32))
    table = totals.toArrow()
    names, index = np.unique(np.array(table.column("language").to_pylist(), dtype=str), return_inverse=True)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    grams = np.full((BUCKETS, len(names)), SMOOTHING)
    docs = np.zeros(len(names))
    seen = bucket >= 0
    np.add.at(grams, (bucket[seen], index[seen]), n[seen])
    docs[index[~seen]] = n[~seen]
    log_prob = np.zeros((BUCKETS + 1, len(names)), dtype=np.float32)
    log_prob[:BUCKETS] = np.log(grams / grams.sum(axis=0))
    return Model([str(x) for x in names], log_prob, np.log(docs / docs.sum()).astype(np.float32))


def score_texts(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best language, its posterior) of each text."""
    best, top = np.zeros(len(column), dtype=np.int64), np.zeros(len(column))
    for low, texts in string_chunks(column):
        points, ends = _symbols(texts)
        begins = np.concatenate(([0], ends[:-1] + 1))
        total = np.tile(model.log_prior.astype(np.float64), (len(texts), 1))
        for order in ORDERS:
            found = np.full(len(points), BUCKETS)
            part = _buckets(points, order)
            found[: len(part)] = part
            total += np.add.reduceat(model.log_prob[found], begins, axis=0, dtype=np.float64)
        total -= total.max(axis=1, keepdims=True)
        share = np.exp(total)
        share /= share.sum(axis=1, keepdims=True)
        best[low : low + len(texts)] = share.argmax(axis=1)
        top[low : low + len(texts)] = share.max(axis=1)
    return best, top


def predict(text: Column, model: Model, spark) -> Column:
    """Struct (lang_pred, score) of a text column."""
    if not model.languages:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    names = pa.array(model.languages, pa.string())

    @F.arrow_udf("lang_pred string, score double")
    def scored(column: pa.Array) -> pa.Array:
        best, top = score_texts(column, shared.value)
        return pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(top)], ["lang_pred", "score"])

    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(text.isNull() | ~text.rlike(r"\p{L}"), unknown).otherwise(scored(text))


def identify(docs: DataFrame) -> DataFrame:
    """Languages of all documents, learned from those that are not held out (three in four, by crc32 of doc_id)."""
    rows = docs.select(
        "doc_id", "text", "lang", F.expr("coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, false)").alias("held_out")
    )
    model = fit(rows.where("NOT held_out"))
    found = rows.select("doc_id", "held_out", predict(F.col("text"), model, docs.sparkSession).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")
