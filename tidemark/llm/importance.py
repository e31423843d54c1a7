"""Quality selection by importance resampling.

Two generative models of hashed word unigrams and bigrams, one of the target text and one of all text, give
each document the log of its importance weight; adding Gumbel noise and taking the k largest sums draws k
documents without replacement in proportion to the weights. The noise is a function of the document, so a
lost executor or a second run draws the same sample. The k-th largest key is found by radix selection:
histograms of at most 65,536 counts, whatever the number of rows, and no global sort.

Defined results: null and empty texts have weight 0 (log) and take part in the draw; without target rows all
weights are 0 and the draw is uniform; equal keys are ordered by the stored row number, so exactly k rows are
selected; rows that repeat are drawn one by one; a document labelled several times is a target if any label
says so; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .texts import Words, byte_chunks, ngrams

BUCKETS = 1 << 14
SMOOTHING = 1.0
SHARE = 0.5
SEED = 17


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each unigram and bigram."""
    words = Words(data, offsets)
    pairs = ngrams(words.hashes, 2)
    same = words.rows[1:] == words.rows[:-1] if len(pairs) else np.zeros(0, dtype=bool)
    rows = np.concatenate((words.rows, words.rows[:-1][same] if len(pairs) else words.rows[:0]))
    hashes = np.concatenate((words.hashes, pairs[same]))
    return rows, (hashes % np.uint64(BUCKETS)).astype(np.int64)


def _count_batches(batches):
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, data, offsets in byte_chunks(batch.column(0)):
            total += np.bincount(_features(data, offsets)[1], minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(used.astype(np.int32)), "n": pa.array(total[used])})


def _counts(texts: DataFrame) -> np.ndarray:
    counts = texts.select("text").mapInArrow(_count_batches, "bucket int, n bigint")
    table = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS)
    total[table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    return total


def fit(docs: DataFrame, targets: DataFrame) -> np.ndarray:
    """log(target / raw) of each bucket; ``targets`` holds the doc_id of the target documents."""
    ids = targets.select("doc_id").where("doc_id IS NOT NULL").distinct()
    # one plan at every size: the labels outgrow a broadcast, and a hash join leaves the texts unsorted
    target = docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    raw, wanted = _counts(docs), _counts(target)
    if not wanted.any():
        return np.zeros(BUCKETS)
    # the target is smoothed towards all text, so that a bucket it never saw counts by its share there
    raw = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    wanted = (wanted + SMOOTHING * BUCKETS * raw) / (wanted.sum() + SMOOTHING * BUCKETS)
    return np.log(wanted) - np.log(raw)


def _score(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    found = np.zeros(len(column))
    for low, data, offsets in byte_chunks(column):
        rows, buckets = _features(data, offsets)
        found[low : low + len(offsets) - 1] = np.bincount(rows, weights=ratio[buckets], minlength=len(offsets) - 1)
    return found


def _radix_cut(keyed: DataFrame, columns: list[str], k: int) -> list[int]:
    """The k-th largest row's values of ``columns`` (non-negative longs, compared in order)."""
    cut, rest, left = [], keyed, k
    for column in columns:
        value = 0
        for shift in (48, 32, 16, 0):
            digit = F.shiftrightunsigned(F.col(column), shift).bitwiseAND(0xFFFF)
            counts = sorted(((r[0], r[1]) for r in rest.groupBy(digit.alias("d")).count().collect()), reverse=True)
            for found, n in counts:
                if n >= left:
                    break
                left -= n
            value |= found << shift
            rest = rest.where(digit == found)
        cut.append(value)
    return cut


TOP = -(1 << 63)


@F.arrow_udf(T.LongType())
def _order_bits(column: pa.Array) -> pa.Array:
    """The 64 bits of each double, changed so that as unsigned numbers they are in the order of the doubles."""
    bits = (column.to_numpy(zero_copy_only=False) + 0.0).view("<i8")
    return pa.array(np.where(bits < 0, ~bits, bits ^ np.int64(TOP)), pa.int64())


def resample(docs: DataFrame, targets: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """Every document with its log weight, its key and whether it is among the round(share x rows) selected."""
    spark = docs.sparkSession
    ratio = spark.sparkContext.broadcast(fit(docs, targets))

    @F.arrow_udf("double")
    def log_weight(column: pa.Array) -> pa.Array:
        return pa.array(_score(column, ratio.value))

    # 52 bits of a hash, so that the uniform number is neither 0 nor 1
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")), 12) + 0.5) / float(1 << 52)
    scored = docs.select("doc_id", log_weight("text").alias("log_weight"), uniform.alias("u"))
    key = F.col("log_weight") - F.log(-F.log("u"))
    kept = materialize(scored.select("doc_id", "log_weight", key.alias("gumbel_key"), F.monotonically_increasing_id().alias("row")))
    k = int(round(share * kept.count()))
    if k <= 0:
        return kept.select("doc_id", "log_weight", "gumbel_key", F.lit(False).alias("selected"))
    rows = kept.withColumn("o", _order_bits("gumbel_key")).withColumn("r", F.lit((1 << 62)) - F.col("row"))
    first, second = _radix_cut(rows.select("o", "r"), ["o", "r"], k)
    # the cut is an unsigned number; with the top bit turned over, signed numbers compare alike
    value, least = F.col("o").bitwiseXOR(F.lit(TOP)), first ^ (1 << 63)
    least -= (least >> 63) << 64
    chosen = (value > least) | ((value == least) & (F.col("r") >= second))
    return rows.select("doc_id", "log_weight", "gumbel_key", chosen.alias("selected"))
