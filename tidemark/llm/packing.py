"""Best-two-fit packing of documents into training sequences.

A document's ids end with an end id (the text ``<|endoftext|>`` is one id, 50256, as for ``tokenizers``); only documents longer than a sequence are cut, into full pieces after a
first one that may be shorter. Only lengths matter to the packing, and there are at most ``capacity`` of
them, so the plan is made for the whole table from its length histogram: a bin is filled greedily (longest
piece that fits), then its smallest piece gives way to two unpacked ones that fit the widened gap more
tightly, and the finished bin is repeated as often as its lengths last. Pieces are then numbered within their
length, in parallel, and meet their place by that number. What the driver holds and broadcasts, the plan, is
bounded by the number of lengths, not of documents.

Defined results: null and empty texts are one piece of one id; repeated rows are packed one by one; ties
between pieces of one length go by (doc_id, start, checksum); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .texts import string_chunks
from .tokens import encode_special, encoding, vocabulary_path

CAPACITY = 1024
END = 2
RANK_BUCKETS = 1024


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32), with their ids if ``keep_ids``."""
    vocabulary = vocabulary or vocabulary_path()

    def cut(batches):
        encoder = encoding(vocabulary)
        for batch in batches:
            for low, texts in string_chunks(batch.column(1)):
                rows, pieces, starts, lengths, checks, kept = [], [], [], [], [], []
                for row, text in enumerate(texts, low):
                    ids = np.array(encode_special(encoder, text) + [end], dtype="<u4")
                    first = (len(ids) - 1) % capacity + 1
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (start, stop) in enumerate(zip(edges, edges[1:])):
                        rows.append(row)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(stop - start)
                        checks.append(zlib.crc32(ids[start:stop].tobytes()))
                        if keep_ids:
                            kept.append(ids[start:stop].astype(np.int32))
                columns = {
                    "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                    "piece": pa.array(pieces, pa.int32()),
                    "start": pa.array(starts, pa.int64()),
                    "length": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(checks, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, schema)


def _closest_pair(available: list[int], room: int, more_than: int) -> tuple[int, int] | None:
    """The two available pieces whose sum is the largest in (more_than, room]; ``available`` counts by length."""
    best, high = None, min(room, len(available) - 1)
    lengths = [x for x in range(1, high + 1) if available[x] > 0]
    low, top = 0, len(lengths) - 1
    while low <= top:
        total = lengths[low] + lengths[top]
        if total > room or (low == top and available[lengths[low]] < 2):
            top -= 1
            continue
        if total > more_than:
            best, more_than = (lengths[top], lengths[low]), total
        low += 1
    return best


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (times, [(length, pieces)]), longest first in a bin, which use up the histogram exactly."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] += n
    bins = []
    longest = capacity
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            return bins
        content, gap, length = {}, capacity, longest
        while gap and length:
            length = min(length, gap)
            while length and not left[length]:
                length -= 1
            if length:
                taken = min(left[length], gap // length)
                content[length] = taken
                left[length] -= taken
                gap -= taken * length
        if gap and content:
            smallest = min(content)
            pair = _closest_pair(left, gap + smallest, smallest)
            if pair:
                content[smallest] -= 1
                left[smallest] += 1
                for length in pair:
                    content[length] = content.get(length, 0) + 1
                    left[length] -= 1
        content = {length: n for length, n in content.items() if n}
        more = min(left[length] // n for length, n in content.items())
        for length, n in content.items():
            left[length] -= more * n
        bins.append((more + 1, sorted(content.items(), reverse=True)))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence_id and offset. ``pieces`` is read several times: store it first."""
    spark = pieces.sparkSession
    histogram = {row[0]: row[1] for row in pieces.groupBy("length").count().collect()}
    runs, first, used = [], 0, dict.fromkeys(histogram, 0)
    for times, content in plan_bins(histogram, capacity):
        offset = 0
        for length, n in content:
            runs.append((length, used[length], used[length] + times * n, n, first, offset))
            used[length] += times * n
            offset += length * n
        first += times
    runs = spark.createDataFrame(runs, "length bigint, low bigint, high bigint, per_bin bigint, first bigint, shift bigint")
    # number the pieces of a length: in each of many buckets, from the bucket's first number on
    width = max(RANK_BUCKETS, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(width)))
    sizes = dealt.groupBy("length", "bucket").count()
    upto = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("begin"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    numbered = (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(begins, ["length", "bucket"])
        .withColumn("rank", F.col("begin") + F.col("place"))
    )
    placed = numbered.alias("p").join(
        F.broadcast(runs).alias("r"),
        (F.col("p.length") == F.col("r.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    index = F.col("rank") - F.col("low")
    return placed.select(
        *[f"p.{c}" for c in pieces.columns],
        (F.col("first") + F.floor(index / F.col("per_bin"))).alias("sequence_id"),
        (F.col("shift") + (index % F.col("per_bin")) * F.col("p.length")).alias("offset"),
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """Digest of the packing: every piece, its checksum and its place."""
    return place(materialize(token_pieces(docs, capacity, end, vocabulary)), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids)."""
    placed = place(materialize(token_pieces(docs, capacity, end, vocabulary, keep_ids=True)), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"))
