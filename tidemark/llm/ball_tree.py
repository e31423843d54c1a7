"""Ranked lexical search: exact inner-product search in ball trees of sparse document vectors.

The score of a document for an item is an inner product of whole numbers: the item's term weights (by rarity over
the whole table) and the document's saturated term counts. Items are the stated query set; they are taken in blocks
of at most ``BLOCK_BYTES`` of text, so that what is broadcast (a block's terms and weights) has a fixed bound. Per
block, the documents are tokenised once and stored as sparse vectors over the block's terms. Each task then reads
its share of them in slices, builds a ball tree of each slice (centre, radius, two halves by the projection on two
far-off members), and searches it for one item after the other:

- a subtree's bound is  q . centre + |q| * radius, with q restricted to the terms that occur below it; the bound is
  widened by more than the rounding error of its own computation, so it is never below a true score;
- subtrees are opened best bound first, until the best bound left is below the score that the item's list ends with
  (a subtree with an equal bound is opened, as a smaller doc_id may win there);
- members of leaves are scored in 64-bit whole numbers, so rounding decides nothing.

An item's list goes on from slice to slice; each task returns at most k rows an item, which are ranked in the end.

Defined results: a null text has no term and is not counted; items without a term known to any document return no
rows; an empty table returns none; rows that repeat are ranked each by itself, a null doc_id behind all others with
its score; repeated items have a list each; other columns are ignored. The words of a long text are counted in pieces.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .texts import byte_chunks
from .wordids import rows_of

BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 20
SLICE_ROWS = 8192
SLICE_TERMS = 1 << 21
LEAF_ROWS = 32
NO_ID = (1 << 63) - 1

# Terms are runs of ASCII letters, digits and any other non-ASCII character; A-Z count as a-z.
_TERMS = bytes(
    ord(chr(byte).lower()) if chr(byte).isalnum() and byte < 128 else byte if byte >= 128 else 32 for byte in range(256)
)
VECTORS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term of a text."""
    plain, counts, at = text.translate(_TERMS), Counter(), 0
    while at < len(plain):
        stop = plain.find(b" ", at + PIECE_BYTES)
        stop = len(plain) if stop < 0 else stop
        counts.update(plain[at:stop].split(b" "))
        at = stop
    del counts[b""]
    return counts


def term_weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def length_factor(n: int, documents: int, occurrences: int) -> int:
    return 75 + 25 * n * documents // occurrences


def saturated(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + 12 * factors)


class Slice:
    """Sparse rows: the terms and values of row i are at ``edges[i]`` to ``edges[i + 1]``."""

    def __init__(self, terms: np.ndarray, values: np.ndarray, edges: np.ndarray):
        self.terms, self.values, self.edges = terms, values, edges

    def rows(self) -> int:
        return len(self.edges) - 1

    def take(self, rows: np.ndarray) -> Slice:
        sizes = self.edges[rows + 1] - self.edges[rows]
        edges = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(edges[-1]) + np.repeat(self.edges[rows] - edges[:-1], sizes)
        return Slice(self.terms[at], self.values[at], edges)

    def dots(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every row with a dense vector; every row has a term."""
        return np.add.reduceat(dense[self.terms] * self.values, self.edges[:-1])


class Ball:
    __slots__ = ("terms", "centre", "radius", "first", "second", "rows", "members")

    def __init__(self, part: Slice, rows: np.ndarray, width: int):
        """The centre and radius of some rows; the two halves are set by ``grow``."""
        values = part.values.astype(np.float64)
        total = np.bincount(part.terms, weights=values, minlength=width) / len(rows)
        self.terms = np.flatnonzero(total)
        self.centre = total[self.terms]
        squares = np.add.reduceat(values * values, part.edges[:-1])
        own = float(self.centre @ self.centre)
        apart = squares - 2 * part.dots(total) + own
        # each sum is off by at most its number of addends x 2^-52 of the sum of their sizes
        slack = (len(self.terms) + np.diff(part.edges).max() + 16) * 2.0**-51 * (squares + own)
        self.radius = math.sqrt(float(np.max(np.maximum(apart, 0) + slack)))
        self.first = self.second = self.members = None
        self.rows = rows

    def bound(self, weights: np.ndarray) -> float:
        """At least the score of every member; ``weights`` is the item's dense vector."""
        own = weights[self.terms]
        size = math.sqrt(float(own @ own))
        if not size:
            return 0.0
        return (float(own @ self.centre) + size * self.radius) * (1 + (len(own) + 16) * 2.0**-50) + 1.0


def grow(whole: Slice, width: int) -> Ball:
    """The ball tree of a slice: halves of equal size by the projection on the line between two far-off rows."""
    root = Ball(whole, np.arange(whole.rows()), width)
    open_ = [(root, whole)]
    while open_:
        ball, part = open_.pop()
        if part.rows() <= LEAF_ROWS or ball.radius < 1.0:
            ball.members = part
            continue
        dense = np.zeros(width)
        dense[ball.terms] = ball.centre
        squares = np.add.reduceat(part.values.astype(np.float64) ** 2, part.edges[:-1])
        one = _row(part, int(np.argmax(squares - 2 * part.dots(dense))), width)
        other = _row(part, int(np.argmax(squares - 2 * part.dots(one))), width)
        order = np.argsort(part.dots(one - other), kind="stable")
        half = len(order) // 2
        halves = []
        for chosen in (order[:half], order[half:]):
            below = part.take(chosen)
            halves.append(Ball(below, ball.rows[chosen], width))
            open_.append((halves[-1], below))
        ball.first, ball.second = halves
    return root


def _row(part: Slice, row: int, width: int) -> np.ndarray:
    dense = np.zeros(width)
    a, b = part.edges[row], part.edges[row + 1]
    dense[part.terms[a:b]] = part.values[a:b]
    return dense


class BestList:
    """The k best (score, smaller doc_id first) of an item."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def floor(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for at in np.flatnonzero(scores >= self.floor()).tolist():
            entry = (int(scores[at]), -int(ids[at]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def search(root: Ball, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, space: tuple, best: BestList) -> int:
    """Best-first search of one item; returns how many leaves were scored. ``space`` is two zeroed dense vectors."""
    whole, real = space
    whole[terms], real[terms] = weights, weights
    heap, order, scored = [(-root.bound(real), 0, root)], 0, 0
    while heap:
        bound, _, ball = heapq.heappop(heap)
        if -bound < best.floor():
            break
        if ball.members is not None:
            scored += 1
            best.offer(ball.members.dots(whole), ids[ball.rows])
            continue
        for half in (ball.first, ball.second):
            order += 1
            limit = half.bound(real)
            if limit >= best.floor():
                heapq.heappush(heap, (-limit, order, half))
    whole[terms] = real[terms] = 0
    return scored


def vectors(docs: DataFrame, known) -> DataFrame:
    """(doc_id, n, terms, counts) of every document over the broadcast terms; n counts the others too."""

    def tokenise(batches):
        numbers = known.value
        for batch in batches:
            for first, data, offsets in byte_chunks(batch.column(1)):
                totals, edges, terms, found = [], [0], [], []
                for text in rows_of(data, offsets):
                    counts = count_terms(text)
                    totals.append(sum(counts.values()))
                    for term, count in counts.items():
                        number = numbers.get(term)
                        if number is not None:
                            terms.append(number)
                            found.append(count)
                    edges.append(len(terms))
                edges = pa.array(edges, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(totals)),
                        pa.array(totals, pa.int64()),
                        pa.ListArray.from_arrays(edges, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(edges, pa.array(found, pa.int32())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tokenise, VECTORS)


def slices(batch: pa.RecordBatch):
    """(first row, rows) of a batch in parts of bounded rows and terms."""
    edges = np.concatenate(([0], np.cumsum(batch.column(2).value_lengths().to_numpy())))
    low = 0
    while low < len(edges) - 1:
        high = int(np.searchsorted(edges, edges[low] + SLICE_TERMS, "right")) - 1
        high = min(len(edges) - 1, low + SLICE_ROWS, max(high, low + 1))
        yield low, high - low
        low = high


def _search_task(block, k: int, documents: int, occurrences: int):
    def run(batches):
        width, items = block.value
        best = [BestList(k) for _ in items]
        for batch in batches:
            for low, count in slices(batch):
                part = batch.slice(low, count)
                terms, counts = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
                sizes = part.column(2).value_lengths().to_numpy()
                factors = np.array([length_factor(n, documents, occurrences) for n in part.column(1).to_pylist()], dtype=np.int64)
                values = saturated(counts, np.repeat(factors, sizes))
                # numbers of the terms that occur in this slice
                own, local = np.unique(terms, return_inverse=True)
                place = np.full(width, -1, dtype=np.int64)
                place[own] = np.arange(len(own))
                root = grow(Slice(local, values, np.concatenate(([0], np.cumsum(sizes)))), len(own))
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                space = np.zeros(len(own), dtype=np.int64), np.zeros(len(own))
                for (_, _, wanted, weights), mine in zip(items, best):
                    at = place[wanted]
                    met = at >= 0
                    if met.any():
                        search(root, ids, at[met], weights[met], space, mine)
        found = [(row, item, None if doc == -NO_ID else -doc, score) for (row, item, *_), mine in zip(items, best) for score, doc in mine.heap]
        columns = list(zip(*found)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "item_id", "doc_id", "score"])

    return run


def _block(rows) -> tuple[dict[bytes, int], list]:
    """Numbers of a block's terms, and (row, item_id, terms, counts) of its items."""
    known: dict[bytes, int] = {}
    items = []
    for row in rows:
        counts = count_terms((row["text"] or "").encode())
        terms = np.array([known.setdefault(term, len(known)) for term in counts], dtype=np.int64)
        items.append((row["row"], row["item_id"], terms, np.array(list(counts.values()), dtype=np.int64)))
    return known, items


def rank(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents that score highest, above 0."""
    spark = docs.sparkSession
    items = materialize(items.select(F.col("item_id").cast("bigint"), "text").withColumn("row", F.monotonically_increasing_id()))
    size = items.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    blocks = -(-size // block_bytes) or 1
    parts = []
    for number in range(blocks):
        # about block_bytes of text, or one longer item
        rows = items.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).collect()
        parts.append(_rank_block(docs, rows, k))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _rank_block(docs: DataFrame, rows, k: int) -> DataFrame:
    spark = docs.sparkSession
    numbers, items = _block(rows)
    known = spark.sparkContext.broadcast(numbers)
    path = scratch_path(spark, "term-vectors")
    vectors(docs, known).write.parquet(path)
    known.unpersist()
    stored = spark.read.schema(VECTORS).parquet(path)
    totals = stored.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences")).first()
    # at most one row a term of the block
    having = stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(numbers), dtype=np.int64)
    for term, count in having:
        weights[term] = term_weight(totals["documents"], count)
    weighted = [(row, item, terms, counts * weights[terms]) for row, item, terms, counts in items]
    block = spark.sparkContext.broadcast((len(numbers), weighted))
    task = _search_task(block, k, totals["documents"], max(1, totals["occurrences"]))
    return materialize(stored.where(F.size("terms") > 0).mapInArrow(task, "row bigint, item_id bigint, doc_id bigint, score bigint"))
