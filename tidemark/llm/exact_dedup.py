"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

Texts are equal when their normalised forms (A-Z lower-cased) are; a digest stands for a form. A Misra-Gries
summary over all digests names every digest that may be frequent, in bounded space; an aggregate verifies
their counts and winners, which are broadcast, so copies of a frequent text are resolved where they are read.
All other digests, none of which can hold more than a small share of the rows, are shuffled as usual.

Defined results: null counts as the empty text; of rows with equal text the one with the largest doc_id
stays (a null id is the smallest); of rows that repeat id and text exactly one stays; an empty table gives no
rows; other columns are ignored by ``decide`` and passed through by ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 32
TRACKED = 1024
HEAVY = 128
BITS = 1 << 26


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; ``lower`` is the same on ASCII and much faster."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def heavy_hashes(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Misra-Gries candidates: the most frequent digest hashes of each bucket, at most BUCKETS x ``heavy``.

    The summary keeps ``tracked`` counters per bucket and is merged bucket by bucket, so no task reads more
    than a bucket's summaries.
    """
    hashed = rows.select(F.xxhash64("digest").alias("h"))
    top = hashed.groupBy(F.pmod("h", F.lit(BUCKETS)).alias("b")).agg(F.expr(f"approx_top_k(h, {heavy}, {tracked})").alias("top"))
    return top.select(F.explode("top.item").alias("h"))


def decide(docs: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row."""
    rows = materialize(docs.select("doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")))
    best = F.max(F.struct("doc_id", "row"))
    frequent = F.broadcast(heavy_hashes(rows, heavy, tracked))
    winners = materialize(
        rows.withColumn("h", F.xxhash64("digest")).join(frequent, "h").groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).where("group_size > 1")
    )
    split = rows.join(F.broadcast(winners), "digest", "left")
    resolved = split.where("best IS NOT NULL")
    same = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("best", F.max(F.struct("doc_id", "row")).over(same))
        .withColumn("group_size", F.count("*").over(same))
    )
    columns = ["doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"), "digest"]
    return resolved.select(*columns).unionAll(rest.select(*columns))


def deduplicate(docs: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """The rows that stay, with all their columns (none of which may be named ``__dedup_...``).

    Texts stay where they are read: winners of frequent digests are broadcast, and a bitmap of ``BITS`` bits (8 MB) tells
    which other digests may occur more than once. Only rows that it marks are shuffled, with the winners of their
    digests. A row that repeats the winner's id and text as well is taken once.
    """
    rows = materialize(docs.select("doc_id", digest(F.col("text")).alias("digest")))
    counted = rows.withColumn("h", F.xxhash64("digest")).join(F.broadcast(heavy_hashes(rows, heavy, tracked)), "h", "left_semi")
    frequent = F.broadcast(materialize(_winners(counted.select("doc_id", "digest"))))
    names = [F.col(c).alias(f"__dedup_{c}") for c in ("digest", "best", "twins")]
    rest = rows.join(frequent.select("digest"), "digest", "left_anti")
    repeated = materialize(_winners(rest)).select(*names)

    number = F.pmod(F.xxhash64("__dedup_digest"), F.lit(BITS)) + 1
    bitmap = repeated.select(number.alias("n")).groupBy(F.bitmap_bucket_number("n").alias("__dedup_bucket"))
    bitmap = bitmap.agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("__dedup_bits"))
    marked = docs.withColumn("__dedup_digest", digest(F.col("text")))
    placed = marked.withColumn("__dedup_bucket", F.bitmap_bucket_number(number)).withColumn("__dedup_bit", F.bitmap_bit_position(number))
    # a byte of the bitmap holds eight numbers, the lowest in its lowest bit
    byte = "CAST(conv(hex(substring(__dedup_bits, CAST(__dedup_bit DIV 8 AS INT) + 1, 1)), 16, 10) AS BIGINT)"
    suspect = F.expr(f"coalesce(shiftright({byte}, CAST(__dedup_bit % 8 AS INT)) & 1, 0) = 1")
    seen = placed.join(F.broadcast(bitmap), "__dedup_bucket", "left").join(frequent.select(*names), "__dedup_digest", "left")
    suspects = seen.withColumn("__dedup_suspect", suspect & F.col("__dedup_twins").isNull())
    columns = [*docs.columns, "__dedup_digest"]
    once = suspects.where("NOT __dedup_suspect")
    others = suspects.where("__dedup_suspect").select(*columns).join(repeated, "__dedup_digest", "left")
    alike = "__dedup_twins IS NULL OR (doc_id <=> __dedup_best AND __dedup_twins {})"
    single = [part.where(alike.format("= 1")).select(*docs.columns) for part in (once, others)]
    twins = [part.where("doc_id <=> __dedup_best AND __dedup_twins > 1").select(*columns) for part in (once, others)]
    # the optimizer keeps one row of each in every task before it shuffles them
    first = Window.partitionBy("doc_id", "__dedup_digest").orderBy(F.lit(0))
    left = twins[0].unionAll(twins[1]).withColumn("__dedup_n", F.row_number().over(first)).where("__dedup_n = 1")
    return single[0].unionAll(single[1]).unionAll(left.select(*docs.columns))


def _winners(rows: DataFrame) -> DataFrame:
    """(digest, best, twins) of digests with several rows: the doc_id that stays, and how many rows have it."""
    same = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("twins"))
    best = same.groupBy("digest").agg(F.max(F.struct("doc_id", "twins")).alias("m"), F.sum("twins").alias("size"))
    return best.where("size > 1").select("digest", F.col("m.doc_id").alias("best"), F.col("m.twins").alias("twins"))
