"""Token ids of texts, flat token files, and token counts by separator scan.

A flat token file is a stream of 16-bit ids in which every document ends with the end-of-document id; it has
no index. ``flatten_documents`` makes such files (blocks of a fixed number of ids that cut documents
anywhere) and ``read_token_files`` reads existing ones. ``scan_counts`` finds the separators of each block
with one vectorised search and stitches the documents that cross blocks with a prefix scan in two levels
(blocks in a span, spans in a file), so that a file that holds most of the data is no single task's work.

Defined results: a null or empty text is a document of 0 tokens; ids after a file's last separator are an
unfinished document and are not counted as one (``tail_tokens``); empty files and tables give no rows;
repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize, scratch_path
from .texts import string_chunks

END = 50256
END_TEXT = "<|endoftext|>"
BLOCK_TOKENS = 1 << 16
SPAN_BLOCKS = 1024


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoding(path: str):
    """Byte-level BPE with the ranks of a vocabulary file.

    ``encode_ordinary`` takes special strings in a text for ordinary text; ``encode_special`` of this module makes
    them their ids, as ``tokenizers`` does with ``add_special_tokens=False``.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_TEXT: END})


def encode_special(encoder, text: str) -> list[int]:
    return encoder.encode(text, allowed_special="all") if END_TEXT in text else encoder.encode_ordinary(text)


def flatten_documents(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END) -> tuple[DataFrame, DataFrame]:
    """Write one token file per task under ``path``; return its blocks and the doc_id of each file's documents.

    Blocks: (file, block, ids) with ids as little-endian 16-bit binary. Documents: (file, ordinal, doc_id).
    """
    vocabulary = vocabulary or vocabulary_path()

    def write(batches):
        encoder, file, block, ordinal = encoding(vocabulary), TaskContext.get().partitionId(), 0, 0
        pending = np.zeros(0, dtype=np.uint16)
        for batch in batches:
            for low, texts in string_chunks(batch.column(1)):
                parts = [pending]
                for text in texts:
                    parts.append(np.array(encoder.encode_ordinary(text) + [end], dtype=np.uint16))
                stream = np.concatenate(parts)
                whole = len(stream) // BLOCK_TOKENS * BLOCK_TOKENS
                blobs = [stream[i : i + BLOCK_TOKENS].tobytes() for i in range(0, whole, BLOCK_TOKENS)]
                pending = stream[whole:]
                yield rows(file, block, blobs, ordinal, batch.column(0).slice(low, len(texts)))
                block, ordinal = block + len(blobs), ordinal + len(texts)
        if len(pending):
            yield rows(file, block, [pending.tobytes()], ordinal, pa.array([], pa.int64()))

    def rows(file, block, blobs, ordinal, ids):
        n, m = len(blobs), len(ids)
        return pa.RecordBatch.from_pydict(
            {
                "file": pa.array([str(file)] * (n + m), pa.string()),
                "block": pa.array([*range(block, block + n), *[None] * m], pa.int64()),
                "ids": pa.array(blobs + [None] * m, pa.binary()),
                "ordinal": pa.array([*[None] * n, *range(ordinal, ordinal + m)], pa.int64()),
                "doc_id": pa.concat_arrays([pa.nulls(n, pa.int64()), ids]),
            }
        )

    schema = "file string, block bigint, ids binary, ordinal bigint, doc_id bigint"
    source = docs.select(F.col("doc_id").cast("bigint"), "text")
    source.mapInArrow(write, schema).write.option("compression", "zstd").parquet(path)
    written = docs.sparkSession.read.schema(schema).parquet(path)
    return (
        written.where("block IS NOT NULL").select("file", "block", "ids"),
        written.where("ordinal IS NOT NULL").select("file", "ordinal", "doc_id"),
    )


def read_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of existing flat files of 16-bit ids (each below 2 GB, the limit of Spark's binary reader)."""
    size = 2 * block_tokens
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content", "length")
    blocks = F.expr(f"sequence(0L, greatest(ceil(length / {size}) - 1, 0L))")
    cut = files.where("length > 0").select("file", "content", F.explode(blocks).alias("block"))
    return cut.select("file", "block", F.expr(f"substring(content, CAST(block * {size} + 1 AS INT), {size})").alias("ids"))


def _scan(end: int):
    def scan(batches):
        """Per block: ids before its first separator, after its last one, and the counts in between."""
        for batch in batches:
            heads, tails, inner, separators = [], [], [], []
            for blob in batch.column(2):
                ids = np.frombuffer(blob.as_buffer(), dtype="<u2")
                found = np.flatnonzero(ids == end)
                separators.append(len(found))
                heads.append(int(found[0]) if len(found) else len(ids))
                tails.append(int(len(ids) - 1 - found[-1]) if len(found) else 0)
                inner.append(np.diff(found) - 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "file": batch.column(0),
                    "block": batch.column(1),
                    "separators": pa.array(separators, pa.int64()),
                    "head": pa.array(heads, pa.int64()),
                    "tail": pa.array(tails, pa.int64()),
                    "inner": pa.array(inner, pa.list_(pa.int64())),
                }
            )

    return scan


def scan_counts(blocks: DataFrame, end: int = END) -> DataFrame:
    """(file, ordinal, n_tokens) of every finished document, the separator not counted."""
    schema = "file string, block bigint, separators bigint, head bigint, tail bigint, inner array<bigint>"
    scanned = blocks.select("file", "block", "ids").mapInArrow(_scan(end), schema)
    scanned = materialize(scanned.withColumn("span", F.floor(F.col("block") / SPAN_BLOCKS)))
    # What runs into a block is the tail of the last block with a separator plus the blocks without one since.
    # A span (or block) is summed up as (documents ended, ids carried in if none ended, ids carried out).
    before = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = _carry(scanned, before)
    span = (
        carried.groupBy("file", "span")
        .agg(
            F.sum("separators").alias("separators"),
            F.max_by(F.struct("run_after", "closed_after"), "block").alias("last"),
        )
        .select("file", "span", "separators", F.col("last.run_after").alias("out"), F.col("last.closed_after").alias("closed"))
    )
    earlier = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = span.withColumn("upto", F.coalesce(F.sum("out").over(earlier), F.lit(0)))
    start = F.coalesce(F.max(F.when(F.col("closed"), F.col("upto"))).over(earlier), F.lit(0))
    spans = spans.select(
        "file",
        "span",
        (F.col("upto") - start).alias("run_into_span"),
        F.coalesce(F.sum("separators").over(earlier), F.lit(0)).alias("docs_before_span"),
    )
    joined = carried.join(spans, ["file", "span"])
    into = F.col("run_before") + F.when(F.col("closed_before"), 0).otherwise(F.col("run_into_span"))
    first = F.col("docs_before_span") + F.col("docs_before")
    counts = F.concat(F.array(F.col("head") + into), "inner")
    return (
        joined.where("separators > 0")
        .select("file", first.alias("first"), F.posexplode(counts).alias("place", "n_tokens"))
        .select("file", (F.col("first") + F.col("place")).alias("ordinal"), "n_tokens")
    )


def _carry(scanned: DataFrame, before) -> DataFrame:
    """Running state of each block within its span, from windows over the block summaries."""
    closed = F.col("separators") > 0
    opened = F.coalesce(F.sum(closed.cast("int")).over(before), F.lit(0))
    marked = scanned.withColumn("part", opened).withColumn("docs_before", F.coalesce(F.sum("separators").over(before), F.lit(0)))
    # ids that a block passes on: its tail after a separator, else all its ids (they are all head)
    passed = F.when(closed, F.col("tail")).otherwise(F.col("head"))
    marked = marked.withColumn("passed", passed)
    # the running sum of what is passed on, less the sum before the last closed block
    upto = F.coalesce(F.sum("passed").over(before), F.lit(0))
    marked = marked.withColumn("upto", upto)
    start = F.coalesce(F.max(F.when(closed, F.col("upto"))).over(before), F.lit(0))
    marked = marked.withColumn("run_before", F.col("upto") - start).withColumn("closed_before", F.col("part") > 0)
    return marked.withColumn("run_after", F.when(closed, F.col("tail")).otherwise(F.col("run_before") + F.col("head"))).withColumn(
        "closed_after", closed | F.col("closed_before")
    )


def count_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Tokens of every document, by way of flat token files in the shared folder."""
    blocks, owners = flatten_documents(docs, scratch_path(docs.sparkSession, "token-files"), vocabulary)
    return owners.join(scan_counts(blocks), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
