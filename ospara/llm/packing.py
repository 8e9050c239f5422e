"""Packing by power-of-two decomposition.

A document's ids are cut into full contexts and the binary digits of the rest,
largest first; every piece is a sequence of its own, so no sequence crosses
documents and none has padding. Pieces of one length form a bucket, from which
a trainer draws batches of equal shape.

The job only maps over the documents: no shuffle, one document at a time.

Defined results: a null or empty text is the end token alone; repeated rows are
packed each; a null doc_id stays null; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.texts import raw, slices, task_number
from ospara.llm.vocabularies import default_path, encoder

CONTEXT = 1024
END_ID = 0
RANKS = "byte_bpe_50k.tiktoken"
SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, bucket int, ids binary"
)
#: Sequence numbers of one task.
TASK_BITS = 40


def binary_cuts(n: int, context: int = CONTEXT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; every length is a power of two."""
    cuts = [(at, context) for at in range(0, n - context + 1, context)]
    at = len(cuts) * context
    for bit in reversed(range(context.bit_length())):
        if (n - at) >> bit:
            cuts.append((at, 1 << bit))
            at += 1 << bit
    return cuts


def pack_pieces(
    docs: DataFrame, context: int = CONTEXT, end_id: int = END_ID, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit numbers.

    ``bucket`` is the binary logarithm of the length. ``context`` must be a
    power of two.
    """
    if context < 1 or context & (context - 1):
        raise ValueError("context must be a power of two")
    path = tokenizer or default_path(RANKS)
    schema = pa.schema([
        *[(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")],
        ("bucket", pa.int32()), ("ids", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        sequence = task_number() << TASK_BITS
        for batch in slices(batches, "text"):
            out: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
                ids = np.array([*encode([text.decode()])[0], end_id], dtype="<u4")
                for start, length in binary_cuts(len(ids), context):
                    row = (doc_id, start, length, len(ids), sequence, 0, length.bit_length() - 1,
                           ids[start : start + length].tobytes())
                    for values, value in zip(out, row):
                        values.append(value)
                    sequence += 1
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, SCHEMA)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, ready for batches of one shape."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
