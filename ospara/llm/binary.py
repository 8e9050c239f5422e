"""Packed token-id matrices by best-fit-decreasing packing.

Documents are encoded, closed by an end token and, where longer than a row,
cut into full rows and a rest, so that no id is lost. A task gathers pieces up
to ``POOL_TOKENS`` ids and packs the pool: longest piece first, each into the
open row with the least room that still holds it. A segment tree over the
possible room finds that row. Pools are large against a row, so that a pool's
last rows are all the padding that the cut into pools adds.

The job only maps over the documents: no shuffle, one pool in memory.

Defined results: a null or empty text is the end token alone; repeated rows are
packed each; equal lengths go in order of arrival; a null doc_id stays null;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.texts import raw, slices, task_number
from ospara.llm.vocabularies import END_OF_TEXT, default_path, encoder

CONTEXT = 2048
RANKS = "byte_bpe_50k.tiktoken"
POOL_TOKENS = 8 << 20
ROWS_PER_MATRIX = 64
MATRIX_BITS = 32
SCHEMA = (
    "matrix_id long, n_rows int, ids binary, positions binary, cu_seqlens array<array<int>>, "
    "doc_ids array<array<long>>, starts array<array<long>>"
)
ARROW = pa.schema([
    ("matrix_id", pa.int64()), ("n_rows", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary()),
    ("cu_seqlens", pa.list_(pa.list_(pa.int32()))), ("doc_ids", pa.list_(pa.list_(pa.int64()))),
    ("starts", pa.list_(pa.list_(pa.int64()))),
])


class Rooms:
    """Open rows by their room, with a segment tree that finds the least room of a size or more."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.open[at] += 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the tightest open row for ``size``, which is closed; None if there is none."""
        at = size + self.leaves
        if at >= 2 * self.leaves:
            return None
        if not self.open[at]:
            while at & 1 or not self.open[at + 1]:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not self.open[at]:
                    at += 1
        room = at - self.leaves
        while at:
            self.open[at] -= 1
            at >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers, by best fit on decreasing lengths."""
    rooms = Rooms(capacity)
    rows: list[list[int]] = []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[piece])
        if found is None:
            found = (capacity, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(piece)
        if room > lengths[piece]:
            rooms.add(room - lengths[piece], row)
    return rows


def packed(
    docs: DataFrame, context: int = CONTEXT, end_id: int = END_OF_TEXT["<|endoftext|>"], pad_id: int = 0,
    tokenizer: str | None = None, pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per matrix of at most ``ROWS_PER_MATRIX`` rows of ``context`` ids.

    ``ids`` and ``positions`` are little-endian unsigned 32-bit numbers, row by
    row; positions count from 0 in every segment. ``cu_seqlens`` has the
    cumulative segment lengths of each row, 0 first; ids beyond its last value
    are padding. ``doc_ids`` and ``starts`` tell where each segment comes from.
    """
    path = tokenizer or default_path(RANKS)

    def matrices(pool: list[tuple], first: int) -> Iterator[pa.RecordBatch]:
        rows = best_fit([len(ids) for _, _, ids in pool], context)
        for lo in range(0, len(rows), ROWS_PER_MATRIX):
            part = [[pool[i] for i in row] for row in rows[lo : lo + ROWS_PER_MATRIX]]
            ids = np.full((len(part), context), pad_id, "<u4")
            positions = np.zeros((len(part), context), "<u4")
            ends = []
            for n, row in enumerate(part):
                ends.append([0])
                for _, _, values in row:
                    at, size = ends[-1][-1], len(values)
                    ids[n, at : at + size] = values
                    positions[n, at : at + size] = np.arange(size)
                    ends[-1].append(at + size)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((
                first + lo // ROWS_PER_MATRIX, len(part), ids.tobytes(), positions.tobytes(), ends,
                [[d for d, _, _ in row] for row in part], [[s for _, s, _ in row] for row in part]), ARROW)], schema=ARROW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        pool, size, matrix = [], 0, task_number() << MATRIX_BITS
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
                ids = np.array([*encode([text.decode()])[0], end_id], "<u4")
                pool += [(doc_id, at, ids[at : at + context]) for at in range(0, len(ids), context)]
                size += len(ids)
                if size >= pool_tokens:
                    for out in matrices(pool, matrix):
                        matrix += 1
                        yield out
                    pool, size = [], 0
        yield from matrices(pool, matrix)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, SCHEMA)


def write_matrices(matrices: DataFrame, path: str) -> None:
    matrices.write.mode("overwrite").parquet(path)
