"""Distinct-word tables for texts that are far longer than their vocabulary.

A task folds the texts of a block into the block's distinct words and one code
per occurrence, so that only distinct words are dealt out by word: each word of
the corpus is evaluated once, by the one task that owns its bucket, and the
answers return to the block, where codes place them. A word that occurs in
every document still makes one entry per block.

``folded`` folds every text once and writes codes and words of the blocks;
``word_lists`` and ``coded`` without it fold twice and write nothing, which asks
for texts that come in the same order each time, as those of a scan do. A block
is named by its words, so that an order that changes is an error, never a wrong
answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import written
from ospara.llm.texts import raw, slices, task_number

#: Bytes of text per block; a longer text is a block of its own.
BLOCK_BYTES = 32 << 20
#: Words whose answers a task remembers; beyond that it forgets and evaluates again.
REMEMBERED_WORDS = 2_000_000
ORDINAL_BITS = 24

#: Folds the texts of a block into codes each, given a function from word to code.
Fold = Callable[[list[bytes], Callable[[bytes], int]], list[np.ndarray]]


def squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of small unsigned numbers, byte planes apart."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(-1)


class _Words(dict):
    """Word to code, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _blocks(batches: Iterator[pa.RecordBatch], fold: Fold, block_bytes: int) -> Iterator[tuple]:
    first = task_number() << ORDINAL_BITS
    for ordinal, batch in enumerate(slices(batches, "text", block_bytes)):
        words = _Words()
        texts = raw(batch.column("text"))
        codes = fold(texts, words.__getitem__)
        name = xxhash.xxh3_64_intdigest(b"\0".join(words), seed=first + ordinal) - (1 << 63)
        yield name, batch.column("doc_id"), texts, words, codes


def _buckets(words: list[bytes], buckets: int) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (hashes % np.uint64(buckets)).astype(np.uint32)


def bucket_count(df: DataFrame) -> int:
    """Grows with the configured shuffle, as the vocabulary does with the input."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


LISTS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary())])
CODES = pa.schema([("block", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                   ("n_bytes", pa.list_(pa.int64())), ("n_codes", pa.list_(pa.int64())), ("codes", pa.binary())])
LISTS_SQL = "bucket long, block long, words binary, lengths binary"
CODES_SQL = "block long, n_words long, buckets binary, doc_ids array<long>, n_bytes array<long>, n_codes array<long>, codes binary"


def _lists(block: int, words: _Words, buckets: int) -> dict[str, pa.Array]:
    names = list(words)
    of = _buckets(names, buckets)
    order = np.argsort(of, kind="stable")
    found, starts = np.unique(of[order], return_index=True)
    parts = np.split(order, starts[1:]) if names else []
    return {
        "bucket": pa.array(found, pa.int64()),
        "block": pa.array([block] * len(found), pa.int64()),
        "words": pa.array([b"".join(names[i] for i in p) for p in parts], pa.binary()),
        "lengths": pa.array([np.fromiter((len(names[i]) for i in p), "<u4", len(p)).tobytes() for p in parts], pa.binary()),
    }


def _codes(block: int, doc_ids: pa.Array, texts: list[bytes], words: _Words, folded: list[np.ndarray], buckets: int) -> dict[str, pa.Array]:
    row = (block, len(words), squeeze(_buckets(list(words), buckets)), doc_ids.to_pylist(), [len(t) for t in texts],
           [len(c) for c in folded], squeeze(np.concatenate(folded).astype(np.uint32)))
    return {f.name: pa.array([v], f.type) for f, v in zip(CODES, row)}


def word_lists(docs: DataFrame, fold: Fold, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(bucket, block, words, lengths): the block's distinct words of the bucket, as bytes one after the other."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, words, _ in _blocks(batches, fold, block_bytes):
            yield pa.RecordBatch.from_pydict(_lists(block, words, buckets), LISTS)

    return _texts(docs).mapInArrow(lists, LISTS_SQL)


def coded(docs: DataFrame, fold: Fold, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents as codes, and the bucket of each code's word."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _blocks(batches, fold, block_bytes):
            yield pa.RecordBatch.from_pydict(_codes(*found, buckets), CODES)

    return _texts(docs).mapInArrow(codes, CODES_SQL)


def folded(docs: DataFrame, fold: Fold, buckets: int, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``word_lists`` and ``coded`` from one fold, which is written to the shared folder.

    The lists of a block are rows of their own, so that no row holds a whole block twice.
    """
    both = pa.unify_schemas([LISTS, CODES])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _blocks(batches, fold, block_bytes):
            for part in (_lists(found[0], found[3], buckets), _codes(*found, buckets)):
                n = len(part["block"])
                yield pa.RecordBatch.from_arrays([part.get(f.name, pa.nulls(n, f.type)) for f in both], schema=both)

    held, _ = written(_texts(docs).mapInArrow(rows, LISTS_SQL + CODES_SQL.removeprefix("block long")), "blocks")
    return (held.filter("bucket IS NOT NULL").select(LISTS.names), held.filter("bucket IS NULL").select(CODES.names))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def answer(lists: DataFrame, evaluate: Callable[[list[bytes]], list]) -> DataFrame:
    """(block, bucket, counts, values): ``evaluate`` of each word, once per word.

    ``evaluate`` gives a list of unsigned numbers per word; ``values`` holds
    them one after the other, ``counts`` how many each word has.
    """

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list] = {}
        for batch in slices(batches, "words"):
            rows = []
            for data, lengths in zip(batch.column("words").to_pylist(), batch.column("lengths").to_pylist()):
                ends = np.cumsum(np.frombuffer(lengths, "<u4")).tolist()
                rows.append([data[a:b] for a, b in zip([0, *ends], ends)])
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            new = list({w for row in rows for w in row if w not in known})
            known.update(zip(new, evaluate(new)))
            counts, values = [], []
            for row in rows:
                found = [known[w] for w in row]
                counts.append(np.fromiter(map(len, found), "<u4", len(found)))
                values.append(np.fromiter((v for f in found for v in f), "<u4", int(counts[-1].sum())))
            yield pa.RecordBatch.from_pydict({
                "block": batch.column("block"),
                "bucket": batch.column("bucket"),
                "n_values": pa.array(list(map(len, values)), pa.int64()),
                "n_words": pa.array(list(map(len, counts)), pa.int64()),
                "counts": pa.array(list(map(squeeze, counts)), pa.binary()),
                "values": pa.array(list(map(squeeze, values)), pa.binary()),
            })

    return lists.repartition("bucket").mapInArrow(
        answers, "block long, bucket long, n_values long, n_words long, counts binary, values binary"
    )


def place(
    blocks: DataFrame,
    answers: DataFrame,
    finish: Callable[..., Iterator[pa.Table] | pa.Table],
    schema: str,
    arrow: pa.Schema,
) -> DataFrame:
    """Bring the answers back to their blocks; ``finish`` makes the rows of a block.

    ``finish`` gets the document ids, their sizes in bytes, the number of codes
    of each, the codes, and per code the place and number of its values.
    """

    def join(block: pa.Table, found: pa.Table) -> pa.Table:
        # two executors can have made the same block; either copy will do
        out = []
        found = found.to_pydict()
        seen = set()
        counts, values = [], []
        for i in sorted(range(len(found["bucket"])), key=found["bucket"].__getitem__):
            if found["bucket"][i] not in seen:
                seen.add(found["bucket"][i])
                counts.append(unsqueeze(found["counts"][i], found["n_words"][i]))
                values.append(unsqueeze(found["values"][i], found["n_values"][i]))
        in_order = np.concatenate([np.zeros(0, np.int64), *counts]).astype(np.int64)
        if any(row != len(in_order) for row in block.column("n_words").to_pylist()):
            raise RuntimeError("the texts came in another order the second time; fold them once")
        flat = np.concatenate([np.zeros(0, np.uint32), *values]).astype(np.int64)
        for row in block.to_pylist():
            n = row["n_words"]
            by_bucket = np.argsort(unsqueeze(row["buckets"], n), kind="stable")
            number = np.empty(n, np.int64)
            number[by_bucket] = in_order
            start = np.empty(n, np.int64)
            start[by_bucket] = np.cumsum(in_order) - in_order
            sizes = np.asarray(row["n_codes"], dtype=np.int64)
            codes = unsqueeze(row["codes"], int(sizes.sum()))
            out.append(finish(row["doc_ids"], row["n_bytes"], sizes, codes, start, number, flat))
        return pa.concat_tables([*out, arrow.empty_table()])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema)
