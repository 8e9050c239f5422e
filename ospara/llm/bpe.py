"""BPE encoding and decoding by a table of distinct words.

The vocabulary's splitter never crosses white space, and its normalizer treats
each side of white space alone, so a text's ids are the ids of its words in
turn. Words are split at ASCII white space, each distinct word is encoded once
(``blocks``), and its ids are joined back by position. Decoding joins every id
to its piece and sets a space between pieces, as a vocabulary without a
decoder does.

Defined results: a null or empty text, or one of white space alone, has no ids
and decodes to an empty text; repeated rows are encoded each; a null doc_id
stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm import blocks
from ospara.llm.vocabularies import default_path, encoder, vocabulary

VOCABULARY = "word_bpe_49k.json"
#: Bytes of text per block: a block's ids and decoded text are held together.
BLOCK_BYTES = 16 << 20
SCHEMA = "doc_id long, ids array<int>, decoded string"
ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def fold_words(texts: list[bytes], code) -> list[np.ndarray]:
    """Codes of the words of each text; bytes split at space and \\t \\n \\v \\f \\r only."""
    split = map(bytes.split, texts)
    return [np.fromiter(map(code, words), np.uint32, len(words)) for words in split]


def expand(codes: np.ndarray, start: np.ndarray, number: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The values of each code in turn."""
    n = number[codes]
    ends = np.cumsum(n)
    at = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    return flat[at + np.repeat(start[codes] - (ends - n), n)]


def encode_and_decode(docs: DataFrame, tokenizer: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids, decoded) of every text, for vocabularies that drop white space."""
    path = tokenizer or default_path(VOCABULARY)
    buckets = blocks.bucket_count(docs)

    def ids_of(words: list[bytes]) -> list[list[int]]:
        return encoder(path)([w.decode() for w in words])

    def finish(doc_ids, n_bytes, sizes, codes, start, number, flat) -> pa.Table:
        pieces, _ = vocabulary(path)
        table = pa.array([pieces.get(i, "") for i in range(max(pieces) + 1)], pa.string())
        ends = np.cumsum(sizes)
        tables = []
        step = 1000
        for lo in range(0, len(doc_ids), step):
            hi = min(lo + step, len(doc_ids))
            part = codes[(ends[lo] - sizes[lo]) : ends[hi - 1]]
            ids = expand(part, start, number, flat).astype(np.int32)
            held = np.concatenate([[0], np.cumsum(number[part])])
            bounds = pa.array(held[np.concatenate([[0], np.cumsum(sizes[lo:hi])])].astype(np.int32))
            joined = pc.binary_join(pa.ListArray.from_arrays(bounds, table.take(pa.array(ids))), " ")
            tables.append(pa.Table.from_arrays(
                [pa.array(doc_ids[lo:hi], pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(ids)), joined], schema=ARROW
            ))
        return pa.concat_tables([*tables, ARROW.empty_table()])

    lists = blocks.word_lists(docs, fold_words, buckets, block_bytes)
    answers = blocks.answer(lists, ids_of)
    return blocks.place(blocks.coded(docs, fold_words, buckets, block_bytes), answers, finish, SCHEMA, ARROW)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
