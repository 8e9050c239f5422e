"""Token counts without token ids.

The byte-level vocabulary never merges across pre-tokens, so a text has as many
tokens as its pre-tokens have together. Each document becomes pre-token
frequencies, each distinct pre-token's pieces are counted once (``blocks``),
and a document's total is the sum of frequency times count.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings
inside a text count as the one token the library makes of them; repeated rows
are counted each; a null doc_id stays null; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm import blocks
from ospara.llm.vocabularies import END_OF_TEXT, default_path, encoder

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
SCHEMA = "doc_id long, n_bytes long, n_tokens long"

_pieces = regex.compile(PATTERN)
_special = re.compile("(" + "|".join(map(re.escape, END_OF_TEXT)) + ")")
#: A space starts a pre-token of its own unless white space or the end follows.
_joined_space = re.compile(r" (?:\s|$)|^\s")


@functools.lru_cache(maxsize=1)
def _library():
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    return lambda text: [text[a:b] for _, (a, b) in split(text)]


@functools.lru_cache(maxsize=1 << 16)
def _agreed(char: str) -> bool:
    """Whether both libraries' character tables class the character alike."""
    probe = f"a{char}b {char}1{char}"
    return _pieces.findall(probe) == _library()(probe)


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens in order; a special string is one of them."""
    split = _pieces.findall if text.isascii() or all(map(_agreed, set(text))) else _library()
    found = []
    for part in _special.split(text) if "<|" in text else (text,):
        found += [part] if part in END_OF_TEXT else split(part)
    return found


class _SplitWords(dict):
    """Number of a word that follows a space; a new word is split into the codes of its pre-tokens."""

    def __init__(self, code: Callable[[bytes], int]):
        self.code = code
        self.starts, self.pieces = [0], []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.pieces += [self.code(p.encode()) for p in pre_tokens(" " + word)]
        self.starts.append(len(self.pieces))
        return number


def fold_pre_tokens(texts: list[bytes], code: Callable[[bytes], int]) -> list[np.ndarray]:
    """Pairs (code, frequency) of the distinct pre-tokens of each text, interleaved.

    Where every space stands before a character that is not white space, the
    pattern never crosses a space, so words repeat and are split once a block.
    """
    words_seen = _SplitWords(code)
    number = words_seen.__getitem__
    counted, plain = [], []
    for text in texts:
        text = text.decode()
        spaced = _joined_space.search(text) or "<|" in text
        first, *rest = (text,) if spaced else text.split(" ")
        words = Counter(rest)
        counted.append((np.fromiter(map(number, words), np.int64, len(words)),
                        np.fromiter(words.values(), np.int64, len(words))))
        alone = Counter([code(p.encode()) for p in pre_tokens(first)])
        plain.append((list(alone), list(alone.values())))
    at, flat = np.array(words_seen.starts, np.int64), np.array(words_seen.pieces, np.int64)
    lengths = np.diff(at)
    out = []
    for (words, times), (alone, more) in zip(counted, plain):
        n = lengths[words]
        ends = np.cumsum(n)
        index = np.arange(int(n.sum())) + np.repeat(at[words] - (ends - n), n)
        codes, where = np.unique(np.concatenate([flat[index], np.array(alone, np.int64)]), return_inverse=True)
        weights = np.concatenate([np.repeat(times, n), np.array(more, np.int64)])
        pairs = np.empty(2 * len(codes), np.uint32)
        pairs[0::2] = codes
        pairs[1::2] = np.bincount(where, weights, len(codes))
        out.append(pairs)
    return out


def count_tokens(docs: DataFrame, tokenizer: str | None = None, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every text."""
    path = tokenizer or default_path(VOCABULARY)
    buckets = blocks.bucket_count(docs)

    def counts_of(words: list[bytes]) -> list[tuple[int]]:
        return [(len(ids),) for ids in encoder(path)([w.decode() for w in words])]

    def finish(doc_ids, n_bytes, sizes, codes, start, number, flat) -> pa.Table:
        tokens = flat[start[codes[0::2]]] * codes[1::2].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(tokens)])
        ends = np.cumsum(sizes // 2)
        totals = sums[ends] - sums[ends - sizes // 2]
        return pa.Table.from_arrays([pa.array(v, pa.int64()) for v in (doc_ids, n_bytes, totals)], schema=ARROW)

    lists, codes = blocks.folded(docs, fold_pre_tokens, buckets, block_bytes)
    return blocks.place(codes, blocks.answer(lists, counts_of), finish, SCHEMA, ARROW)


def over_limit(counted: DataFrame, limit: int = LIMIT) -> DataFrame:
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
