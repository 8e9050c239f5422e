"""Public tokenizer files by path; each worker process loads a file once."""

from __future__ import annotations

import base64
import functools
import os

import public_tokenizers

#: Fixed value of the byte-level vocabulary: its one special string and that string's id.
END_OF_TEXT = {"<|endoftext|>": 50256}


def default_path(name: str) -> str:
    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """A function from a list of texts to lists of ids, without added special tokens.

    ``.json`` files go to tokenizers, ``.tiktoken`` ranks to tiktoken (the same
    ids for the byte-level vocabulary, about five times faster), ``.model``
    files to sentencepiece. A text that tiktoken refuses, as it does runs of
    about a million white-space characters, goes to the ``.json`` file beside
    the ranks. Special strings inside a text become their id, as
    tokenizers does by default.
    """
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        return lambda texts: [e.ids for e in loaded.encode_batch_fast(texts, add_special_tokens=False)]
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        loaded = tiktoken.Encoding(
            os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=END_OF_TEXT
        )

        def encode(text: str) -> list[int]:
            try:
                return loaded.encode(text, allowed_special="all")
            except ValueError as refused:
                if "stack size" not in str(refused):
                    raise
                return encoder(f"{path.removesuffix('.tiktoken')}.json")([text])[0]

        return lambda texts: [encode(t) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [loaded.encode(t, num_threads=1) for t in texts]
    raise ValueError(f"no tokenizer for {path}")


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[dict[int, str], frozenset[int]]:
    """Id to piece, and the ids of added tokens, of a ``.json`` file."""
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    pieces = {i: token for token, i in loaded.get_vocab(with_added_tokens=True).items()}
    return pieces, frozenset(loaded.get_added_tokens_decoder())
