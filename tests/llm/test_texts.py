"""Encoding, counting and packing against the libraries."""

import hashlib
import zlib

import numpy as np
import pytest

from ospara.llm import binary, blocks, bpe, counts, packing
from ospara.llm.vocabularies import default_path, encoder

SCHEMA = "doc_id long, text string, block long, bin string, ids string"
TEXTS = [
    (1, "The rain in Spain falls.\nIt's 12 o'clock, they'll wait  here. "),
    (2, None), (3, ""), (4, " \n\t "),
    (5, "a <|endoftext|> b<|startoftext|>c ΣΑΣ İstanbul ß é ́x 東京 👍🏽 x\x1cy z w ࢏՘"),
    (5, "same id"), (5, "same id"), (None, "no id"), (6, "word " * 3000), (7, "é" * 5000), (8, " lead\x85 x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 9, "x", "y") for i, t in TEXTS], SCHEMA).repartition(3)


def order(rows):
    return sorted(rows, key=str)


def test_words_encode_as_whole_texts(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(default_path(bpe.VOCABULARY))
    want = []
    for i, t in TEXTS:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        text = whole.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))))
    assert order(map(tuple, bpe.digests(bpe.encode_and_decode(docs)).collect())) == order(want)
    small = bpe.digests(bpe.encode_and_decode(docs, block_bytes=64))
    assert order(map(tuple, small.collect())) == order(want)


def test_counts_equal_the_library(docs):
    encode = encoder(default_path(counts.VOCABULARY))
    want = []
    for i, t in TEXTS:
        n = len(encode([t or ""])[0])
        want.append((i, len((t or "").encode()), n, n > 512))
    assert order(map(tuple, counts.over_limit(counts.count_tokens(docs)).collect())) == order(want)


def test_character_tables_of_both_splitters():
    probes = [chr(c) for c in [*range(0x20, 0x600), *range(0x860, 0x900), *range(0x2000, 0x20A0), 0xA7CE, 0x1C89]]
    library = counts._library()
    for c in probes:
        text = f"a{c}b {c}1{c} {c}"
        assert counts.pre_tokens(text) == library(text)


def test_ranks_and_json_agree():
    texts = [t or "" for _, t in TEXTS]
    assert encoder(default_path(packing.RANKS))(texts) == encoder(default_path("byte_bpe_50k.json"))(texts)


@pytest.mark.parametrize("space", [" ", "\n"])
def test_long_white_space(spark, space):
    text = f"a{space * 1_500_000}b <|endoftext|>"
    ids = encoder(default_path("byte_bpe_50k.json"))([text])[0]
    assert encoder(default_path(packing.RANKS))([text, "a b"]) == [ids, encoder(default_path("byte_bpe_50k.json"))(["a b"])[0]]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pieces = packing.pack_pieces(docs).orderBy("start").collect()
    assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist() == [*ids, packing.END_ID]


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_binary_cuts(n):
    cuts = packing.binary_cuts(n)
    assert [a for a, _ in cuts] == list(np.cumsum([0, *[b for _, b in cuts]])[:-1])
    assert sum(b for _, b in cuts) == n
    assert all(b & (b - 1) == 0 and b <= 1024 for _, b in cuts)
    assert len([b for _, b in cuts if b < 1024]) == len({b for _, b in cuts if b < 1024})


def test_pieces_restore_documents(docs):
    encode = encoder(default_path("byte_bpe_50k.json"))
    pieces = packing.pack_pieces(docs.filter("doc_id is null or doc_id <> 5"))
    held = {}
    for r in pieces.collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length == 1 << r.bucket and r.offset == 0
        held.setdefault(r.doc_id, []).append((r.start, ids))
    assert pieces.count() == pieces.select("sequence_id").distinct().count()
    for i, t in TEXTS:
        if i != 5:
            ids = np.concatenate([x for _, x in sorted(held[i], key=lambda p: p[0])])
            assert ids.tolist() == [*encode([t or ""])[0], 0]
    digest = packing.piece_digests(pieces).filter("doc_id = 6 and start = 0").first()
    first = np.array([*encode(["word " * 3000])[0], 0], "<u4")[: digest.length]
    assert digest.ids_crc32 == zlib.crc32(first.tobytes())


def test_best_fit_takes_the_tightest_row():
    import random

    random.seed(1)
    for _ in range(60):
        capacity = random.choice([7, 8, 16, 50])
        lengths = [random.randint(1, capacity) for _ in range(random.randint(0, 80))]
        rooms = []
        for size in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r[0] >= size]
            row = min(fits, key=lambda r: r[0]) if fits else rooms.append([capacity]) or rooms[-1]
            row[0] -= size
        rows = binary.best_fit(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(r[0] for r in rooms)


def test_matrices_restore_documents(docs):
    encode = encoder(default_path("byte_bpe_50k.json"))
    held = {}
    for r in binary.packed(docs.filter("doc_id is null or doc_id <> 5"), context=64, pool_tokens=2000).collect():
        ids = np.frombuffer(r.ids, "<u4").reshape(r.n_rows, 64)
        positions = np.frombuffer(r.positions, "<u4").reshape(r.n_rows, 64)
        for n in range(r.n_rows):
            ends = r.cu_seqlens[n]
            assert (positions[n, ends[-1] :] == 0).all()
            for doc, at, a, b in zip(r.doc_ids[n], r.starts[n], ends, ends[1:]):
                assert positions[n, a:b].tolist() == list(range(b - a))
                held.setdefault(doc, []).append((at, ids[n, a:b]))
    for i, t in TEXTS:
        if i != 5:
            ids = np.concatenate([x for _, x in sorted(held[i], key=lambda p: p[0])])
            assert ids.tolist() == [*encode([t or ""])[0], 50256]


def test_empty_tables(docs):
    none = docs.limit(0)
    assert bpe.encode_and_decode(none).count() == 0
    assert counts.count_tokens(none).count() == 0
    assert packing.pack_pieces(none).count() == 0
    assert binary.packed(none).count() == 0


def test_changed_order_is_an_error(spark):
    rows = [(i, f"w{i} w{i + 1}") for i in range(40)]
    one, other = (spark.createDataFrame(r, "doc_id long, text string").coalesce(1) for r in (rows, rows[::-1]))
    lists = blocks.word_lists(one, bpe.fold_words, 4, 64)
    codes = blocks.coded(other, bpe.fold_words, 4, 64)
    placed = blocks.place(codes, blocks.answer(lists, lambda words: [(1,)] * len(words)), None, counts.SCHEMA, counts.ARROW)
    with pytest.raises(Exception, match="another order"):
        placed.collect()


def test_one_fold_gives_both_sides(spark):
    docs = spark.createDataFrame([(i, f"w{i % 3} x") for i in range(9)], "doc_id long, text string").coalesce(1)
    lists, codes = blocks.folded(docs, bpe.fold_words, 4, 16)
    assert sorted(map(tuple, lists.collect())) == sorted(map(tuple, blocks.word_lists(docs, bpe.fold_words, 4, 16).collect()))
    assert sorted(map(tuple, codes.collect())) == sorted(map(tuple, blocks.coded(docs, bpe.fold_words, 4, 16).collect()))
