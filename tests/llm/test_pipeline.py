"""The pipeline's stages on a small corpus."""

import random

import corpus_pipeline


def test_stages_keep_columns_and_pack_what_is_left(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    text = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(15)) + "." for _ in range(8))
    clean = [text() for _ in range(60)]
    # The near copy has other line breaks, so that only its word shingles give it away.
    words_of = clean[0].replace(clean[0].split()[3], "other", 1).split()
    near = "\n".join(" ".join(words_of[i : i + 11]) for i in range(0, len(words_of), 11))
    noise = [" ".join(rng.choice(words) + "###" for _ in range(120)) for _ in range(10)]
    rows = [(i, t) for i, t in enumerate([*clean, clean[1], near, *noise, None, "", "too short"])]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 62)) for i in range(72)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept, _ = corpus_pipeline.written(stage(spark, kept, str(tmp_path)), name)
        assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids >= set(range(1, 60)) and ids <= set(range(62))
    assert 60 not in ids and ids & {0, 61} == {0}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids


def test_stages_of_an_empty_table_null_ids_and_clashing_columns(spark, tmp_path):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    text = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(9))
    one = text()
    rows = [(1, one, 5, "k"), (None, text(), None, "k"), (None, one, 5, None), (2, text(), 5, "k"), (2, text(), 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, k1 string")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for kept in (docs, docs.limit(0)):
        whole = kept.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept, _ = corpus_pipeline.written(stage(spark, kept, str(tmp_path)), name)
            assert kept.columns == docs.columns
        left = kept.collect()
        assert len(left) == (4 if whole else 0) and sum(r.text == one for r in left) == (1 if whole else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() >= len(left)


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "line_dedup", "near_dedup", "packing"]
