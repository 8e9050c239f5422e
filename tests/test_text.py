"""Chunks, truncation, matches and masking on edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from ospara.functions import text
from ospara.operators import guardrails, search


def chunked(spark, body, size=500, overlap=50):
    df = spark.createDataFrame([(body,)], "t string")
    return [r.chunk for r in text.chunk_rows(df, "t", size, overlap).orderBy("chunk_index").collect()]


def by_hand(body, size, overlap):
    out, start = [], 0
    while True:
        out.append(body[start : start + size])
        if start + size >= len(body):
            return out
        start += size - overlap


@pytest.mark.parametrize("n", [0, 1, 50, 51, 499, 500, 501, 949, 950, 951, 1400, 1401, 5000])
def test_chunk_lengths(spark, n):
    body = "".join(chr(97 + i % 26) for i in range(n))
    assert chunked(spark, body) == by_hand(body, 500, 50)


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 7), (7, 6), (3, 1)])
def test_chunk_overlaps(spark, size, overlap):
    body = "héllo wörld\nsecond line 😀 and more"
    assert chunked(spark, body, size, overlap) == by_hand(body, size, overlap)


def test_truncation(spark):
    cases = {
        "a" * 1000: "a" * 1000, "a" * 1001: "a" * 1000, "." + "a" * 1200: "a", "b" * 10 + "." + "a" * 1200: "b" * 10 + ".",
        "x" * 999 + "." + "yyy": "x" * 999 + ".",
    }
    cases["." + "a" * 1200] = "." + "a" * 999
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(text.truncate_at_sentence("t")).collect()] == list(cases.values())


SAMPLE = """
    Contact: john.doe@example.com
    Phone: (123) 456-7890
    SSN: 123-45-6789
    API Key: api_key=1234567890abcdef
    Credit Card: 4111-1111-1111-1111
    Host 10.0.0.1 é555-123-4567
"""


def test_values_agree_with_offsets(spark):
    df = spark.createDataFrame([(SAMPLE,), ("",), (None,), ("aaa AAA",)], "t string")
    rules = [*text.default_rules(), text.DetectionRule("secret", text.SECRET_PATTERN, "security"),
             text.DetectionRule("aa", "aa", is_regex=False)]
    for rule in rules:
        rows = df.select("t", text.found("t", rule).alias("v"), text.spans_of(rule)(F.col("t")).alias("s")).collect()
        for r in rows:
            if r.t is None:
                continue
            assert r.v == [s.text for s in r.s], rule.name
            assert all(r.t[s.start : s.end] == s.text for s in r.s)
    literal = df.select(text.found("t", rules[-1]).alias("v")).collect()
    assert literal[3].v == ["aa", "aa", "AA", "AA"]


def test_masking_of_overlaps(spark):
    df = spark.createDataFrame([(SAMPLE,), ("call 4111111111111111 now",), (None,), ("clean",)], "t string")
    rows = df.select("t", text.masker(text.default_rules())(F.col("t")).alias("m")).collect()
    assert rows[2].m is None and rows[3].m == "clean"
    for r in rows[:2]:
        assert len(r.m) == len(r.t)
        spans = [m.span() for p in text.PII_PATTERNS.values() for m in re.finditer(p, r.t, re.IGNORECASE)]
        inside = {i for a, b in spans for i in range(a, b)}
        assert r.m == "".join("*" if i in inside else c for i, c in enumerate(r.t))


def test_guard_blocks(spark):
    df = spark.createDataFrame([(1, "mail a@b.co", 0.95), (2, "mail a@b.co", 0.9), (3, "bad word", None)], "id int, t string, x double")
    rules = [*text.default_rules(), text.DetectionRule("w", "bad", "offensive", "block", is_regex=False),
             text.DetectionRule("l", "mail", "custom", "log")]
    out = guardrails.guard(df, "t", rules, F.col("x"))
    allowed, blocked = guardrails.split_blocked(out, "t")
    assert [(r.id, r.t) for r in allowed.collect()] == [(2, "mail ******")]
    assert sorted((r.id, r.t) for r in blocked.collect()) == [(1, "mail a@b.co"), (3, "bad word")]
    found = guardrails.audit_rows(guardrails.detections(df, "id", "t", rules), "id").collect()
    assert {(r.id, r.rule, r.num_matches, r.sample_match) for r in found} == {
        (1, "default_email", 1, "a@b.co"), (2, "default_email", 1, "a@b.co"), (1, "l", 1, "mail"), (2, "l", 1, "mail"),
        (3, "w", 1, "bad"),
    }


def test_keyword_score(spark):
    df = spark.createDataFrame([("Milk milk silk",), ("none",)], "t string")
    assert [r[0] for r in df.select(search.keyword_score(F.col("t"), "MILK")).collect()] == [3, 0]


def test_summary_lines(spark):
    body = "\n".join(["  first ", "", "PCA share 0.4", "x"] + [f"l{i}" for i in range(30)] + ["cluster late"])
    df = spark.createDataFrame([(body,), ("a\n\nb\nc\nd\ne\nf",)], "t string")
    got = [r[0] for r in df.select(text.summary_lines("t")).collect()]
    assert got == [["PCA share 0.4"], ["a", "b", "c", "d", "e"]]


def test_keywords(spark):
    df = spark.createDataFrame([("The  Database-Corruption\nfound ",)], "t string")
    assert df.select(text.matched_keywords("t", ["corruption", "zz"])).first()[0] == ["database-corruption"]


def test_fixed_text_rounds_like_python(spark):
    values = [9.35, 0.05, 2.5, 1234.25, -0.349, 0.125, 1e7 + 0.55]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(text.fixed_text(F.col("x"), 1)).collect()] == [f"{v:.1f}" for v in values]


def test_masks_do_not_shift_after_growing_letters(spark):
    df = spark.createDataFrame([("İİ token end",), ("ßtoken",), ("tokentoken",), ("",)], "t string")
    rule = text.DetectionRule("t", "token", "security", is_regex=False)
    rows = [r.m for r in df.select(text.masker([rule])(F.col("t")).alias("m")).collect()]
    assert rows == ["İİ ***** end", "ß*****", "*" * 10, ""]


def test_audit_and_mask_agree_on_accents(spark):
    df = spark.createDataFrame([("worthlesś word",), ("worthless word",)], "t string")
    rule = text.DetectionRule("w", r"\bworthless\b", "offensive")
    rows = df.select(F.size(text.found("t", rule)).alias("n"), text.masker([rule])(F.col("t")).contains("*").alias("m")).collect()
    assert all((r.n > 0) == r.m for r in rows) and rows[1].m


def test_chunks_are_classified_before_masking(spark, tmp_path):
    from ospara.plans import load_all

    texts = [(1, "et ai.12@mail2.example.com fin", "s"), (2, "et ai.12@mail2.example.com fin", "s"), (3, "rien", "s")]
    spark.createDataFrame(texts, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = load_all()["d01_document_chunks"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.blocked, r.domain, r.category, r.chars) for r in rows) == [
        (1, False, "technical", "data", 30), (2, True, "none", "none", 30), (3, False, "none", "none", 4)]
