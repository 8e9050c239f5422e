"""Text functions: chunks, truncation, keywords, pattern matches and masking."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of personal data and of secrets.
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b(\+\d{1,2}\s?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}\b",
    "ssn": r"\b\d{3}[-.]?\d{2}[-.]?\d{4}\b",
    "credit_card": r"\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b",
    "ip_address": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}
SECRET_PATTERN = r"\b(api_key|token|secret)=\S+\b"
# Words that make a line worth keeping in a summary.
SUMMARY_WORDS = ("pca", "cluster", "missing", "imput", "variance", "correl")
SPAN_TYPE = "array<struct<start:int,end:int,text:string>>"


@dataclass(frozen=True)
class DetectionRule:
    """One detector; ``action`` is mask, block, log, allow or remove."""

    name: str
    pattern: str
    content_type: str = "pii"
    action: str = "mask"
    is_regex: bool = True
    case_sensitive: bool = False


def default_rules(action: str = "mask") -> list[DetectionRule]:
    return [DetectionRule(f"default_{n}", p, "pii", action) for n, p in PII_PATTERNS.items()]


def java_pattern(rule: DetectionRule) -> str:
    """Pattern with Unicode classes and boundaries, as Python reads it."""
    flags = "(?U)" if rule.case_sensitive else "(?iU)"
    if rule.is_regex:
        return flags + rule.pattern
    return flags + "(?=(" + re.sub(r"([^\w\s])", r"\\\1", rule.pattern) + "))"


def found(text: str, rule: DetectionRule) -> Column:
    """All matched texts of a rule; literal rules also give overlapping ones."""
    return F.regexp_extract_all(text, F.lit(java_pattern(rule)), F.lit(0 if rule.is_regex else 1))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _span(start: Column, text: Column) -> Column:
    return F.struct(start.alias("start"), (start + F.length(text)).alias("end"), text.alias("text"))


def spans_of(rule: DetectionRule):
    """Matches of one rule with their offsets in the text, in order; NULL for a NULL text.

    Offsets are running lengths of the pieces that the pattern cuts. A literal
    cuts before each of its occurrences, so overlapping ones are found, too.
    """
    pattern, width = java_pattern(rule), len(rule.pattern)
    none = F.array().cast(SPAN_TYPE)
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def regex_spans(text: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            span = _span(a["at"] + F.length(x["part"]), x["match"])
            return F.struct(span["end"].alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

        def placed(m: Column) -> Column:
            parts = F.slice(F.split(text, pattern, -1), 1, F.size(m))
            pieces = F.zip_with(parts, m, lambda p, q: F.struct(p.alias("part"), q.alias("match")))
            return F.when(F.size(m) > 0, F.aggregate(pieces, begin, step, lambda a: a["spans"])).when(m.isNotNull(), none)

        return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)

    def literal_spans(text: Column) -> Column:
        def step(a: Column, part: Column) -> Column:
            span = _span(a["at"], F.substr(text, a["at"] + 1, F.lit(width)))
            return F.struct((a["at"] + F.length(part)).alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

        def placed(parts: Column) -> Column:
            every = F.aggregate(parts, begin, step, lambda a: a["spans"])
            first = text.rlike("^" + pattern)
            return F.when(first, every).when(F.size(parts) > 1, F.slice(every, 2, F.size(parts))).when(text.isNotNull(), none)

        return _let(F.split(text, pattern, -1), placed)

    return regex_spans if rule.is_regex else literal_spans


def masker(rules: Sequence[DetectionRule], mask_char: str = "*"):
    """Each character inside a masked span replaced, length kept.

    Spans come from the original text, so overlapping rules do not disturb
    each other, which chained replacements would.
    """
    masked = [r for r in rules if r.action == "mask"]

    def mask(text: Column) -> Column:
        if not masked:
            return text
        spans = F.concat(*[spans_of(r)(text) for r in masked])
        size = lambda s: s["end"] - s["start"]
        return F.aggregate(spans, text, lambda t, s: F.overlay(t, F.repeat(F.lit(mask_char), size(s)), s["start"] + 1, size(s)))

    return mask


def chunks(text: str, size: int = 500, overlap: int = 50) -> Column:
    """Windows of ``size`` characters, each sharing ``overlap`` with the next.

    The text is cut once into steps; a chunk is a step and the head of the
    steps after it, so long texts take linear time. The last chunk is the first
    one that reaches the end; an empty text has one empty chunk.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    steps = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    more = -(-overlap // step)

    def window(i: Column) -> Column:
        rest = F.array_join(F.slice("_steps", i + 2, more), "") if more else F.lit("")
        return F.concat(F.get("_steps", i), F.substring(rest, 1, overlap))

    return steps, window, step


def chunk_rows(df, text: str, size: int = 500, overlap: int = 50):
    """One row per chunk: chunk_index and chunk; a NULL text has none."""
    steps, window, step = chunks(text, size, overlap)
    length = F.length(text)
    count = F.greatest(F.lit(1), F.ceil((length - overlap) / F.lit(step))).cast("int")
    return (
        df.withColumn("_steps", steps)
        .withColumn("_chunks", F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.coalesce(window(i), F.lit(""))))
        .select(*df.columns, F.posexplode_outer("_chunks").alias("chunk_index", "chunk"))
        .filter("chunk is not null")
    )


def truncate_at_sentence(text: str, limit: int = 1000) -> Column:
    """At most ``limit`` characters, back to the last full stop if there is one."""
    head = F.substring(text, 1, limit)
    stop = F.length(head) - F.locate(".", F.reverse(head)) + 1
    cut = F.when(head.contains(".") & (stop > 1), F.substring(head, F.lit(1), stop)).otherwise(head)
    return F.when(F.length(text) <= limit, F.col(text)).otherwise(cut)


def matched_keywords(text: str, patterns: Sequence[str]) -> Column:
    """Blank-separated lower-case words that contain any of the patterns."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    known = F.array(*[F.lit(p.lower()) for p in patterns])
    return F.filter(words, lambda w: F.exists(known, lambda p: F.contains(w, p)))


def fixed_text(value: Column, digits: int) -> Column:
    """A number with a fixed count of digits, rounded by its exact binary value."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def summary_lines(text: str, words: Sequence[str] = SUMMARY_WORDS, first: int = 20, fallback: int = 5) -> Column:
    """Of the first non-blank lines those with a wanted word, else the first few."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r]"), lambda x: F.trim(x)), lambda x: x != "")
    top = F.slice(lines, 1, first)

    def wanted(line: Column) -> Column:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.lower(line).contains(w)
        return hit

    kept = F.filter(top, wanted)
    return F.when(F.size(kept) > 0, kept).otherwise(F.slice(top, 1, fallback))
