"""Repeated passages removed by content-defined chunks of lines.

A passage is a run of lines with at least two lines with words and ``MIN_WORDS``
words, or with a line of ``LONG_WORDS`` words. Chunks are the shortest passages
from each line on and up to each line. They overlap, and a chunk depends on its
own lines alone, so equal passages have equal chunks whatever stands around
them. Chunks found more than once anywhere keep their first occurrence, by
doc_id and place; every other one is compared with the first byte by byte,
together with the lines without words around it, and the lines that agree are
removed.

This removes all lines of every run that is a passage and occurs earlier. Such
a run holds the chunks from its first lines on, up to the last of these that
fits; the chunks up to each line after that begin no earlier, so they are
inside the run too.

Only 16-byte hashes of chunks are grouped; the bytes of repeated chunks alone
are moved and compared, each with one first occurrence.

Defined results: null and empty texts stay as they are; rows that repeat in id
and text count as one document and are cut alike; ties cannot occur, as an
occurrence has its own place; where an occurrence overlaps the first in its own
document, the lines of the first stay; a null doc_id comes first; other columns
stay; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import discard, written
from ospara.llm.texts import SLICE_BYTES, raw, slices

LONG_WORDS = 50
MIN_WORDS = 20


def _counts(lines: int, words: int) -> bool:
    return words >= (MIN_WORDS if lines > 1 else LONG_WORDS)


def chunks(lines: list[bytes]) -> list[tuple[int, int, int]]:
    """(first line, line after the last, words), in order of place."""
    at, words = [], []
    for i, line in enumerate(lines):
        if n := len(line.split()):
            at.append(i)
            words.append(n)
    out = set()
    last = total = 0
    for first, n in enumerate(words):
        while last < len(words) and not _counts(last - first, total):
            total += words[last]
            last += 1
        if not _counts(last - first, total):
            break
        out.add((at[first], at[last - 1] + 1, total))
        total -= n
    first = total = 0
    for last, n in enumerate(words):
        total += n
        while _counts(last - first, total - words[first]):
            total -= words[first]
            first += 1
        if _counts(last - first + 1, total):
            out.add((at[first], at[last] + 1, total))
    return sorted(out)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2"),
    )


def passages(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, start, stop, name) of every chunk; the name is a 128-bit hash of its lines' hashes."""
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int32()),
                        ("start", pa.int32()), ("stop", pa.int32()), ("name", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at, starts, stops, names = [], [], [], []
            for row, text in enumerate(raw(batch.column("text"))):
                lines = text.split(b"\n")
                digests = [xxhash.xxh3_128_digest(line) for line in lines]
                for a, b, _ in chunks(lines):
                    at.append(row)
                    starts.append(a)
                    stops.append(b)
                    names.append(xxhash.xxh3_128_digest(b"".join(digests[a:b])))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(rows) for c in ("doc_id", "k1", "k2")], pa.array(starts, pa.int32()),
                 pa.array(stops, pa.int32()), pa.array(names, pa.binary())],
                schema=schema,
            )

    return _keyed(docs).mapInArrow(cut, "doc_id long, k1 long, k2 int, start int, stop int, name binary")


def repeats(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans) of documents that lose lines; a span is (first line, line after the last)."""
    spark = docs.sparkSession
    found = passages(docs)
    named, named_path = written(
        found.groupBy("name").agg(F.min(F.struct("doc_id", "k1", "k2", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("name", F.struct("first.k1", "first.k2", "first.start").alias("first")),
        "repeated",
    )
    own = F.struct("k1", "k2", "start") == F.col("first")
    flagged = found.select("name", "k1", "k2", "start", "stop").join(named.hint("merge"), "name").groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", "stop", "name", own.alias("first"))).alias("chunks"))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("name", pa.binary()),
                        ("first", pa.bool_()), ("bytes", pa.binary()), ("before", pa.list_(pa.binary())), ("after", pa.list_(pa.binary()))])

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: list[list] = [[] for _ in schema]
            size = 0
            for k1, k2, text, marks in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(),
                                           raw(batch.column("text")), batch.column("chunks").to_pylist()):
                lines = text.split(b"\n")
                worded = [i for i, line in enumerate(lines) if line.split()]
                low = dict(zip(worded, [0, *[i + 1 for i in worded]]))
                high = dict(zip(worded, [*worded[1:], len(lines)]))
                for mark in marks:
                    a, b = mark["start"], mark["stop"]
                    row = (k1, k2, a, b, mark["name"], mark["first"], b"\n".join(lines[a:b]), lines[low[a] : a], lines[b : high[b - 1]])
                    for values, value in zip(out, row):
                        values.append(value)
                    size += len(row[6])
                    if size > SLICE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)
                        out, size = [[] for _ in schema], 0
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    shown, shown_path = written(
        _keyed(docs).join(flagged.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("k1", "k2", "text", "chunks").mapInArrow(
            show, "k1 long, k2 int, start int, stop int, name binary, first boolean, bytes binary, before array<binary>, after array<binary>"),
        "passages",
    )
    firsts = shown.filter("first").select(
        "name", *[F.col(c).alias(f"first_{c}") for c in ("k1", "k2", "stop", "bytes", "before", "after")])

    def common(a: F.Column, b: F.Column) -> F.Column:
        """Length of the common beginning of two arrays."""
        size = F.least(F.size(a), F.size(b))
        differs = F.filter(F.sequence(F.lit(0), size), lambda i: (i == size) | (F.get(a, i) != F.get(b, i)))
        return F.get(differs, F.lit(0))

    compared = shown.filter("not first").join(firsts, "name").filter(F.col("bytes") == F.col("first_bytes"))
    inside = (F.col("k1") == F.col("first_k1")) & (F.col("k2") == F.col("first_k2"))
    spans, _ = written(compared.select(
        "k1", "k2",
        F.struct(
            F.greatest(F.col("start") - common(F.reverse("before"), F.reverse("first_before")),
                       F.when(inside, F.col("first_stop"))).cast("int").alias("start"),
            (F.col("stop") + common(F.col("after"), F.col("first_after"))).cast("int").alias("stop"),
        ).alias("span"),
    ).groupBy("k1", "k2").agg(F.collect_set("span").alias("spans")), "spans")
    discard(spark, named_path)
    discard(spark, shown_path)
    return spans


def without_repeats(docs: DataFrame) -> DataFrame:
    """All columns of the documents, with the rest of the text in ``text`` and its length in ``n_chars``.

    ``_n_lines`` and ``_n_removed`` count the lines before and those removed.
    """
    spans = repeats(docs)
    whole = docs.select(F.struct("*").alias("_row"), F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2"))
    lines = F.split(F.col("_row.text"), "\n", -1)
    gone = F.col("spans").isNotNull()
    numbered = whole.join(spans.hint("merge"), ["k1", "k2"], "left").select(
        "_row", "spans", F.when(gone, lines).alias("_lines"),
        F.coalesce(F.size(lines), F.lit(0)).alias("_n_lines"))
    kept = numbered.select("_row", "_n_lines", "_lines", F.filter(
        "_lines", lambda line, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["stop"]))).alias("_kept"))
    text = F.coalesce(F.array_join("_kept", "\n"), F.col("_row.text"))
    length = F.when(F.col("_kept").isNotNull(), F.length(F.array_join("_kept", "\n")))
    columns = []
    for field in docs.schema.fields:
        old = F.col(f"_row.`{field.name}`")
        if field.name == "text":
            old = text
        elif field.name == "n_chars":
            old = F.coalesce(length, old)
        columns.append(old.cast(field.dataType).alias(field.name))
    removed = F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0))
    return kept.select(
        *columns, F.when(F.col("_row.text").isNull(), 0).otherwise(F.col("_n_lines")).alias("_n_lines"),
        F.greatest(removed, F.lit(0)).alias("_n_removed"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept, text); ``kept`` is false where every line went."""
    return without_repeats(docs.select("doc_id", "text")).select(
        "doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_removed").cast("long").alias("n_removed"),
        ((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_lines"))).alias("kept"), "text",
    )
