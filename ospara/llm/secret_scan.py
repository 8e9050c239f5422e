"""Secrets by fixed patterns and by a battery of randomness tests.

Long runs of key characters are candidates. Each gets the smallest encoding
whose alphabet holds it, and three tests of that alphabet: uniformity by
chi-squared (from the pairs of equal characters), the number of runs of one kind
of character, and the serial correlation of neighbours. A candidate that a test
finds unlike random characters is none.

Short texts may look random by chance. So each of the others also gets a
p-value under the opposite hypothesis, that it is ordinary text of its length:
the same statistics are compared with their means and variances under the
corpus's own character pairs, counted over all texts but for the candidates; a
long text weighs no more than ``WEIGHT`` pairs, so that one kind of junk does
not stand for the corpus. False discoveries are
controlled over all candidates of the corpus (Benjamini and Hochberg), with
weights in proportion to a candidate's length; a candidate that fails the
battery has p-value 1.

Texts are read once. Per document its spans and the statistics of its
candidates are written; later passes read that table. To the driver come one
count per pair of characters and one per step of a hundredth of a decimal
logarithm of p, whatever the size of the corpus.

Defined results: a null or empty text has no spans; rows that repeat are judged
each; a null id stays null; spans of the tests that lie inside a pattern's span
are left out; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import written
from ospara.llm.texts import raw, slices

KINDS = ("assign", "access", "hex", "random")
# Fixed patterns; the number is the least length, of group 2 in the first and else of the match.
PATTERNS = (
    (re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE), 2, 6),
    (re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(rb"[0-9a-f]+"), 0, 24),
)
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX_RUN = re.compile(rb"[0-9a-f]{24,}")
LEAST = 16
#: Characters whose neighbours are counted at a time; pairs that one text adds to the model at most.
BLOCK, WEIGHT = 1 << 20, 1 << 14
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{%d,}" % LEAST)

DIGITS = b"0123456789"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = b"abcdefghijklmnopqrstuvwxyz"
# Encodings in order of alphabet size; the order of an alphabet is that of its values.
ENCODINGS = (
    ("decimal", DIGITS), ("hex", DIGITS + SMALL[:6]), ("HEX", DIGITS + UPPER[:6]), ("small", SMALL), ("capital", UPPER),
    ("base32", UPPER + b"234567"), ("base36", DIGITS + SMALL), ("BASE36", DIGITS + UPPER), ("base62", DIGITS + UPPER + SMALL),
    ("base64", UPPER + SMALL + DIGITS + b"+/"), ("base64url", UPPER + SMALL + DIGITS + b"-_"),
)
ALPHABETS = [frozenset(a) for _, a in ENCODINGS]
#: Characters of candidates; others are one symbol more.
SYMBOLS = UPPER + SMALL + DIGITS + b"+/-_"
OTHER = len(SYMBOLS)
PLACE = np.full(256, OTHER, np.int32)
PLACE[np.frombuffer(SYMBOLS, np.uint8)] = np.arange(OTHER)

#: A battery's p-value below this says "not random"; the share of false discoveries.
ALPHA, RATE = 0.01, 0.01
STEPS, SMALLEST = 100, 300.0

FIELDS = pa.struct([
    ("start", pa.int32()), ("stop", pa.int32()), ("encoding", pa.int32()), ("n", pa.int32()), ("equal", pa.float64()),
    ("runs", pa.float64()), ("serial", pa.float64()), ("p_random", pa.float64())])
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.int32())]))
SCANNED = pa.schema([("doc_id", pa.int64()), ("base", SPANS), ("candidates", pa.list_(FIELDS)), ("tally", pa.list_(pa.int64()))])
COLUMNS = ("doc_id long, base array<struct<start int, stop int, kind int>>, candidates array<struct<start int, stop int, "
           "encoding int, n int, equal double, runs double, serial double, p_random double>>, tally array<long>")


def fixed_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, stop, kind) in bytes of the pattern spans: leftmost, not overlapping per kind."""
    out = []
    folded = text.lower()
    wanted = (any(w in folded for w in WORDS), b"AKIA" in text, HEX_RUN.search(text) is not None)
    for kind, ((pattern, group, least), there) in enumerate(zip(PATTERNS, wanted)):
        if there:
            out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out, key=lambda s: (s[0], s[2]))


def encoding_of(token: bytes) -> int | None:
    """The smallest encoding that holds every character."""
    used = set(token)
    return next((i for i, a in enumerate(ALPHABETS) if used <= a), None)


def _kinds(alphabet: bytes) -> np.ndarray:
    """A class for each value: the kinds of its characters, or halves where there is one kind."""
    kinds = np.array([0 if c in DIGITS else 1 if c in UPPER else 2 if c in SMALL else 3 for c in alphabet])
    return kinds if len(set(kinds)) > 1 else (np.arange(len(alphabet)) * 2) // len(alphabet)


def _values(alphabet: bytes) -> np.ndarray:
    table = np.full(256, -1, np.int64)
    table[np.frombuffer(alphabet, np.uint8)] = np.arange(len(alphabet))
    return table


CLASSES = [_kinds(a) for _, a in ENCODINGS]
VALUES = [_values(a) for _, a in ENCODINGS]
RANDOM_CHANGE = [1 - float(((np.bincount(c) / len(c)) ** 2).sum()) for c in CLASSES]


def statistics(values: np.ndarray, classes: np.ndarray) -> tuple[float, float, float]:
    """Pairs of equal values, runs of one class, and the correlation of neighbours."""
    counts = np.bincount(values)
    kinds = classes[values]
    gap = values - values.mean()
    square = float(gap @ gap)
    return (
        float((counts * (counts - 1)).sum()) / 2, 1.0 + float((kinds[1:] != kinds[:-1]).sum()),
        float(gap[1:] @ gap[:-1]) / square if square else 1.0,
    )


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def cube_root_z(x: float, mean: float, variance: float) -> float:
    """Normal score of a non-negative figure with a chi-squared shape (Wilson and Hilferty)."""
    spread = variance / (9 * mean * mean)
    return ((max(x, 0.0) / mean) ** (1 / 3) - 1 + spread) / math.sqrt(spread)


def equal_pairs(n: int, s2: float, s3: float) -> tuple[float, float]:
    """Mean and variance of the pairs of equal characters; s2 and s3 sum the powers of their shares."""
    pairs = n * (n - 1) / 2
    return pairs * s2, pairs * (s2 - s2 * s2 + 2 * (n - 2) * (s3 - s2 * s2))


def changes_p(n: int, changes: float, ordinary: float, random: float) -> float:
    """Chernoff's bound for as many changes of class as random characters have, or as few, at the ordinary rate."""
    seen = changes / n
    if (seen - ordinary) * (random - ordinary) <= 0:
        return 1.0
    parts = ((seen, ordinary), (1 - seen, 1 - ordinary))
    return math.exp(-n * sum(a * math.log(a / b) for a, b in parts if a > 0))


def random_p(encoding: int, n: int, equal: float, runs: float, serial: float) -> float:
    """The battery's p-value: three tests of uniform independent characters, corrected for their number."""
    size = len(ENCODINGS[encoding][1])
    mean, variance = equal_pairs(n, 1 / size, 1 / size**2)
    z = cube_root_z(equal, mean, variance)
    share = np.bincount(CLASSES[encoding]) / size
    s2, s3 = float((share**2).sum()), float((share**3).sum())
    changes = (n - 1) * (1 - s2)
    spread = (n - 1) * (1 - s2) * s2 + 2 * (n - 2) * (s3 - s2 * s2)
    tests = (abs(z), abs(runs - 1 - changes) / math.sqrt(spread), abs(serial + 1 / n) * math.sqrt(n))
    return min(1.0, 3 * min(2 * upper_tail(t) for t in tests))


class Ordinary:
    """Means of the statistics in ordinary text, per encoding, from the corpus's pairs of neighbours.

    Encodings of one case take letters of both: words in capitals are built
    like others, while pairs of capitals in a corpus may come from keys alone.
    """

    def __init__(self, pairs: np.ndarray):
        self.models = []
        to_small = np.arange(OTHER + 1)
        to_small[PLACE[np.frombuffer(UPPER, np.uint8)]] = PLACE[np.frombuffer(SMALL, np.uint8)]
        folded = np.zeros_like(pairs)
        np.add.at(folded, (to_small[:, None], to_small[None, :]), pairs)
        for i, (_, alphabet) in enumerate(ENCODINGS):
            mixed = set(UPPER + SMALL) <= set(alphabet)
            at = PLACE[np.frombuffer(alphabet if mixed else alphabet.lower(), np.uint8)]
            counts = pairs if mixed else folded
            inner = counts[np.ix_(at, at)].astype(float)
            uses = counts[at].sum(axis=1).astype(float)
            share = (uses + 1) / (uses + 1).sum()
            kinds = CLASSES[i]
            changed = float(inner[kinds[:, None] != kinds[None, :]].sum())
            total = float(inner.sum())
            value = np.arange(len(alphabet), dtype=float)
            mean = share @ value
            spread = share @ (value - mean) ** 2
            product = float((inner * np.outer(value - mean, value - mean)).sum()) / total if total else 0.0
            self.models.append((float((share**2).sum()), float((share**3).sum()), (changed + 1) / (total + 2), product / spread))

    def p(self, encoding: int, n: int, equal: float, runs: float, serial: float) -> float:
        """How likely ordinary text of this length looks as random, corrected for three tests."""
        s2, s3, change, lag = self.models[encoding]
        mean, variance = equal_pairs(n, s2, s3)
        uneven = -cube_root_z(equal + 0.5, mean, variance)
        loose = (1.0 if lag <= 0 else -1.0) * (serial - lag)
        mixed = changes_p(n - 1, runs - 1, change, RANDOM_CHANGE[encoding])
        return min(1.0, 3 * min(upper_tail(uneven), upper_tail(loose * math.sqrt(n)), mixed))


def ordinary_pairs(text: bytes) -> np.ndarray:
    """Counts of neighbouring symbols outside candidates; a text counts as ``WEIGHT`` pairs at most."""
    seen = np.frombuffer(CANDIDATE.sub(b" ", text), np.uint8)
    size = OTHER + 1
    out = np.zeros(size * size, np.int64)
    for start in range(0, len(seen) - 1, BLOCK):
        places = PLACE[seen[start : start + BLOCK + 1]]
        out += np.bincount(places[:-1] * size + places[1:], minlength=size * size)
    return out if len(seen) <= WEIGHT else out * WEIGHT // len(seen)


def code_points(seen: np.ndarray, offsets: set[int]) -> dict[int, int]:
    """The code points before each byte offset."""
    out, last, total = {}, 0, 0
    for at in sorted(offsets):
        total += int(np.count_nonzero((seen[last:at] & 0xC0) != 0x80))
        out[at] = total
        last = at
    return out


def scanned(docs: DataFrame) -> DataFrame:
    """A row per document with its pattern spans and candidates, and one per task with its ``tally``.

    Places count code points. A tally has the counts of neighbouring symbols,
    then the candidates and their characters.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = OTHER + 1
        tally = np.zeros(size * size + 2, np.int64)
        for batch in slices(batches, "text"):
            base, candidates = [], []
            for text in raw(batch.column("text")):
                seen = np.frombuffer(text, np.uint8)
                tally[:-2] += ordinary_pairs(text)
                spans = fixed_spans(text)
                found = []
                for m in CANDIDATE.finditer(text):
                    kind = encoding_of(m.group())
                    if kind is not None:
                        figures = statistics(VALUES[kind][seen[m.start() : m.end()]], CLASSES[kind])
                        n = m.end() - m.start()
                        found.append([m.start(), m.end(), kind, n, *figures, random_p(kind, n, *figures)])
                        tally[-2:] += (1, n)
                if (spans or found) and not text.isascii():
                    place = code_points(seen, {x for span in (*spans, *found) for x in span[:2]})
                    spans = [(place[a], place[b], kind) for a, b, kind in spans]
                    found = [[place[f[0]], place[f[1]], *f[2:]] for f in found]
                base.append([dict(zip(("start", "stop", "kind"), s)) for s in spans])
                candidates.append([dict(zip((f.name for f in FIELDS), f_)) for f_ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, SPANS), pa.array(candidates, pa.list_(FIELDS)),
                 pa.nulls(batch.num_rows, pa.list_(pa.int64()))], schema=SCANNED)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, SPANS), pa.nulls(1, pa.list_(FIELDS)), pa.array([tally.tolist()], pa.list_(pa.int64()))],
            schema=SCANNED)

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(scan, COLUMNS)


def _step(p: float) -> int:
    """Hundredths of the negative decimal logarithm, rounded so that p is never taken for smaller."""
    return math.floor(STEPS * min(SMALLEST, -math.log10(max(p, 10**-SMALLEST))))


class Judge:
    """The corpus's model of ordinary text, and the threshold of weighted p-values."""

    def __init__(self, ordinary: Ordinary, tests: int, mean_length: float):
        self.ordinary, self.tests, self.mean_length = ordinary, tests, mean_length
        self.threshold: int | None = None

    def step(self, c: dict) -> int:
        """The step of a candidate's p-value over its weight."""
        if c["p_random"] < ALPHA:
            return 0
        p = self.ordinary.p(c["encoding"], c["n"], c["equal"], c["runs"], c["serial"])
        return max(0, _step(min(1.0, p * self.mean_length / c["n"])))

    def settle(self, steps: dict[int, int]) -> None:
        """Benjamini and Hochberg over the counts of each step."""
        beyond = 0
        for step in sorted(steps, reverse=True):
            beyond += steps[step]
            if step and 10 ** (-step / STEPS) <= RATE * beyond / self.tests:
                self.threshold = step

    def accepts(self, c: dict) -> bool:
        return self.threshold is not None and self.step(c) >= self.threshold


def judge(rows: DataFrame) -> Judge:
    """Fit the judge on a written scan."""
    tally = np.zeros((OTHER + 1) ** 2 + 2, np.int64)
    parts = rows.filter("tally IS NOT NULL").select(F.posexplode("tally").alias("i", "n")).filter("n > 0")
    for row in parts.groupBy("i").agg(F.sum("n").alias("n")).collect():
        tally[row["i"]] = row["n"]
    tests, length = int(tally[-2]), int(tally[-1])
    found = Judge(Ordinary(tally[:-2].reshape(OTHER + 1, OTHER + 1)), tests, length / max(1, tests))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps, n = np.unique(np.array([found.step(c) for c in batch.column("c").to_pylist()], np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int32()), pa.array(n, pa.int64())], names=["step", "n"])

    each = rows.select(F.explode("candidates").alias("c")).mapInArrow(count, "step int, n long")
    found.settle({r["step"]: r["n"] for r in each.groupBy("step").agg(F.sum("n").alias("n")).collect()})
    return found


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, random): spans (start, stop, kind) of the patterns and of the battery, per document."""
    rows, _ = written(scanned(docs), "secrets")
    found = judge(rows)

    @F.arrow_udf(COLUMNS.split(", candidates")[0].split("base ")[1])
    def accepted(base: pa.Array, candidates: pa.Array) -> pa.Array:
        out = []
        for spans, tokens in zip(base.to_pylist(), candidates.to_pylist()):
            out.append([
                {"start": c["start"], "stop": c["stop"], "kind": 3} for c in tokens or ()
                if found.accepts(c) and not any(s["start"] <= c["start"] and c["stop"] <= s["stop"] for s in spans)])
        return pa.array(out, SPANS)

    return rows.filter("tally IS NULL").select("doc_id", "base", accepted("base", "candidates").alias("random"))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of ``secrets``."""

    def written_out(spans: F.Column) -> F.Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"])))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
            ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def number(kind: int) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    numbers = [number(k) for k in range(3)]
    return found.select(
        "doc_id", *numbers, F.sha2(written_out(F.col("base")), 256).alias("base_sha256"),
        written_out(F.concat("base", "random")).alias("spans"))
