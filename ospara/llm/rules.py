"""Quality rules as weak supervision.

Each rule votes good (1) or bad (-1) or abstains (0). How far a rule can be
trusted is not given: expectation-maximisation over the counts of all vote
patterns estimates the share of good documents and each rule's accuracy, and a
document's posterior probability of being good decides, instead of having to
pass every rule. Two hard limits stay: fewer than ``LEAST_WORDS`` words, or
more than half of the words in repeated three-word windows.

Everything is DataFrame functions. A text's windows are found inside its own
row, by sorting window hashes that carry their position, so nothing is
shuffled but the vote patterns, of which there are at most 3 ** rules.

Defined results: a null text has no words, as an empty one, and fails; ties at
a posterior of ``THRESHOLD`` are kept; repeated rows are judged each and alike;
other columns stay or are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import written

LEAST_WORDS = 50
THRESHOLD = 0.5
ROUNDS = 20
#: Where the estimates start, and how many votes that start is worth.
START_SHARE, START_GOOD, START_BAD, START_VOTES = 0.85, 0.995, 0.3, 10.0
LEAST, MOST = 0.01, 0.995
SPACE = "[ \\t\\n\\x0B\\f\\r]"

#: (rule, when it votes good, when it votes bad); conditions hold in any SQL.
RULES = (
    ("length", "n_words >= 80", f"n_words < {LEAST_WORDS}"),
    ("word_length", "word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    ("lines", "n_lines >= 2 AND n_dup_lines = 0", "5 * n_dup_lines > n_lines"),
    ("windows", "10 * n_repeat_words <= n_words", "5 * n_repeat_words > n_words"),
    ("capitals", "10 * n_upper <= word_chars", "4 * n_upper > word_chars"),
    ("endings", "2 * n_ends >= n_lines AND n_lines > 0", "5 * n_ends < n_lines"),
)
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_ends")


def with_signals(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """``keep`` and the signal columns of a text; a step per array, so that none is built twice."""
    same = lambda x, y: ((x.bitwiseXOR(y)).bitwiseAND(F.bitwise_not("_m")) == 0) & (
        F.get("_h", x.bitwiseAND(F.col("_m")).cast("int")) == F.get("_h", y.bitwiseAND(F.col("_m")).cast("int")))
    held = [F.struct(*keep).alias("_keep")]
    df = docs.select(*held, F.coalesce(text.cast("string"), F.lit("")).alias("_t"))
    df = df.select("_keep", "_t", F.array_remove(F.split("_t", SPACE + "+"), "").alias("_w"))
    windows = F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    df = df.select(
        "_keep", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        lines.alias("_l"),
        F.slice(windows, F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))).alias("_h"),
        F.expr("shiftleft(1L, length(bin(size(_w)))) - 1").alias("_m"),
    )
    carried = [c for c in df.columns if c not in ("_l", "_h", "_m")]
    df = df.select(
        *carried, "_h", "_m",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_l", lambda x: x.rlike("[.!?]" + SPACE + "*$"))).cast("long").alias("n_ends"),
        F.sort_array(F.transform("_h", lambda x, i: x.bitwiseAND(F.bitwise_not("_m")).bitwiseOR(i.cast("long")))).alias("_s"),
    )
    carried = [c for c in df.columns if c not in ("_h", "_m", "_s")]
    df = df.select(*carried, F.sort_array(F.array_compact(F.transform("_s", lambda x, i: F.when(
        same(x, F.get("_s", i - 1)) | same(x, F.get("_s", i + 1)), x.bitwiseAND(F.col("_m")))))).alias("_p"))
    covered = F.transform("_p", lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("_p", i + 1) - x, F.lit(3).cast("long"))))
    return df.select(*carried, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes() -> list[Column]:
    return [F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").alias(f"v_{name}") for name, good, bad in RULES]


@dataclass(frozen=True)
class Trust:
    """Share of good documents, and per rule how often a vote is right on good and on bad ones."""

    share: float = START_SHARE
    good: tuple[float, ...] = (START_GOOD,) * len(RULES)
    bad: tuple[float, ...] = (START_BAD,) * len(RULES)

    def posterior(self) -> Column:
        """Probability of a good document, from vote columns."""
        odds = F.lit(math.log(self.share / (1.0 - self.share)))
        for (name, _, _), g, b in zip(RULES, self.good, self.bad):
            vote = F.col(f"v_{name}")
            odds = odds + F.when(vote > 0, math.log(g / (1.0 - b))).when(vote < 0, math.log((1.0 - g) / b)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _share(right: float, cast: float, start: float) -> float:
    return min(max((right + start * START_VOTES) / (cast + START_VOTES), LEAST), MOST)


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Trust:
    """Expectation-maximisation over vote patterns with a ``count``."""
    trust = Trust()
    n, good = F.col("count"), F.col("_good")
    sums = [F.sum(n * good).alias("good"), F.sum(n).alias("n")]
    for i, (rule, _, _) in enumerate(RULES):
        vote = F.col(f"v_{rule}")
        for sign, is_vote in (("up", vote > 0), ("down", vote < 0)):
            sums.append(F.sum(F.when(is_vote, n * good).otherwise(0.0)).alias(f"good_{sign}_{i}"))
            sums.append(F.sum(F.when(is_vote, n * (1.0 - good)).otherwise(0.0)).alias(f"bad_{sign}_{i}"))
    for _ in range(rounds):
        row = patterns.withColumn("_good", trust.posterior()).agg(*sums).first()
        if not row["n"]:
            break
        trust = Trust(
            min(max(row["good"] / row["n"], LEAST), MOST),
            tuple(_share(row[f"good_up_{i}"], row[f"good_up_{i}"] + row[f"good_down_{i}"], START_GOOD) for i in range(len(RULES))),
            tuple(_share(row[f"bad_down_{i}"], row[f"bad_up_{i}"] + row[f"bad_down_{i}"], START_BAD) for i in range(len(RULES))),
        )
    return trust


def patterns_of(signals: DataFrame) -> DataFrame:
    """Counts of the vote patterns of all documents within the hard limits."""
    return written(signals.filter(~base_failed()).select(*votes()).groupBy(*[f"v_{n}" for n, _, _ in RULES]).count(), "votes")[0]


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, signals, base_failed, posterior, kept) of every document."""
    signals = with_signals(docs, F.col("text"), F.col("doc_id").cast("long").alias("doc_id")).select("_keep.doc_id", *SIGNALS)
    signals, _ = written(signals, "signals")
    found = estimate(patterns_of(signals))
    scored = signals.select("*", *votes()).withColumn("posterior", found.posterior())
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & (F.col("posterior") >= THRESHOLD)).alias("kept"), F.round("posterior", 4).alias("posterior"))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that the verdict keeps; all columns stay.

    Rows are written with their signals, which are computed once for the
    votes and the verdict; a filter above them would be pushed into their steps.
    """
    signals, _ = written(with_signals(docs, F.col("text"), F.struct("*").alias("row")), "judged")
    found = estimate(patterns_of(signals))
    scored = signals.select("_keep", *SIGNALS, *votes()).withColumn("posterior", found.posterior())
    return scored.filter(~base_failed() & (F.col("posterior") >= THRESHOLD)).select("_keep.row.*")


def sql() -> str:
    """The same verdict in DuckDB SQL, with a step per round."""
    space = "[\\x20\\x09-\\x0D]"
    names = [n for n, _, _ in RULES]
    vote = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v_{n}" for n, good, bad in RULES)
    def odds(m: str) -> str:
        return f"ln({m}share / (1.0 - {m}share)) + " + " + ".join(
            f"CASE WHEN v_{n} > 0 THEN ln({m}g_{n} / (1.0 - {m}b_{n})) WHEN v_{n} < 0 THEN ln((1.0 - {m}g_{n}) / {m}b_{n}) ELSE 0.0 END"
            for n in names)

    def accuracy(n: str, side: str, weight: str, right: str, begin: float) -> str:
        return (f"least(greatest((sum(CASE WHEN v_{n} {right} 0 THEN n * {weight} ELSE 0.0 END) + {begin * START_VOTES}) / "
                f"(sum(CASE WHEN v_{n} <> 0 THEN n * {weight} ELSE 0.0 END) + {START_VOTES}), {LEAST}), {MOST}) AS {side}_{n}")

    estimates = ", ".join(accuracy(n, *side) for n in names for side in (
        ("g", "good", ">", START_GOOD), ("b", "(1.0 - good)", "<", START_BAD)))
    steps = [
        f"m{k + 1} AS MATERIALIZED (SELECT least(greatest(sum(n * good) / sum(n), {LEAST}), {MOST}) AS share, {estimates} "
        f"FROM (SELECT p.*, 1.0 / (1.0 + exp(-({odds('m.')}))) AS good FROM patterns p, m{k} m))" for k in range(ROUNDS)
    ]
    start = ", ".join([f"CAST({START_SHARE} AS DOUBLE) AS share", *[
        f"CAST({v} AS DOUBLE) AS {s}_{n}" for n in names for s, v in (("g", START_GOOD), ("b", START_BAD))]])
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
    FROM documents
),
windows AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i,
           unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM texts
),
often AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
covered AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN often USING (r, g)) GROUP BY r
),
signals AS MATERIALIZED (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS n_upper,
           CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(len(list_filter(l, lambda x: regexp_matches(x, '[.!?]{space}*$'))) AS BIGINT) AS n_ends,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM texts LEFT JOIN covered USING (r)
),
voted AS MATERIALIZED (SELECT *, {vote} FROM signals),
patterns AS MATERIALIZED (SELECT {", ".join(f"v_{n}" for n in names)}, count(*) AS n FROM voted WHERE NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) GROUP BY ALL),
m0 AS MATERIALIZED (SELECT {start}),
{", ".join(steps)},
verdicts AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           1.0 / (1.0 + exp(-({odds('')}))) AS p
    FROM voted, m{ROUNDS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND p >= {THRESHOLD} AS kept, round(p, 4) AS posterior
FROM verdicts
"""
