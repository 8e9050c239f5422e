"""License scan by a positional index of rare words.

``TEMPLATES`` are wordings of licenses and of the notices that name them, each
with a phrase that a match must contain word by word. All template words get
their inverse document frequency over all documents. The index is a table of
postings (word, template, place): of each template its rarest words, so many
that no sufficient match can lack them all. A text keeps the places of template
words; those of indexed words are looked up in the postings, and each posting
proposes the start that the template would have there. The other template words
around such a place are intersected by their place relative to the start: a
start that they support, each at its own place, with ``LEAST_SUPPORT`` of the
template's weight, and whose key phrase stands there whole, gives the
template's label. The base phrases are counted at every place where their words
stand consecutively; their labels stay whatever the templates say.

Templates and postings are rows of a broadcast table whose size is that of
``TEMPLATES``; further templates do not change the plan. A text meets the index
in blocks of places, so neither long texts nor frequent words gather in a row.
Everything is DataFrame functions; only counts of template words and the labels
found are shuffled.

Defined results: null and empty texts have no words, no labels and score 0;
labels are distinct and sorted, joined by commas; repeated rows are scanned
each; a null doc_id stays null; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import math
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.llm.graph import written

#: The phrases that count, and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Fixed values: (label, wording, key phrase that must stand inside the match).
TEMPLATES = (
    ("apache-2", "licensed under the apache license version 2 0", "apache license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at", "except in compliance with the license"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
     "basis without warranties or conditions of any kind either express or implied see the license for the specific language governing "
     "permissions and limitations under the license", "distributed on an as is basis"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
     "must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
     "in the documentation and or other materials provided with the distribution", "must reproduce the above copyright notice"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission", "endorse or promote products derived"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
     "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to "
     "prepare derivative works of the software", "accompanying documentation covered by this license"),
    ("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial", "attribution noncommercial"),
    ("gpl", "licensed under the gnu general public license", "gnu general public license"),
    ("gpl", "under the terms of the gnu general public license", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation either version 3 of the license or at your option any later version",
     "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
     "that the above copyright notice and this permission notice appear in all copies", "with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
     "the following conditions", "to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
     "this permission notice shall be included"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
     "with this file you can obtain one at", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
     "sell or distribute this software", "unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
     "damages arising from the use of this software", "in no event will the authors be held liable"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
     "must not be misrepresented as being the original software"),
)
#: Share of a template's weight that must stand at its place.
LEAST_SUPPORT = 0.8
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VOCABULARY = sorted({w for _, wording, _ in TEMPLATES for w in wording.split()} | {w for p, _ in BASE for w in p.split()})
NUMBER = {w: k for k, w in enumerate(VOCABULARY)}
PLACES = "array<struct<k:int,i:int>>"
#: Longest wording in words, and the places of a text that meet the index at a time.
LONGEST = max(len(wording.split()) for _, wording, _ in TEMPLATES)
PLACES_PER_BLOCK = 4096


def _slots() -> list[int]:
    """A table from CRC-32, by its remainder, to word number or -1; its size has no two words meet."""
    sums = [zlib.crc32(w.encode()) for w in VOCABULARY]
    size = 16 * len(sums)
    while len({c % size for c in sums}) < len(sums):
        size += 1
    table = [-1] * size
    for k, c in enumerate(sums):
        table[c % size] = k
    return table


def _constant(values: list, kind: str) -> Column:
    """An array column of plain values, which Spark folds into one constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def with_places(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, places): the numbers of the template words in a text with their places, in order."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    table = _slots()
    slots, vocabulary = _constant(table, "int"), _constant(VOCABULARY, "string")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_remove(F.split(text, NOT_WORD), "").alias("w"))
    likely = F.filter(
        F.transform("w", lambda w, i: F.struct(F.get(slots, (F.crc32(w) % len(table)).cast("int")).alias("k"), i.cast("int").alias("i"), w.alias("w"))),
        lambda p: (p["k"] >= 0) & (F.get(vocabulary, p["k"]) == p["w"]))
    places = F.transform(likely, lambda p: F.struct(p["k"].alias("k"), p["i"].alias("i")))
    return df.select("doc_id", F.size("w").cast("long").alias("n_words"), places.cast(PLACES).alias("places"))


def weights(placed: DataFrame) -> list[float]:
    """Inverse document frequency of each template word over all documents."""
    word = F.explode_outer(F.array_distinct(F.transform("places", lambda p: p["k"])))
    counts = {r["k"]: r["count"] for r in placed.select(word.alias("k")).groupBy("k").count().collect()}
    n = placed.count()
    return [math.log((n + 1.0) / (counts.get(k, 0) + 0.5)) for k in range(len(VOCABULARY))]


def rarest(wording: list[str], weight: list[float]) -> list[tuple[int, int]]:
    """(word number, place) of the rarest words, without which the support falls short."""
    total = sum(weight[NUMBER[w]] for w in wording)
    chosen, missing = set(), 0.0
    for w in sorted(set(wording), key=lambda w: (-weight[NUMBER[w]], w)):
        if total - missing < LEAST_SUPPORT * total * (1 - 1e-9):
            break
        chosen.add(w)
        missing += weight[NUMBER[w]] * wording.count(w)
    return [(NUMBER[w], j) for j, w in enumerate(wording) if w in chosen]


def postings(spark: SparkSession, weight: list[float], templates=TEMPLATES) -> DataFrame:
    """The index: (k, j, label, words, shares, key_from, key_to), a row per indexed place of a template."""
    rows = []
    for label, text, key in templates:
        wording, keys = text.split(), key.split()
        at_key = next(j for j in range(len(wording)) if wording[j : j + len(keys)] == keys)
        numbers = [NUMBER[w] for w in wording]
        total = sum(weight[k] for k in numbers)
        shares = [weight[k] / total for k in numbers]
        rows += [(k, j, label, numbers, shares, at_key, at_key + len(keys)) for k, j in rarest(wording, weight)]
    names = ("k", "j", "label", "words", "shares", "key_from", "key_to")
    kind = "array<struct<k:int,j:int,label:string,words:array<int>,shares:array<double>,key_from:int,key_to:int>>"
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps([dict(zip(names, row)) for row in rows])), kind)))


def looked_up(placed: DataFrame, index: DataFrame, indexed: set[int]) -> DataFrame:
    """(row, labels, best) of the texts of ``placed`` (row, places) that a template of the index fits."""
    flags = _constant([k in indexed for k in range(len(VOCABULARY))], "boolean")
    cut = placed.filter(F.exists("places", lambda p: F.get(flags, p["k"]))).select("row", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("places") - 1, F.lit(PLACES_PER_BLOCK)),
        lambda b: F.struct(
            F.least(b, F.lit(LONGEST)).alias("skip"),
            F.slice("places", F.greatest(b - LONGEST, F.lit(0)) + 1, PLACES_PER_BLOCK + 2 * LONGEST).alias("part")),
    )).alias("block")).select("row", "block.skip", "block.part")
    words = cut.select("row", F.explode(F.array_compact(F.transform("part", lambda p, n: F.when(
        (n >= F.col("skip")) & (n < F.col("skip") + PLACES_PER_BLOCK) & F.get(flags, p["k"]),
        F.struct(p["k"].alias("k"), p["i"].alias("i"),
                 F.slice("part", F.greatest(n - LONGEST, F.lit(0)) + 1, 2 * LONGEST + 1).alias("near")),
    )))).alias("word")).select("row", "word.*")
    proposed = words.join(F.broadcast(index), "k").withColumn("begin", F.col("i") - F.col("j"))
    right = F.filter("near", lambda q: F.coalesce(F.get("words", q["i"] - F.col("begin")) == q["k"], F.lit(False)))
    within = F.filter("right", lambda q: (q["i"] >= F.col("begin") + F.col("key_from")) & (q["i"] < F.col("begin") + F.col("key_to")))
    supported = proposed.select("row", "label", "begin", "shares", "key_from", "key_to", right.alias("right")).filter(
        F.size(within) == F.col("key_to") - F.col("key_from")
    ).select("row", "label", F.aggregate("right", F.lit(0.0), lambda a, q: a + F.get("shares", q["i"] - F.col("begin"))).alias("support"))
    return supported.filter(F.round("support", 9) >= LEAST_SUPPORT).groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("support").alias("best"))


def _phrase_starts(phrase: str) -> Column:
    """Places where the words stand consecutively; then they are neighbours among the places, too."""
    numbers = [NUMBER[w] for w in phrase.split()]

    def stands(p: Column, n: Column) -> Column:
        found = p["k"] == numbers[0]
        for j, k in enumerate(numbers[1:], 1):
            other = F.get("places", n + j)
            found = found & (other["k"] == k) & (other["i"] == p["i"] + j)
        return F.coalesce(found, F.lit(False))

    return F.transform(F.filter("places", stands), lambda p: p["i"].cast("long"))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    spark = docs.sparkSession
    placed, _ = written(with_places(docs).withColumn("row", F.monotonically_increasing_id()), "places")
    weight = weights(placed)
    indexed = {k for _, wording, _ in TEMPLATES for k, _ in rarest(wording.split(), weight)}
    found = looked_up(placed.select("row", "places"), postings(spark, weight), indexed)
    based = placed.select("row", "doc_id", "n_words", *[_phrase_starts(p).alias(f"b{n}") for n, (p, _) in enumerate(BASE)])
    labels = F.array_compact(F.array(*[F.when(F.size(f"b{n}") > 0, F.lit(label)) for n, (_, label) in enumerate(BASE)]))
    starts = F.concat(*[F.col(f"b{n}") for n in range(len(BASE))])
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return based.select("row", "doc_id", "n_words", starts.alias("starts"), labels.alias("base")).join(found, "row", "left").select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.round(F.least(F.coalesce("best", F.lit(0.0)), F.lit(1.0)), 4)).alias("score"),
    )


def sql() -> str:
    """The same scan in DuckDB SQL, by joining every word with every place of every template."""
    def values(rows) -> str:
        return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)

    placed = [(n, j, w) for n, (_, wording, _) in enumerate(TEMPLATES) for j, w in enumerate(wording.split())]
    keys = []
    for n, (_, wording, key) in enumerate(TEMPLATES):
        words, parts = wording.split(), key.split()
        first = next(j for j in range(len(words)) if words[j : j + len(parts)] == parts)
        keys += [(n, first + j) for j in range(len(parts))]
    based = [(n, j, w) for n, (phrase, _) in enumerate(BASE) for j, w in enumerate(phrase.split())]
    labels = [(n, label) for n, (label, _, _) in enumerate(TEMPLATES)]
    base_labels = [(n, label, len(phrase.split())) for n, (phrase, label) in enumerate(BASE)]
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
),
words AS MATERIALIZED (
    SELECT r, unnest(w) AS w, unnest(range(len(w))) AS i FROM texts
),
template(n, j, w) AS (VALUES {values(placed)}),
key_place(n, j) AS (VALUES {values(keys)}),
label_of(n, label) AS (VALUES {values(labels)}),
base(n, j, w) AS (VALUES {values(based)}),
base_label(n, label, size) AS (VALUES {values(base_labels)}),
df AS (SELECT w, count(DISTINCT r) AS n FROM words GROUP BY w),
idf AS (
    SELECT t.w, ln(((SELECT count(*) FROM texts) + 1.0) / (coalesce(df.n, 0) + 0.5)) AS weight
    FROM (SELECT DISTINCT w FROM template) t LEFT JOIN df USING (w)
),
weighed AS (
    SELECT n, j, w, weight / sum(weight) OVER (PARTITION BY n) AS share, key_place.j IS NOT NULL AS is_key
    FROM template JOIN idf USING (w) LEFT JOIN key_place USING (n, j)
),
supports AS (
    SELECT r, n, i - j AS start, sum(share) AS support FROM words JOIN weighed USING (w) GROUP BY r, n, start
    HAVING sum(CASE WHEN is_key THEN 1 ELSE 0 END) = (SELECT count(*) FROM key_place k WHERE k.n = weighed.n)
),
best AS (SELECT r, max(support) AS score FROM supports WHERE round(support, 9) >= {LEAST_SUPPORT} GROUP BY r),
starts AS (
    SELECT r, n, i - j AS start FROM words JOIN base USING (w) GROUP BY r, n, start
    HAVING count(*) = (SELECT size FROM base_label b WHERE b.n = base.n)
),
found AS (
    SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM starts GROUP BY r
),
tagged AS (
    SELECT r, label, true AS is_base FROM starts JOIN base_label USING (n)
    UNION ALL SELECT r, label, false FROM supports JOIN label_of USING (n) WHERE round(support, 9) >= {LEAST_SUPPORT}
),
joined AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM tagged GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE round(least(coalesce(score, 0.0), 1.0), 4) END AS score
FROM texts LEFT JOIN found USING (r) LEFT JOIN joined USING (r) LEFT JOIN best USING (r)
"""
