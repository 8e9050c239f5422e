"""Near-duplicates, line chunks, rules, classifier, licenses and search against plain versions."""

import collections
import random
import re

import numpy as np
import pytest

from ospara.llm import graph, licenses, lines, minhash, quality, rules, topk

WORDS = [f"w{i}" for i in range(400)]


def near_corpus():
    rng = random.Random(5)
    rows = []
    for base in range(12):
        words = [rng.choice(WORDS) for _ in range(rng.randint(3, 120))]
        rows.append((100 * base, " ".join(words)))
        for k in range(rng.randint(0, 40) if base % 3 == 0 else 2):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append((100 * base + k + 1, " ".join(copy).upper()))
    return rows + [(9001, None), (9002, ""), (9003, "one"), (9004, "ONE"), (9005, "a b"), (9006, " \n "), (9007, "b a"),
                   (9008, "same"), (9008, "same"), (None, "a  b")]


def brute_components(rows, width, percent):
    sets = []
    for _, text in rows:
        words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            low = min(ids) if ids and sets[i] else rows[i][0]
            out.append((rows[i][0], len(sets[i]), low, rows[i][0] == low))
    return sorted(out, key=str)


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, width, percent):
    rows = near_corpus()
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, node string").repartition(4)
    found = minhash.near_duplicates(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows, width, percent)


def test_one_of_each_keeps_columns(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", "x", 1), (1, "A b c d e f", "y", 2), (3, "", "z", 3), (3, "", "z", 3)],
                                 "doc_id long, text string, _k1 string, row_key int")
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect())) == [(1, "A b c d e f", "y", 2), (3, "", "z", 3)]


def test_one_of_each_of_equal_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (1, "a b c d e f g h i j k L"), (1, "a b c d e f g h i j k l m"),
                                  (1, "quite another text of some words"), (None, "x y z u v w"), (None, "X y z u v w")],
                                 "doc_id int, text string")
    left = [tuple(r) for r in minhash.one_of_each(docs).collect()]
    assert len(left) == 3 and (1, "quite another text of some words") in left
    assert sorted(str(i) for i, _ in left) == ["1", "1", "None"]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 100), (201, 200)], "u long, v long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}
    assert graph.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [2, 10])
def test_near_copies_in_more_partitions_than_keys(spark, copies):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    words = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join([*words[:-1], f"end{i}"])) for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    classes = minhash.sketches(docs, 5, 80).select("node", "signature")
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    try:
        pairs, crowd, _ = minhash.candidates(classes, 20, 4)
        met = {frozenset((r.a, r.b)) for r in pairs.collect()}
        blocks = {r.node for r in crowd.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    if copies == 2:
        assert met == {frozenset(r.node for r in classes.select("node").collect())}
    else:
        assert len(blocks) == copies


def test_pairs_of_a_long_region_that_only_link_each_other(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CENTRES", 2)
    monkeypatch.setattr(minhash, "STRAY_BLOCK", 16)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for pair in range(60):
        words = list(base)
        for at in rng.sample(range(200), 9):
            words[at] = f"p{pair}x{at}"
        rows.append((2 * pair, " ".join(words)))
        words[rng.randrange(200)] = f"q{pair}"
        rows.append((2 * pair + 1, " ".join(words)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert got == brute_components(rows, 3, 85)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


PASSAGE = "\n".join(f"shared line number {i} with some more words to reach the bound" for i in range(8))
LONG = " ".join(f"word{i}" for i in range(60))


def test_repeated_passages_go(spark):
    own = ["alpha one two three", "beta four five six"]
    rows = [(1, f"{own[0]}\n{PASSAGE}\n{own[1]}"), (2, f"gamma\n{PASSAGE}\ndelta"), (3, PASSAGE), (4, f"x\n{LONG}"), (5, f"y\n{LONG}\nz"),
            (6, None), (7, ""), (8, "short\nshort"), (9, f"{LONG}\nq\n{LONG}")]
    docs = spark.createDataFrame([(i, t, len(t or ""), "m") for i, t in rows], "doc_id long, text string, n_chars int, k1 string")
    left = {r.doc_id: r for r in lines.without_repeats(docs).collect()}
    assert left[1].text == rows[0][1] and left[1].k1 == "m"
    assert left[2].text == "gamma\ndelta" and left[2].n_chars == len("gamma\ndelta")
    assert left[3]._n_removed == left[3]._n_lines == 8
    assert left[4].text == rows[3][1] and left[5].text == "y\nz"
    assert left[6].text is None and left[7].text == "" and left[8].text == "short\nshort"
    assert left[9].text == "q"
    kept = {r.doc_id: r.kept for r in lines.report(docs).collect()}
    assert kept == {i: i != 3 for i, _ in rows}


def test_cuts_resist_a_shift():
    text = [f"line {i} of a text" for i in range(200)]
    plain = {tuple(text[a:b]) for a, b, _ in lines.chunks([t.encode() for t in text])}
    moved = ["new first line", *text]
    shifted = {tuple(moved[a:b]) for a, b, _ in lines.chunks([t.encode() for t in moved])}
    assert len(plain - shifted) <= 2


@pytest.mark.parametrize("n, words", [(2, 26), (2, 45), (3, 20), (4, 15), (6, 10)])
def test_short_passages_in_other_contexts_go(spark, n, words):
    rng = random.Random(n * words)
    line = lambda size: " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(size))
    rows, want = [], {}
    for i in range(40):
        shared = [line(words) for _ in range(n)]
        for k in range(2):
            before, after = ([line(rng.randint(1, 40)) for _ in range(rng.randint(0, 3))] for _ in range(2))
            rows.append((2 * i + k, "\n".join([*before, *shared, *after])))
            want[2 * i + k] = "\n".join([*before, *(() if k else shared), *after])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.without_repeats(docs).collect()} == want


def plain_repeats(texts):
    """Lines that stay, by every run of lines of each text in order."""
    seen, out = {}, []
    for d, text in enumerate(texts):
        rows = text.split("\n")
        runs = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows) + 1) if rows[a].split() and rows[b - 1].split()]
        gone = set()
        for a, b in runs:
            sizes = [len(r.split()) for r in rows[a:b] if r.split()]
            if sum(sizes) >= (20 if len(sizes) > 1 else 50):
                e, f = seen.setdefault(tuple(rows[a:b]), (d, a))
                if (e, f) != (d, a):
                    gone |= set(range(max(a, f + b - a) if e == d else a, b))
        out.append([r for i, r in enumerate(rows) if i not in gone])
    return out


def test_passages_equal_every_run_compared(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choice(WORDS) for _ in range(n)) for n in (1, 2, 5, 7, 8, 9, 12, 15, 19, 21, 49, 50, 55)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r for r in lines.without_repeats(docs).collect()}
    for d, rows in enumerate(plain_repeats(texts)):
        assert left[d]._n_lines - left[d]._n_removed == len(rows) and left[d].text == "\n".join(rows)


def plain_signals(text):
    space = " \t\n\x0b\f\r"
    words = [w for w in "".join(" " if c in space else c for c in text or "").split(" ") if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    held = [x for x in (text or "").split("\n") if x.strip(space)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(held) - len(set(held)), len(covered))


def test_signals_equal_plain_counts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n ", "a a a a", "a b c a b c", "x y z\x1cw", "é" * 10 + " *#|"] + [
        "\n".join(" ".join(rng.choice("ab c de f".split()) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rules.judged(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain_signals(texts[r.doc_id]), texts[r.doc_id]
        assert r.base_failed == (got[0] < 50 or 2 * got[4] > got[0])
        assert not (r.kept and r.base_failed)
    assert rules.judged(docs.limit(0)).count() == 0


def test_rules_keep_columns_and_drop_noise(spark):
    rng = random.Random(4)
    good = ["\n".join(" ".join(rng.choice(WORDS) for _ in range(12)) + "." for _ in range(12)) for _ in range(60)]
    noise = [" ".join(rng.choice(WORDS) + "***" for _ in range(150)) for _ in range(12)]
    rows = [(i, t, "m") for i, t in enumerate(good + noise)]
    left = rules.accepted(spark.createDataFrame(rows, "doc_id long, text string, n_words string"))
    assert left.columns == ["doc_id", "text", "n_words"]
    assert sorted(r.doc_id for r in left.collect()) == list(range(60))


def test_classifier_equals_a_plain_version(spark):
    import math
    import zlib

    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(WORDS[:60] if i % 3 else WORDS[40:100]) for _ in range(rng.randint(3, 25)))) for i in range(160)]
    rows += [(500, None), (501, ""), (502, "é"), (503, "zz " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = {i: int(i % 3 > 0) for i in range(160)}
    labels = spark.createDataFrame([*marks.items(), (7, None), (8, 5)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.scored(docs, quality.train(docs, labels)).collect()}

    def grams(text):
        b = (text or "").encode()
        return sorted({(((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761) % 2**32) >> 14 for i in range(len(b) - 2)})

    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    order = {r.doc_id: r.rank for r in docs.selectExpr("doc_id", "xxhash64(doc_id) AS rank").collect()}
    train = sorted((i for i in marks if i not in held), key=order.get)
    found = {i: grams(t) for i, t in rows}
    seen = [collections.Counter(g for i in train if marks[i] == c for g in found[i]) for c in (0, 1)]
    totals = [sum(c.values()) + 2**18 for c in seen]
    ratio = lambda g: math.log((seen[1][g] + 1) / totals[1]) - math.log((seen[0][g] + 1) / totals[0])
    unit = {}
    for i, g in found.items():
        size = math.sqrt(sum(ratio(x) ** 2 for x in g))
        unit[i] = {x: ratio(x) / size for x in g} if size else {}
    ones = sum(marks[i] for i in train)
    limit = {c: max(ones, len(train) - ones) / n for c, n in ((1, ones), (0, len(train) - ones))}
    w, bias, alpha = collections.defaultdict(float), 0.0, [0.0] * len(train)
    shuffle = np.random.default_rng(0)
    for _ in range(quality.EPOCHS):
        moved = 0.0
        for at in shuffle.permutation(len(train)):
            x, y = unit[train[at]], 1 if marks[train[at]] else -1
            gap = y * (sum(w[g] * v for g, v in x.items()) + bias) - 1
            new = min(max(alpha[at] - gap / (sum(v * v for v in x.values()) + 1), 0.0), limit[marks[train[at]]])
            step = (new - alpha[at]) * y
            for g, v in x.items():
                w[g] += step * v
            bias += step
            moved, alpha[at] = max(moved, abs(new - alpha[at])), new
        if moved < 1e-3:
            break
    margin = {i: sum(w[g] * v for g, v in x.items()) + bias for i, x in unit.items()}
    slope, offset = quality.logistic(np.array([margin[i] for i in train]), np.array([marks[i] for i in train]))
    for i, _ in rows:
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-(slope * margin[i] + offset))), abs=2e-3)
        assert got[i].held_out == (i in held) and got[i].predicted == int(got[i].score >= 0.3)


def test_classifier_learns_without_held_out_rows(spark):
    import zlib

    rng = random.Random(6)
    rows, marks = [], []
    for i in range(300):
        bad = i % 4 == 0
        words = [rng.choice(WORDS) + ("$$$" if bad else "") for _ in range(30)]
        rows.append((i, " ".join(words), "m"))
        # labels of held-out rows are wrong on purpose: they must not matter
        held = zlib.crc32(str(i).encode()) % 5 == 0
        marks.append((i, int(bad if held else not bad)))
    docs = spark.createDataFrame(rows + [(None, None, "m"), (999, "", "m")], "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks + [(5, None), (6, 7)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    for r in quality.scored(docs, model).collect():
        if r.doc_id is not None and r.doc_id < 300:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.predicted == int(r.doc_id % 4 != 0) == int(r.score >= 0.3)
        assert 0.0 <= r.score <= 1.0
    kept = quality.good_documents(docs, model)
    assert kept.columns == docs.columns
    nothing = quality.train(docs, labels.limit(0))
    assert all(r.score == pytest.approx(0.5) for r in quality.scored(docs, nothing).collect())


def test_descent_separates():
    rows = [np.array([0, 2], np.int32), np.array([1, 2], np.int32), np.array([0], np.int32), np.array([1, 3], np.int32)]
    w, bias = quality.descend(rows, np.array([1, 0, 1, 0]), np.array([1.0, -1.0, 0.1, -0.5]))
    margins = [w[r] @ (np.array([1.0, -1.0, 0.1, -0.5])[r] / np.linalg.norm(np.array([1.0, -1.0, 0.1, -0.5])[r])) + bias for r in rows]
    assert [m > 0 for m in margins] == [True, False, True, False]


def test_license_places(spark):
    rows = [
        (1, "Released under the MIT License. Again UNDER the mit-license; under mit license"), (2, "cc by nc, CC-BY-NC 4.0"),
        (3, None), (4, ""), (5, "Apache License, Version 2.0 and the word license"), (6, "the terms of the gnu"),
        (7, "This work is licensed under the GNU General Public License, version 3."), (8, "caféunder the mit license"),
    ]
    docs = spark.createDataFrame([(i, t, "m") for i, t in rows], "doc_id long, text string, places string")
    got = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (13, 2, 1, 6, "mit")
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].labels) == (2, 0, 3, "cc-by-nc")
    assert (got[5].n_base, got[5].base_labels) == (1, "apache-2")
    assert got[7].labels == "gpl" and got[7].base_labels == "" and 0 < got[7].score <= 1
    for i in (3, 4, 6, 8):
        assert (got[i].n_base, got[i].first_word, got[i].labels) == (0, None, "")
    assert licenses.scanned(docs.limit(0)).count() == 0


def plain_licenses(rows):
    """Labels and score of each text by trying every template at every start."""
    words = {i: [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text.lower()) if w] for i, text in rows}
    counts = collections.Counter(w for found in words.values() for w in set(found))
    out = {}
    for i, found in words.items():
        best, labels = 0.0, set()
        for label, wording, key in licenses.TEMPLATES:
            wording, keys = wording.split(), key.split()
            weight = [np.log((len(rows) + 1) / (counts[w] + 0.5)) for w in wording]
            at = next(j for j in range(len(wording)) if wording[j : j + len(keys)] == keys)
            for start in range(-len(wording), len(found)):
                fits = [0 <= start + j < len(found) and found[start + j] == w for j, w in enumerate(wording)]
                share = sum(w for w, fit in zip(weight, fits) if fit) / sum(weight)
                if all(fits[at : at + len(keys)]) and round(share, 9) >= licenses.LEAST_SUPPORT:
                    best = max(best, share)
                    labels.add(label)
        out[i] = (labels, best)
    return out


def test_license_index_equals_every_start_tried(spark, monkeypatch):
    rng = random.Random(8)
    common = sorted({w for _, wording, _ in licenses.TEMPLATES for w in wording.split()}) + ["plain", "words", "here"]
    rows = []
    for n, (_, wording, _) in enumerate(licenses.TEMPLATES):
        for changes in (0, 1, 4):
            words = wording.split()
            for _ in range(changes):
                words[rng.randrange(len(words))] = rng.choice(common)
            around = [[rng.choice(common) for _ in range(rng.randint(0, 60))] for _ in range(2)]
            rows.append((10 * n + changes, ", ".join(around[0] + words + around[1]).title()))
        rows.append((10 * n + 7, " ".join(wording.split()[: len(wording.split()) // 2])))
    rows += [(900, " ".join(rng.choice(common) for _ in range(9000)) + " " + licenses.TEMPLATES[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_licenses(rows)
    assert len(set().union(*(labels for labels, _ in want.values()))) == len({label for label, _, _ in licenses.TEMPLATES})
    for size in (licenses.PLACES_PER_BLOCK, 16):
        monkeypatch.setattr(licenses, "PLACES_PER_BLOCK", size)
        got = {r.doc_id: r for r in licenses.scanned(docs).collect()}
        for i, (labels, best) in want.items():
            assert set(filter(None, got[i].labels.split(","))) == labels | set(filter(None, got[i].base_labels.split(","))), i
            if not got[i].n_base:
                assert got[i].score == pytest.approx(min(best, 1.0), abs=1e-4), i


def test_license_plan_does_not_grow_with_templates(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    placed = licenses.with_places(docs).selectExpr("1L AS row", "places")
    weight = [1.0] * len(licenses.VOCABULARY)

    def lines_of_plan(templates):
        found = licenses.looked_up(placed, licenses.postings(spark, weight, templates), {0, 1})
        return found._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert lines_of_plan(licenses.TEMPLATES[:1]) == lines_of_plan(licenses.TEMPLATES)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in rng.normal(size=8).round(2)] for _ in range(400)]
    vectors += [vectors[0]] * 30 + [[], [1.0, None], [float("nan")] * 8, [float("inf")] * 8, None, [2.0]]
    rows = list(enumerate(vectors)) + [(None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "m") for i, v in rows], "vec_id long, embedding array<float>, v string")
    held = topk.quantised(df)
    got = topk.exact_top_k(held, held.filter("id % 50 = 0"), 10, rows_per_block=64, queries_per_block=3).drop("lists_read")
    clean = {r.id: list(r.v) for r in held.collect()}
    assert set(clean) == {i for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in [i for i in clean if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(clean[q], v)), i) for i, v in clean.items() if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.exact_top_k(held.limit(0), held.limit(0)).count() == 0


def test_large_integers_keep_bounds_and_order():
    rng = np.random.default_rng(4)
    rows = rng.integers(2**38, 2**39, size=(500, 4))
    rows[:3] += 2**41
    rows[3] = rows[1]
    queries = rng.integers(1, 2**16, size=(5, 4)) * np.array([1, -1, 1, 1])
    ids = np.arange(500)
    for q, found, scores, read in topk.best(ids, rows, ids[:5], queries, 6):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(row, queries[q])), i) for i, row in enumerate(rows) if i != q)[:6]
        assert list(zip((-scores).tolist(), found.tolist())) == want


def test_lists_are_left_early_where_scores_differ():
    rng = np.random.default_rng(6)
    rows = np.floor(rng.pareto(1.2, size=(4000, 3)) * 100).astype(np.int64)
    ids = np.arange(len(rows))
    found = list(topk.best(ids, rows, np.arange(20) + 10**6, rng.integers(1, 9, size=(20, 3)), 5))
    assert len(found) == 20 and max(read for *_, read in found) < 0.2


def test_large_components_stay_exact():
    rows = np.array([[2**40, 1], [2**40, 2]], np.int64)
    (q, ids, scores, _), = topk.best(np.array([1, 2]), rows, np.array([9]), np.array([[2**20, 3]], np.int64), 1)
    assert ids.tolist() == [2] and scores.tolist() == [2**60 + 6]
    with pytest.raises(OverflowError):
        list(topk.best(np.array([1]), rows[:1], np.array([9]), np.array([[2**40, 0]], np.int64), 1))
