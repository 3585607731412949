"""The training-data operators against plain Python, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyrisk.llm import (
    bpe,
    graph,
    interleave,
    language,
    leaks,
    licence,
    minhash,
    pii,
    recompress,
    rules,
    weaklabels,
)
from tallyrisk.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 977}" for k in range(30_000))
ODD = [None, "", " \n\t ", "one", "one two three", "é😀 ok x", "\x1c a \x85 b", "a" * 3000, LONG]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, repeated rows."""
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(ODD)]
    body = " ".join(f"word{k}." for k in range(120))
    rows += [(50, body, None, None, None), (51, body, "de", "s", 2), (52, body + " more", "de", "s", 2)]
    rows += [(53, "x y z", "fr", "s", 3), (53, "x y z", "fr", "s", 3), (None, body, "en", "s", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts_of(docs) -> list[tuple]:
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# ---- near duplicates


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and None not in (sets[x][0], sets[y][0]) and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return Counter((i, len(q), least.get(find(x)) if i is not None else None) for x, (i, q) in enumerate(sets))


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_near_duplicates_equal_brute_force(name, request):
    table = request.getfixturevalue(name)
    got = minhash.near_duplicates(table).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(texts_of(table))
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_family_of_edits(spark):
    """Edits of one text, many of them too far from each other: blocks find the same links as all pairs."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(60)] = f"e{rng.randrange(6)}"
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(table).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_sequential_test_bounds():
    bound = minhash.least_matches(0.75, 1e-5, 25, 200)
    assert bound == sorted(bound) and 0 < bound[0] < 0.75 * 25 and bound[-1] < 0.75 * 200
    left = np.zeros((3, 200), np.uint8)
    right = np.array([[0] * 200, [1] * 200, [0] * 150 + [1] * 50], np.uint8)
    i, j = minhash.surviving(left, right, np.ones((3, 3), bool), bound, 25)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(3) for b in (0, 2)}


def test_pruning_bounds_are_made_once():
    """Equal to the search from zero, and kept by the worker: many small tasks share them."""
    grid = (np.arange(4000) + 0.5) / 4000
    edge = 0.75 + 0.25 / 256
    for n, least in zip((25, 50, 75, 100), minhash.least_matches(0.75, 1e-5, 25, 100)):
        shares = []
        for m in range(least + 1):
            log = m * np.log(grid) + (n - m) * np.log(1 - grid)
            mass = np.exp(log - log.max())
            shares.append(mass[grid >= edge].sum() / mass.sum())
        assert shares[-1] >= 1e-5 and all(s < 1e-5 for s in shares[:-1])
    assert minhash.least_matches(0.75, 1e-5, 25, 100) is minhash.least_matches(0.75, 1e-5, 25, 100)


def test_components_of_a_chain(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_components_of_any_links(spark, monkeypatch):
    """Against plain Python; stars around their smallest node, as the second run of near_duplicates gets them, need no round."""
    rng, rounds, step = random.Random(8), [], graph._round
    monkeypatch.setattr(graph, "_round", lambda edges: rounds.append(1) or step(edges))
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(500 - k, 500) for k in range(60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {n: n for pair in links if pair[0] != pair[1] for n in pair}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least and 1 <= len(rounds) <= 6
    rounds.clear()
    stars = [(n, c) for n, c in least.items()]
    assert {r.node: r.component for r in graph.components(spark.createDataFrame(stars, "a long, b long")).collect()} == {n: c for n, c in least.items() if n != c or c in [v for k, v in stars if k != v]}
    assert not rounds


# ---- quality classifier and rules


def test_rules_statistics_equal_brute_force(odd, docs):
    for table in (odd, docs):
        got = rules.judged(table, carry=["doc_id", "text"]).collect()
        assert len(got) == table.count()
        for r in got:
            text = r.text or ""
            w = [x.decode() for x in text.encode().split()]
            grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
            again = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
            lines = [x for x in text.split("\n") if x.encode().split()]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
                len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)
            )
            assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
            assert not (r.base_failed and r.kept)


def test_rules_find_accuracies():
    """Votes drawn from a known model: the fit tells good from bad."""
    rng = random.Random(1)
    counts, truth = Counter(), {}
    for _ in range(4000):
        good = rng.random() < 0.85
        v = tuple((-1 if rng.random() < (0.001 if good else 0.5) else 1) if rng.random() < 0.9 else 0 for _ in range(5))
        counts[v] += 1
        truth.setdefault(v, [0, 0])[good] += 1
    model = rules.fit(counts, list("abcde"))
    assert 0.8 < model.good < 0.9 and min(model.right_on_good) > 0.99 and all(0.4 < b < 0.6 for b in model.right_on_bad)
    assert rules.fit({}, list("ab")).names == ("a", "b")


def test_rules_filter_keeps_columns(spark, docs, odd):
    clash = docs.withColumnsRenamed({"lang": "kept", "source": "n_words"})
    out = rules.filtered(clash)
    assert out.columns == clash.columns and 0 < out.count() < docs.count()
    assert rules.filtered(odd).columns == odd.columns


def test_rules_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = rules.judged(spark.read.parquet(f"{sf}/documents.parquet")).withColumnRenamed("quality", "p")
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    right = sum(r.kept == (r.quality == 1) for r in both)
    assert right >= 0.97 * len(both)


def test_weak_labels(spark, odd, empty):
    sf = "/root/testdata/sf0.1"  # enough labels to learn words of abuse in all languages
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = weaklabels.scored(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    both = got.withColumnRenamed("quality", "p").join(labels, "doc_id").collect()
    toxic = [r for r in both if r.toxic == 1]
    clean = [r for r in both if r.toxic == 0 and r.quality == 1 and r.p > 0.5]
    assert sum(not r.kept for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.kept for r in clean) >= 0.95 * len(clean)
    out = weaklabels.scored(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert not any(r.kept for r in out if r.doc_id in (0, 1, 2))
    assert weaklabels.scored(empty).count() == 0


# ---- languages


def test_language_held_out_accuracy(spark, docs):
    marked = docs.withColumn("held_out", language.held_out(docs["doc_id"]))
    model = language.train(marked.where("not held_out"))
    got = language.predict(marked, model, ["doc_id", "held_out", "lang", "text"]).collect()
    test = [r for r in got if r.held_out and len(r.text) > 40]
    assert sum(r.lang_pred == r.lang for r in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_mixture_and_odd_rows(spark, docs, odd, empty):
    model = language.train(docs)
    best = {r.lang: r.text for r in docs.collect() if len(r.text) > 800}
    mixed = spark.createDataFrame([(1, best["en"][:800] + " " + best["de"][:800])], "doc_id long, text string")
    row = language.predict(mixed, model, ["doc_id"]).first()
    assert {"en", "de"} <= set(row.languages) and 0.3 < row.languages["en"] < 0.7
    for r in language.predict(odd, model, ["doc_id", "text"]).collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language.predict(empty, model, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language.predict(odd, language.train(empty), ["doc_id"]).collect()} == {"und"}


# ---- leaks


def test_leaks_exact_and_paraphrased(spark, sf, docs, odd, empty):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    host = [r.text for r in docs.collect() if 1000 < len(r.text) < 3000][:30]
    rng, rows = random.Random(2), []
    for k, body in enumerate(host):
        item = items[k].split()
        if k % 2:
            item = [w for w in item if rng.random() > 0.12]
        words = body.split()
        rows.append((10_000 + k, " ".join(words[:60] + item + words[60:])))
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(planted)
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(table, bench).collect()}
    exact = {(10_000 + k, k) for k in range(0, 30, 2)}
    loose = {(10_000 + k, k) for k in range(1, 30, 2)}
    assert len(exact & got) >= 0.9 * len(exact) and len(loose & got) >= 0.8 * len(loose)
    plain = {d: " ".join(t.split()) for d, t in texts_of(table)}
    true = {(d, i) for i, t in items.items() for d, x in plain.items() if " ".join(t.split()) in x}
    assert len(got - true - loose) <= 0.02 * table.count()
    left = leaks.decontaminated(table, bench)
    assert {r.doc_id for r in left.collect()} == set(plain) - {d for d, _ in got}
    assert leaks.contaminated(odd, bench).count() == 0 and leaks.decontaminated(odd, bench).count() == odd.count()
    assert leaks.contaminated(empty, bench).count() == 0
    assert leaks.contaminated(docs, bench.limit(0)).count() == 0 and leaks.decontaminated(docs, bench.limit(0)).count() == docs.count()


def test_leaks_candidates_miss_nothing():
    """Every passage that stands the check is a candidate, also for items of common words only."""
    rng = random.Random(11)
    words = [f"w{chr(97 + k % 26)}{k}" for k in range(60)]
    text = lambda n: [words[min(int(rng.expovariate(0.08)), 59)] for _ in range(n)]
    bodies = [text(n) for n in (3, 7, 8, 9, 15, 33, 50, 70)]
    bodies.append(["wa0"] * 6 + ["wb1"] * 6)
    docs = []
    for k in range(40):
        item = [w for w in bodies[k % len(bodies)] if rng.random() > 0.2]
        docs.append(text(rng.randrange(80)) + item + text(rng.randrange(80)))
    df = np.zeros(leaks.TERMS)
    ids = leaks.word_ids([" ".join(d) for d in docs])
    for d in ids:
        df[np.unique(d >> 2)] += 1
    items = leaks.Items(list(range(len(bodies))), [x.tolist() for x in leaks.word_ids([" ".join(b) for b in bodies])], df, None, 0.7, 8)
    given = [(None, d) for d in ids]
    best = {}
    for d, (_, body) in enumerate(given):
        for at in range(0, len(body), leaks.RUN):
            for i in range(len(bodies)):
                items.check(given, best, d, at, i)
    got = {(d, i): tuple(v) for d, i, *v in items.found(given)}
    assert got == best and len(best) > 20


def test_leaks_paraphrases_with_dropped_words(spark, sf, docs):
    """Every planting that keeps 0.7 of the item and 0.6 of its answer is found, whatever its cosine."""
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    items[1_000] = [w for w, _ in Counter(" ".join(t or "" for _, t in texts_of(docs)).lower().split()).most_common(200) if w.isalpha()][:12]
    host = [r.text.split() for r in docs.collect() if 1000 < len(r.text) < 3000][:20]
    rng, rows, want = random.Random(3), [], set()
    for k, (i, item) in enumerate(items.items()):
        held = [j for j in range(len(item)) if i == 1_000 or rng.random() > 0.2]
        closing = range(len(item) - max(1, len(item) // 3), len(item))
        if len(held) >= max(8, 0.72 * len(item)) and sum(j in held for j in closing) >= 0.65 * len(closing):
            want.add((10_000 + k, i))
        body = host[k % len(host)]
        rows.append((10_000 + k, " ".join(body[:90] + [item[j] for j in held] + body[90:])))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert len(want) > 30 and any(i == 1_000 for _, i in want) and want <= got


def test_leaks_compare_words_not_ids(spark):
    """Words that share an id by chance are no match, in short items and long ones; ``words_of`` follows the ids."""
    made = [f"q{k}" for k in range(1_200_000)]
    ids = leaks.word_ids([" ".join(made)], split=True)[0]

    def twin(word):
        return made[int(np.flatnonzero(ids == leaks.word_ids([word], split=True)[0][0])[0])]

    item = "one stormy evening the old ferry captain counted seventeen lanterns along the northern harbour wall".split()
    bench = spark.createDataFrame([(1, "photosynthesis"), (2, " ".join(item))], "item_id long, text string")
    rows = [
        (1, f"leaves live by {twin('photosynthesis')} mostly"), (2, "Leaves live by PHOTOSYNTHESIS, mostly"),
        (3, " ".join(map(twin, item))), (4, "So " + " ".join(item) + "!"),
        (5, " ".join([*item[:9], *map(twin, item[9:])])), (6, " ".join([*item[:4], twin(item[4]), *item[5:]])),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.lcs for r in leaks.contaminated(table, bench).collect()}
    assert set(got) == {(2, 1), (4, 2), (6, 2)} and got[4, 2] == 1 and got[6, 2] == 14 / 15
    assert {r.doc_id for r in leaks.decontaminated(table, bench).collect()} == {1, 3, 5}
    texts = ["", "a-b_c \u00c9t\u00e9\u2014x", "\u6771\u4eac 2 \u0939\u093f\u0928\u094d\u0926\u0940", "\u0130I \u00b5m"]
    for text, found in zip(texts, leaks.word_ids(texts, split=True)):
        assert [leaks.word_ids([w.decode()])[0][0] for w in leaks.words_of(text)] == found.tolist()


def test_leaks_come_through_the_latent_space(spark, sf, docs):
    """Neighbours in the space of the documents lead to nearly all matches, in the pipeline's stage too; the index of words to the rest."""
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = leaks.contaminated(docs, bench).collect()
    near = [r for r in rows if r.latent]
    assert len(near) >= 0.9 * len(rows) > 0 and all(r.cosine >= leaks.COSINE - 1e-6 for r in near)
    blocks = leaks.prepared(docs, "text", bench, "item_id", "text", 64, 0.7, 8, 4000, leaks.COSINE)
    texts = [t for _, t in texts_of(docs) if t and t.split()][:150]
    given = [(t, ids) for t, ids in zip(texts, leaks.word_ids(texts, split=True)) if len(ids)]
    for items in blocks:
        want = set()
        for d, (_, ids) in enumerate(given):
            for at in range(0, len(ids), leaks.RUN):
                for i, points in enumerate(items.points):
                    m = len(items.words[i])
                    widths = [w for w, fits in ((2, m <= 4 * leaks.RUN), (4, m > 2 * leaks.RUN)) if fits]
                    vectors = [items.space[ids[at : at + w * leaks.RUN] >> 2].sum(0) for w in widths if at % (w * leaks.RUN // 2) == 0]
                    if max(((points @ v).max() / max(np.linalg.norm(v), 1e-12) for v in vectors), default=0) >= items.cosine + 1e-4:
                        want.add((d, at, i))
        got = list(items.neighbours([ids for _, ids in given]))
        assert want and want <= set(got) and len(got) == len(set(got)) <= len(want) + 5
        assert [d for d, *_ in got] == sorted(d for d, *_ in got)


def test_leaks_weights_are_positive(spark):
    scan = leaks.tokenised(spark.createDataFrame([(k, f"the cat w{k}") for k in range(50)], "doc_id long, text string"), "doc_id", "text")
    df, idf = leaks.weighed(scan, 50)
    assert df.max() >= 50 and (idf > 0).all()


def test_leaks_scripts_without_blanks(spark):
    """Items without blanks, and items of few words, are found; signs part words in every script."""
    zh, th, short = "\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3042\u308b\u3002\u4eba\u53e3\u306f\u591a\u3044", "\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e\u0e40\u0e1b\u0e47\u0e19\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e2b\u0e25\u0e27\u0e07", "\u00bfQui\u00e9n vive?"
    bench = spark.createDataFrame([(1, zh), (2, th), (3, short), (4, ""), (5, "\u3002")], "item_id long, text string")
    rows = [
        (1, f"\u4f60\u597d\uff0c{zh}\u3001\u518d\u89c1 some words"), (2, f"abc{th}\u0e04\u0e23\u0e31\u0e1a"), (3, "we ask \u00abqui\u00e9n vive\u00bb here"),
        (4, "vive we ask qui\u00e9n"), (5, zh[::-1]), (6, zh[:12]), (7, None), (8, "\u3002"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks.contaminated(table, bench).collect()} == {(1, 1), (2, 2), (3, 3)}
    assert {r.doc_id for r in leaks.decontaminated(table, bench).collect()} == {4, 5, 6, 7, 8}
    hindi = "\u0939\u093f\u0928\u094d\u0926\u0940 \u092d\u093e\u0937\u093e"
    assert [len(x) for x in leaks.word_ids([zh, hindi, "\u201cCaf\u00e9\u201d\u2014caf\u00e9"], split=True)] == [16, 2, 2]


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert leaks.common_length(leaks.places(a), b) == table[-1][-1]


# ---- licences


def test_licences(spark, empty, odd):
    rows = [
        (1, "Code.\nReleased under the MIT License.\nMore text here today."),
        (2, licence.TEMPLATES["BSD-3-Clause"][1].upper().replace(" ", "\t")),
        (3, "The licence of the MIT building was released under protest last year."),
        (4, None),
        (5, "Licensed under the Apache License, Version 2.0"),
        (5, "Licensed under the Apache License, Version 2.0"),
    ]
    got = licence.matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    lines = Counter((r.doc_id, r.licence) for r in got if r.line > 0)
    assert lines == {(1, "MIT"): 1, (2, "BSD-3-Clause"): 1, (5, "Apache-2.0"): 2}
    assert licence.matches(empty).count() == 0 and licence.matches(odd).count() == 0


def test_licences_equal_brute_force(docs):
    def pairs(text):
        w = re.sub(r"[^\w.]+|_|\.(?!\w)|(?<!\w)\.", " ", text.lower())
        w = [x for x in re.sub(r"\.(?!\d)|(?<!\d)\.", " ", w).split()]
        return set(zip(w, w[1:]))

    templates = [(name, pairs(b)) for name, bodies in licence.TEMPLATES.items() for b in bodies]
    want = set()
    for d, text in texts_of(docs):
        for k, unit in enumerate([text, *text.split("\n")]):
            p = pairs(unit)
            if p and max(2 * len(p & t) / (len(p) + len(t)) for _, t in templates) >= 0.8:
                want.add((d, k))
    assert {(r.doc_id, r.line) for r in licence.matches(docs).collect()} == want


# ---- byte-pair encoding


def test_bpe_equals_library(docs, odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    special = ["<|endoftext|>x<|startoftext|> <|endoftext|", "it's I'LL ''s 'RE", "ΣΑΣ İ ß ½ x²", "नमस्ते ก็", "\x1cq\x1f \x00"]
    extra = odd.sparkSession.createDataFrame([(900 + k, t, None, None, None) for k, t in enumerate(special)], SCHEMA)
    table = docs.unionByName(odd).unionByName(extra)
    for r in bpe.encode_decode(table.withColumnRenamed("lang", "decoded"), path).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.token_ids) == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    some = bpe.digests(docs, path).collect()
    body = dict(texts_of(docs))
    for r in some[:50]:
        ids = library.encode(body[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(ids)
    assert bpe.digests(empty, path).count() == 0


# ---- repeated windows of words


def brute_windows(rows, width=35):
    found = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[k : k + width]) for _, w in found for k in range(len(w) - width + 1))
    out = Counter()
    for i, w in found:
        gone = {j for k in range(len(w) - width + 1) if count[tuple(w[k : k + width])] > 1 for j in range(k, k + width)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def repeats(rng, count, alphabet):
    """Texts over small alphabets with passages of one base text, runs and periods."""
    base = "".join(rng.choice(alphabet) for _ in range(1500))
    out = []
    for k in range(count):
        t = "".join(rng.choice(alphabet[: rng.choice([2, 3, len(alphabet)])]) for _ in range(rng.choice([10, 99, 100, 101, 300])))
        if rng.random() < 0.6:
            a, at = rng.randrange(1200), rng.randrange(len(t))
            t = t[:at] + base[a : a + rng.randrange(20, 300)] + t[at:]
        if rng.random() < 0.3:
            t += rng.choice(["x", "xy"]) * rng.randrange(1, 200)
        out.append((k, t))
    return out


def test_windows_equal_brute_force(spark, docs, odd, empty):
    rng = random.Random(3)
    small = [(k, " ".join(t)) for k, t in repeats(rng, 120, "abcdefghij")]
    made = spark.createDataFrame([*small, (500, small[4][1]), (501, small[4][1].replace(" ", "\n"))], "doc_id long, text string")
    for table in (made.repartition(3), docs, odd):
        got = Counter(tuple(r) for r in recompress.digests(table).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
        assert got == brute_windows(texts_of(table))
    assert recompress.digests(empty).count() == 0


def test_borders_agree_inside_equal_windows():
    rng = np.random.default_rng(0)
    for _ in range(200):
        window = rng.integers(0, rng.choice([2, 4, 1000]), 35).astype(np.uint64)
        seen = []
        for _ in range(2):
            words = np.concatenate([rng.integers(0, 3, 9), window, rng.integers(0, 3, 7)]).astype(np.uint64)
            ends = np.zeros(len(words), bool)
            ends[-1] = True
            start = recompress.borders(words, ends) - 9
            seen.append({s for s in start.tolist() if recompress.TRIM <= s <= 35 - recompress.TRIM})
        assert seen[0] == seen[1] and seen[0]


# ---- repeated byte strings


def brute_bytes(rows, width=100):
    seen, out = set(), Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        b = (t or "").encode()
        gone = set()
        for k in range(len(b) - width + 1):
            if b[k : k + width] in seen:
                gone.update(range(k, k + width))
            seen.add(b[k : k + width])
        runs = sum(j - 1 not in gone for j in gone)
        out[i, len(b), len(gone), runs, hashlib.sha256(bytes(x for j, x in enumerate(b) if j not in gone)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [50_000, 3])
def test_bytes_equal_brute_force(spark, docs, hot):
    rng = random.Random(3)
    rows = repeats(rng, 150, "abcdefgé ")
    rows += [(1000, None), (1001, ""), (1002, rows[5][1]), (1003, rows[5][1]), (1004, "z" * 100)]
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for table in (made, docs):
        out = interleave.removed(table, hot=hot).collect()
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out)
        assert got == brute_bytes(texts_of(table))


def test_bytes_merged_in_small_parts(spark, monkeypatch):
    """Names that stretch over several Arrow batches are merged whole."""
    rng = random.Random(4)
    rows = [*repeats(rng, 60, "abcdefgé "), *[(500 + k, "x" * k + "0123456789" * 13) for k in range(30)]]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_bytes(texts_of(made))
    monkeypatch.setattr(interleave, "MERGED", 20)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        out = interleave.removed(made).collect()
    finally:
        spark.conf.set(key, old)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out) == want


def test_bytes_odd_rows(odd, empty):
    got = {r.doc_id: r for r in interleave.digests(odd).collect()}
    assert got[50].n_removed == 0 and got[51].n_removed == got[51].n_bytes and got[53].n_removed == 0
    assert interleave.digests(odd).count() == odd.count() and interleave.digests(empty).count() == 0


def test_refined_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (200, 19)).astype(np.uint8)
    blocks = np.sort(rng.integers(0, 9, 200))
    order, common = interleave.refined(blocks, rows)
    assert [(blocks[i], *rows[i]) for i in order] == sorted((blocks[i], *rows[i]) for i in range(200))
    for k in range(1, 200):
        a, b = order[k - 1], order[k]
        same = next((j for j in range(19) if rows[a][j] != rows[b][j]), 19)
        assert common[k] == (same if blocks[a] == blocks[b] else -1)


# ---- personal data


def test_base_patterns(docs, odd, empty):
    for table in (docs, odd):
        body = Counter()
        for i, t in texts_of(table):
            spans = [(k, m.start(), m.end()) for k, p in pii.KINDS.items() for m in p.finditer(t or "") if pii.valid(k, m.group())]
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
            body[(i, *(sum(s[0] == k for s in spans) for k in pii.KINDS), digest)] += 1
        got = pii.digests(table).select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256").collect()
        assert Counter(tuple(r) for r in got) == body
    assert pii.digests(empty).count() == 0


def test_email_search_equals_pattern():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("a.@-_ é%1@.b") for _ in range(rng.randrange(24)))
        assert list(pii.emails(t)) == [(m.start(), m.end()) for m in pii.KINDS["email"].finditer(t)], t


def test_valid_values():
    assert pii.valid("ip", "1.2.3.255") and not pii.valid("ip", "1.2.3.256") and pii.valid("ip", "0001.2.3.4")
    assert pii.valid("card", "4111 1111 1111 1111") and not pii.valid("card", "4111 1111 1111 1112") and not pii.valid("card", "42")
    assert pii.valid("phone", "+1 (017) 555-7713") and not pii.valid("phone", "+123")


def test_revealing_terms(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = [(k, " ".join(word() for _ in range(30))) for k in range(300)]
    for k in range(300, 306):
        rows.append((k, f"{word()} {word()} the plumber of Tinsworth is reached at jo@mail.example.com {word()} {word()} {word()}"))
    rows += [(400 + k, f"{word()} the {word()} of is at {word()} reached") for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digests(table).collect()}
    body = dict(rows)
    for k in range(300, 306):
        terms = {body[k][int(a) : int(b)] for kind, a, b in (s.split(":") for s in got[k].spans.split(",")) if kind == "term"}
        assert "Tinsworth" in terms and "the" not in terms
    assert all(r.spans == "" for r in got.values() if r.doc_id < 300 or r.doc_id >= 400)
    clean = {r.doc_id: r.text for r in pii.sanitised(table).collect()}
    assert "[email]" in clean[300] and "Tinsworth" not in clean[300] and clean[5] == body[5]


def test_copies_hide_no_revealing_term(spark):
    """One of six texts copied 200 times: the term is still found, in the copies too."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = [(k, " ".join(word() for _ in range(30))) for k in range(300)]
    rows += [(300 + k, f"{word()} Tinsworth is reached at jo@mail.example.com {word()}") for k in range(6)]
    rows += [(400 + k, rows[300][1]) for k in range(200)]
    got = {r.doc_id: r for r in pii.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    body = dict(rows)
    for k in [*range(300, 306), *range(400, 600)]:
        assert "Tinsworth" in {body[k][int(a) : int(b)] for kind, a, b in (s.split(":") for s in got[k].spans.split(",")) if kind == "term"}


def test_revealing_terms_far_from_the_value(spark):
    """A name in the heading and an address at the end: found, and replaced in texts without the address too."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    some = lambda n: " ".join(word() for _ in range(n))
    rows = [(k, some(30)) for k in range(300)]
    rows += [(300 + k, f"Tinsworth {some(40)} jo@mail.example.com {some(20)} Tinsworth") for k in range(6)]
    rows += [(400, f"{some(5)} tinsworth {some(5)}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(table).collect()}
    assert len(clean) == len(rows) and not any("tinsworth" in t.lower() for t in clean.values())
    assert all(clean[k] == t for k, t in rows[:300])
    assert pii.digests(table).where("n_term > 0").count() == 7


def test_sanitised_keeps_columns(odd):
    clash = odd.withColumnsRenamed({"lang": "spans", "source": "_row"})
    out = pii.sanitised(clash)
    assert out.columns == clash.columns
    assert Counter(map(repr, out.collect())) == Counter(map(repr, clash.collect()))


# ---- pipeline and registry


def test_pipeline_stages(spark, sf, odd, empty):
    import corpus_pipeline as pipeline

    for start in (spark.read.parquet(f"{sf}/documents.parquet"), odd, empty):
        docs = start
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == start.columns and out.count() <= docs.count(), name
            if docs is not start:
                docs.unpersist()
            docs = out.cache()
        last = pipeline.STAGES[-1][1](spark, docs, sf)
        assert last.count() == docs.count() and {"token_ids", "decoded"} <= set(last.columns)


def test_one_of_each_keeps_one(spark, sf, odd):
    import corpus_pipeline as pipeline

    left = pipeline.one_of_each(spark, odd, sf).collect()
    assert sum(r.doc_id == 53 for r in left) == 1
    body = {r.text for r in odd.collect() if r.doc_id == 50}.pop()
    assert sum(r.text is not None and r.text.startswith(body) for r in left) == 1


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))
