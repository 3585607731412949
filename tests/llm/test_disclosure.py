"""Revealing terms against plainly counted mutual information."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tallyrisk.llm import pii


def planted(n: int) -> list[tuple]:
    """Texts of common words; some hold an address that comes back, with a name near it or far from it; many copies."""
    rng = random.Random(21)
    vocabulary = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(12)]
    texts = []
    for k in range(n):
        words = rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randint(3, 40))
        who = rng.randrange(12)
        if k % 9 == 0:
            words.insert(rng.randrange(len(words)), f"mail name{'abcdefghijkl'[who]}x person{who}@site.org soon")
        elif k % 31 == 0:
            words = [f"Name{'abcdefghijkl'[who]}x", *words]
        elif k % 17 == 0:
            words.append(f"call +1 555 0{rng.randrange(10**6):06d} please Telefon")
        texts.append(" ".join(words))
    texts += texts[9:10] * 400 + texts[:1] * 30 + [None, "", "x@y.z", "a@b.c " * 50 + "lonely " * 50]
    return [(k, t) for k, t in enumerate(texts)]


def brute(rows, width=5, support=3, threshold=0.7):
    texts = {t or "" for _, t in rows}
    df, de, joint = defaultdict(set), defaultdict(set), defaultdict(set)
    for t in texts:
        spans = pii.base_spans(t)
        words = [(m.group().lower(), m.start(), m.end()) for m in pii.WORD.finditer(t)]
        free = [w for w in words if not any(a < w[2] and w[1] < b for _, a, b in spans)]
        for w in free:
            df[w[0]].add(t)
        for kind, a, b in spans:
            value = pii.entity_of(kind, t[a:b])
            de[value].add(t)
            de[kind].add(t)
            for w in free:
                joint[value, w[0]].add(t)
            for w in [w for w in free if w[2] <= a][-width:] + [w for w in free if w[1] >= b][:width]:
                joint[kind, w[0]].add(t)
    out = set()
    for (entity, term), both in joint.items():
        d, j = len(de[entity]), len(both)
        if support <= d < len(texts) and j >= support:
            told = math.log(len(texts) * j / (max(len(df[term]), j) * d)) / math.log(len(texts) / d)
            if told >= threshold:
                out.add(term)
    return out


@pytest.mark.parametrize("n", [300, 3000])
def test_spans_equal_plain_counts(spark, n):
    rows = planted(n)
    terms = brute(rows)
    assert any(t.startswith("name") for t in terms) and len(terms) < 40
    want = {}
    for k, t in rows:
        spans = [*pii.base_spans(t or "")]
        spans += [(pii.TERM, a, b) for w, a, b in pii.free_words(t or "", spans) if w in terms]
        want[k] = ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {r.doc_id: r.spans for r in pii.digests(table).collect()} == want


def test_free_words_touch_no_span():
    text = "Éa a@b.cd éx@y.zw word +1 555 12345678abc end 1.2.3.4tail"
    spans = pii.base_spans(text)
    want = [
        (m.group().lower(), m.start(), m.end())
        for m in pii.WORD.finditer(text)
        if not any(a < m.end() and m.start() < b for _, a, b in spans)
    ]
    assert pii.free_words(text, spans) == want


def test_words_near_a_value_are_counted_by_words():
    text = "far " + "x" * 500 + " one two three four a@b.cd " + "y" * 900 + " six"
    spans = pii.base_spans(text)
    near = {w for _, w in pii.near_kinds(spans, pii.free_words(text, spans), 5)}
    assert near == {"x" * 500, "one", "two", "three", "four", "y" * 900, "six"}


def test_bits_hold_every_term(spark):
    terms = [f"term{k}é" for k in range(3000)]
    bits = pii.term_bits(spark.createDataFrame([(t,) for t in terms], "term string"))
    words = [(t, 0, 1) for t in terms]
    assert pii.likely(words, bits) == words
    others = pii.likely([(f"other{k}", 0, 1) for k in range(3000)], bits)
    assert len(others) < 300 and np.bitwise_count(bits).sum() <= 3000
    assert len(pii.term_bits(spark.createDataFrame([], "term string"))) == 0


def test_both_sides_hash_texts_alike(spark):
    texts = ["", "a", "é😀 text", "x" * 1000, "0123456789" * 7]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) h").collect()
    for r in rows:
        assert r.h % 2**64 == xxhash.xxh64_intdigest(r.t.encode(), pii.SPARK_SEED)
