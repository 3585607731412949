"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on each text or abstain.
Expectation-maximisation over the counts of vote patterns estimates their
accuracies; the posterior probability of being good is the label of each text.
A linear scorer over hashed words and shape features learns these soft labels
and generalises them: it scores texts on which no labeller has an opinion.

One labeller counts words of abuse: a fixed list, and words that a bounded number
of labelled texts show almost only where the label says toxic.

The patterns cover all texts.  The scorer is fitted on about ``sample`` texts, a
documented bound, chosen by a hash of the text, and applied to all.

Defined results: null, empty and blank texts have no word; the labeller of length
calls them bad, and they are not kept; repeated rows get equal scores; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.leaks import in_batches, word_ids
from tallyrisk.llm.rules import fit
from tallyrisk.llm.text import mapped, stored

LABELLERS = ["length", "symbols", "capitals", "repeats", "stops", "insults", "word_length"]
#: Words of abuse.
INSULTS = ["idiot", "moron", "clown", "worthless", "stupid", "loser", "scum", "imbecile", "pathetic", "trash", "disgusting"]
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
BUCKETS = 1 << 16
SHAPES = 64


def insult_ids() -> np.ndarray:
    return np.concatenate(word_ids(INSULTS, 32))


def shape(text: str | None, ids: np.ndarray, bad: np.ndarray) -> dict[str, float]:
    """Statistics of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    count = lambda marks: len(raw) - len(raw.translate(None, marks))
    n = max(1, len(ids))
    upper, lower = count(UPPER), count(LOWER)
    return {
        "length": float(len(ids)),
        "symbols": count(SYMBOLS) / n,
        "capitals": upper / max(1, upper + lower),
        "repeats": 1 - len(np.unique(ids)) / n,
        "stops": count(b".!?") / n,
        "insults": float(np.isin(ids, bad).sum()),
        "word_length": len(raw) / n,
    }


def abusive(s: dict[str, float]) -> bool:
    """Two words of abuse or more, and not few in a long text."""
    return s["insults"] >= max(2, 0.002 * s["length"])


def votes(s: dict[str, float]) -> list[int]:
    """One vote per labeller: good 1, bad -1, no opinion 0."""
    n = s["length"]
    some = n > 0
    return [
        -1 if n < 30 else (1 if n >= 100 else 0),
        -1 if s["symbols"] > 0.25 else (1 if some and s["symbols"] < 0.05 else 0),
        -1 if s["capitals"] > 0.5 else (1 if some and s["capitals"] < 0.15 else 0),
        -1 if s["repeats"] > 0.85 and n >= 60 else (1 if some and s["repeats"] < 0.7 else 0),
        -1 if s["stops"] < 0.005 and n >= 60 else (1 if 0.02 < s["stops"] < 0.35 else 0),
        -1 if abusive(s) else 0,
        -1 if some and not 2 <= s["word_length"] <= 20 else (1 if 3 <= s["word_length"] <= 12 else 0),
    ]


def features(s: dict[str, float], ids: np.ndarray) -> np.ndarray:
    """Numbers of the features that a text has: hashed words, then one per statistic and level."""
    levels = [min(SHAPES // len(LABELLERS) - 1, int(8 * min(1.0, x))) for x in (
        np.log10(s["length"] + 1) / 5, s["symbols"], s["capitals"], s["repeats"], 2 * s["stops"], s["insults"], s["word_length"] / 30
    )]
    marks = BUCKETS + np.arange(len(levels)) * (SHAPES // len(LABELLERS)) + np.array(levels)
    return np.concatenate([np.unique(ids >> 16).astype(np.int64), marks])


def learned(rows: list[np.ndarray], labels: np.ndarray, rounds: int = 200, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic scorer with soft labels; words share a length-normalised vote, shapes count whole."""
    size = BUCKETS + SHAPES + 1
    if not rows:
        return np.zeros(size)
    index = np.concatenate(rows)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights, square = np.zeros(size), np.full(size, 1e-8)
    for _ in range(rounds):
        z = np.add.reduceat(weights[index], first) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(rows)
        gradient = np.bincount(index, error[owner], size) + decay * weights
        gradient[-1] = error.sum()
        square += gradient**2
        weights -= rate * gradient / np.sqrt(square) / 4
    return weights


def abuse(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, most: int, support: int = 5, share: float = 0.85) -> np.ndarray:
    """Ids of words that occur in ``support`` or more toxic texts and in few others, of about ``most`` labelled texts."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(doc_id).isNotNull())
    part = min(1.0, most / max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) < int(part * (1 << 20)) + 1).select(doc_id, "toxic")
    # About ``most`` rows of an id and a flag.
    rows = docs.select(doc_id, text).join(F.broadcast(some), doc_id).select("toxic", F.col(text).alias("_body"))

    def count(given: Iterator[tuple]) -> Iterator[tuple]:
        for batch, found in in_batches(given, 1, bits=32):
            for kind in (0, 1):
                some = [np.unique(ids) for (toxic, _), ids in zip(batch, found) if int(toxic > 0) == kind]
                ids, n = np.unique(np.concatenate(some), return_counts=True) if some else ((), ())
                for i, k in zip(ids, n):
                    yield int(i), int(k) * (1 - kind), int(k) * kind

    sums = mapped(rows, count, "id long, clean long, toxic long").groupBy("id").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    # Fewer rows than words of the bounded sample.
    return np.array([r["id"] for r in sums.where((F.col("t") >= support) & (F.col("t") >= share * (F.col("c") + F.col("t")))).collect()], np.uint32)


def scored(
    docs: DataFrame,
    labels: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = 6000,
    labelled: int = 20_000,
    threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, quality, score, n_abuse, kept): posterior of the labellers, linear score, words of abuse, and the verdict.

    ``labels`` may give (doc_id, toxic); a text is kept if its score reaches the
    threshold and the labeller of abuse does not object.
    """
    bad = insult_ids()
    if labels is not None:
        bad = np.union1d(bad, abuse(docs, labels, doc_id, text, labelled))
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_body"))
    kind = given.schema["doc_id"].dataType.simpleString()
    names = [f"v{k}" for k in range(len(LABELLERS))]

    def label(rows: Iterator[tuple]) -> Iterator[tuple]:
        for batch, found in in_batches(rows, 1, bits=32):
            for (name, body), ids in zip(batch, found):
                yield name, *votes(shape(body, ids, bad))

    voted = stored(mapped(given, label, f"doc_id {kind}, {', '.join(f'{n} int' for n in names)}"), "votes")
    # At most 3 ** labellers rows.
    patterns = {tuple(r[n] for n in names): r["count"] for r in voted.groupBy(*names).count().collect()}
    model = fit(patterns, LABELLERS)
    size = sum(patterns.values())
    share = min(1.0, sample / max(1, size))
    chosen = given.where(F.pmod(F.xxhash64(F.coalesce("_body", F.lit(""))), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def judge(s: dict[str, float]) -> float:
        z = np.log(model.good / (1 - model.good))
        for v, a, b in zip(votes(s), model.right_on_good, model.right_on_bad):
            z += np.log(a / (1 - b)) if v > 0 else np.log((1 - a) / b) if v < 0 else 0.0
        return float(1 / (1 + np.exp(-z)))

    def example(rows: Iterator[tuple]) -> Iterator[tuple]:
        for batch, found in in_batches(rows, 0, bits=32):
            for (body,), ids in zip(batch, found):
                s = shape(body, ids, bad)
                yield judge(s), features(s, ids).astype(np.int32).tobytes()

    # Copies of one text are one example, so a large group of copies does not exceed the bound.
    examples = mapped(chosen.select("_body").distinct(), example, "label double, features binary").collect()
    weights = learned(
        [np.frombuffer(r["features"], np.int32) for r in examples], np.array([r["label"] for r in examples])
    ).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(rows: Iterator[tuple]) -> Iterator[tuple]:
        w = shared.value
        for batch, found in in_batches(rows, 1, bits=32):
            for (name, body), ids in zip(batch, found):
                s = shape(body, ids, bad)
                value = float(1 / (1 + np.exp(-np.clip(w[features(s, ids)].sum() + w[-1], -30, 30))))
                yield name, judge(s), value, int(s["insults"]), bool(len(ids) and value >= threshold and not abusive(s))

    return mapped(given, score, f"doc_id {kind}, quality double, score double, n_abuse int, kept boolean")
