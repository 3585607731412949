"""Languages of a text as a mixture of n-gram models.

Training counts the hashed character n-grams of all labelled texts, per
language.  A text is then a bag of words, each drawn from one language of a
mixture: expectation-maximisation finds the proportions, first over all
languages, and languages are dropped one by one, smallest share first; the set
with the best likelihood less a penalty for each proportion stays.

Defined results: null texts and texts without a letter are ``und`` with score
0, as is every text if nothing was learned; rows with a null label do not take
part in training; ties between languages go to the first name; repeated rows
count as often as they occur.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.text import mapped

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 32  # longer words (scripts without blanks) are cut into pieces of this length


def words_of(text: str) -> Counter:
    """The words of a text, letters only, with their counts."""
    words = Counter(LETTERS.findall(text.lower()))
    for word in [w for w in words if len(w) > LONGEST]:
        n = words.pop(word)
        for at in range(0, len(word), LONGEST):
            words[word[at : at + LONGEST]] += n
    return words


def grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 3-grams of blank-framed words, and where each word's begin."""
    text = np.frombuffer(("  " + "  ".join(words) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 2)[:-1]]) + 1  # at the blank before each word
    one, two, three = text[:-2], text[1:-1], text[2:]
    tri = ((one * np.uint64(0x1F123BB5) + two) * np.uint64(0x2545F491) + three) * np.uint64(0x9E3779B97F4A7C15)
    bi = ((one * np.uint64(0x1F123BB5) + two) + np.uint64(1 << 40)) * np.uint64(0xBF58476D1CE4E5B9)
    uni = (two + np.uint64(1 << 50)) * np.uint64(0x94D049BB133111EB)
    shift = np.uint64(64 - buckets.bit_length() + 1)
    return (np.stack([tri, bi, uni], 1) >> shift).astype(np.int64).ravel(), starts * 3


@dataclass(frozen=True)
class Model:
    """Log likelihood of each n-gram bucket in each language."""

    names: tuple[str, ...]
    logs: np.ndarray  # buckets x languages, float32


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 16) -> Model:
    """Count n-grams per language over all rows whose text and label are there.

    The model has buckets x languages numbers, whatever the size of the corpus.
    """

    def counts(rows: Iterator[tuple]) -> Iterator[tuple]:
        words: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}

        def flush() -> None:
            for name, found in words.items():
                if found:
                    at, starts = grams(list(found), buckets)
                    n = np.fromiter(found.values(), np.float64, len(found))
                    each = np.repeat(n, np.diff(np.append(starts, len(at))))
                    sums.setdefault(name, np.zeros(buckets))
                    sums[name] += np.bincount(at[starts[0] :], each, buckets)
            words.clear()

        held = 0
        for body, name in rows:
            found = words_of(body)
            words.setdefault(name, Counter()).update(found)
            held += len(found)
            if held > 500_000:
                flush()
                held = 0
        flush()
        for name, total in sums.items():
            for i in np.flatnonzero(total):
                yield name, int(i), int(total[i])

    given = labelled.select(text, lang).where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    table = mapped(given, counts, "lang string, bucket int, n long", 20_000).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = table.toPandas()
    names = tuple(sorted(found["lang"].unique()))
    total = np.zeros((buckets, len(names)))
    for k, name in enumerate(names):
        part = found[found["lang"] == name]
        total[part["bucket"].to_numpy(), k] = part["n"].to_numpy()
    logs = np.log((total + 0.5) / (total.sum(0) + 0.5 * buckets)) if names else total
    return Model(names, logs.astype(np.float32))


def mixture(scores: np.ndarray, counts: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions of the languages and the log likelihood, by expectation-maximisation."""
    top = scores.max(1, keepdims=True)
    likely = np.exp(scores - top)
    base, n, before = float(counts @ top[:, 0]), counts.sum(), -np.inf
    for _ in range(rounds):
        each = likely @ shares
        now = float(counts @ np.log(each))
        if now - before < 1e-3 * max(1.0, n / 1000):
            break
        before = now
        shares = shares * ((counts / each) @ likely) / n
    return shares, base + before


class Guesser:
    """Word scores of one model, with a store of bounded size for words seen before."""

    def __init__(self, model: Model, limit: int = 300_000):
        self.model, self.limit = model, limit
        self.known: dict[str, int] = {}
        self.table = np.empty((limit, len(model.names)), np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.limit:
            known.clear()
            new = words
        if len(new) > self.limit:
            return self.fresh(new).astype(np.float64)
        if new:
            at = len(known)
            self.table[at : at + len(new)] = self.fresh(new)
            known.update(zip(new, range(at, at + len(new))))
        return self.table[[known[w] for w in words]].astype(np.float64)

    def fresh(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word in each language."""
        at, starts = grams(words, len(self.model.logs))
        return np.add.reduceat(self.model.logs[at[starts[0] :]], starts - starts[0], axis=0)

    def shares(self, text: str | None, penalty: float = 1.0, rounds: int = 12) -> dict[str, float]:
        """The chosen languages of a text with their proportions, largest first."""
        names = self.model.names
        words = words_of(text) if text else Counter()
        if not names or not any(c.isalpha() for w in words for c in w):
            return {}
        scores = self.scores(list(words))
        counts = np.fromiter(words.values(), np.float64, len(words))
        each = penalty * 0.5 * np.log(counts.sum() + 1)
        chosen = np.arange(len(names))
        shares, best = np.full(len(names), 1 / len(names)), None
        while True:
            if len(chosen) == 1:
                shares, fit = np.ones(1), float(counts @ scores[:, chosen[0]])
            else:
                shares, fit = mixture(scores[:, chosen], counts, shares, rounds)
            value = fit - each * (len(chosen) - 1)
            if best is None or value >= best[0]:
                best = (value, chosen, shares)
            if len(chosen) == 1:
                break
            stay = np.sort(np.argsort(-shares, kind="stable")[:-1])
            chosen, shares = chosen[stay], np.maximum(shares[stay], 1e-6)
            shares = shares / shares.sum()
        order = np.argsort(-best[2], kind="stable")
        return {names[best[1][i]]: float(best[2][i]) for i in order}


def predict(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` with ``lang_pred``, ``score`` and ``languages`` (map of language to proportion)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        guesser = Guesser(shared.value)
        for *left, body in rows:
            found = guesser.shares(body)
            name = next(iter(found), UNKNOWN)
            yield *left, name, min(1.0, found.get(name, 0.0)), list(found.items())

    return mapped(
        docs.select(*columns, F.col(text).alias("_body")), run, f"{kinds}, lang_pred string, score double, languages map<string,double>"
    )


def held_out(doc_id: Column) -> Column:
    """A quarter of all documents, by their id, that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
