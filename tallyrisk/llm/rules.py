"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one statistic of a text and votes good (1), bad (-1) or
abstains (0).  No rule decides alone: expectation-maximisation over the counts
of vote patterns estimates how often each rule is right on good and on bad
texts, and the posterior probability of being good replaces all-must-pass
filtering.  The driver sees only the pattern counts, at most 3 ** rules rows;
their number does not grow with the corpus.

Defined results: a null, empty or blank text has no words, counts of 0, fails
the base test and is not kept; repeated rows get equal results; an empty table
gives an empty table; other columns pass through, and columns of the names made
here are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.text import SPACE, stored

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
EXTRA = ["n_lines", "n_upper", "n_letters", "n_stops", "n_unique"]


@dataclass(frozen=True)
class Rule:
    """Vote good inside [good_low, good_high], bad outside [low, high], else abstain."""

    name: str
    value: Column
    low: float
    good_low: float
    good_high: float
    high: float

    def vote(self) -> Column:
        v = F.coalesce(self.value, F.lit(math.nan))
        return (
            F.when(F.isnan(v), 0)
            .when((v < self.low) | (v > self.high), -1)
            .when(v.between(self.good_low, self.good_high), 1)
            .otherwise(0)
            .cast("int")
        )


def share(part: str, whole: str) -> Column:
    """part / whole as a double; null where the whole is 0."""
    return F.col(part).cast("double") / F.when(F.col(whole) > 0, F.col(whole))


def rules() -> list[Rule]:
    """The rules; thresholds are fixed values."""
    inf = math.inf
    return [
        Rule("length", F.col("n_words").cast("double"), 50, 100, 100_000, inf),
        Rule("symbols", share("n_symbols", "n_words"), -inf, -inf, 0.05, 0.25),
        Rule("repeats", share("n_repeat_words", "n_words"), -inf, -inf, 0.15, 0.4),
        Rule("lines", share("n_dup_lines", "n_lines"), -inf, -inf, 0.2, 0.5),
        Rule("word_length", share("word_chars", "n_words"), 2, 3, 10, 15),
        Rule("capitals", share("n_upper", "n_letters"), -inf, -inf, 0.15, 0.5),
        Rule("stops", share("n_stops", "n_words"), 0.005, 0.02, 0.35, 0.6),
        Rule("variety", share("n_unique", "n_words"), 0.1, 0.2, inf, inf),
    ]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics and those that only the rules use."""
    made = ["_text", "_words", "_lines", "_windows", "_places", *STATISTICS, *EXTRA]
    kept = docs.select(*[c for c in docs.columns if c not in made])
    body = F.coalesce(F.col("_text"), F.lit(""))
    first = (
        docs.select(*kept.columns, docs[text].alias("_text"))
        .withColumn("_words", F.array_remove(F.split(body, f"[{SPACE}]+"), ""))
        .withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    )
    second = first.select(
        *kept.columns,
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(body, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace(body, "[^.!?。]+", "")).cast("long").alias("n_stops"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_unique"),
        F.expr("""CASE WHEN size(_words) >= 4 THEN transform(slice(_words, 1, size(_words) - 2),
            (w, i) -> xxhash64(w, element_at(_words, i + 2), element_at(_words, i + 3)))
            ELSE CAST(array() AS array<bigint>) END""").alias("_windows"),
    )
    # Windows found twice or more stand side by side once sorted; their places cover the repeated words.
    third = second.withColumn(
        "_windows",
        F.expr("""CASE WHEN size(array_distinct(_windows)) < size(_windows)
            THEN sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i))) END"""),
    )
    fourth = third.withColumn(
        "_places",
        F.expr("""sort_array(transform(filter(_windows, (x, k) ->
            (k > 0 AND x.h = _windows[k - 1].h) OR (k + 1 < size(_windows) AND x.h = _windows[k + 1].h)), x -> x.i))"""),
    )
    return fourth.withColumn(
        "n_repeat_words",
        F.expr("""coalesce(aggregate(_places, struct(-3 AS last, 0L AS n),
            (a, p) -> struct(p AS last, a.n + least(3, p - a.last) AS n), a -> a.n), 0L)"""),
    ).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    ).drop("_words", "_windows", "_places")


@dataclass(frozen=True)
class Model:
    """Share of good texts, and per rule how often a cast vote is right on good and on bad texts."""

    names: tuple[str, ...]
    good: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def probability(self, votes: Sequence[Column]) -> Column:
        """Posterior probability of being good, as a column."""
        logit = F.lit(math.log(self.good / (1 - self.good)))
        for vote, a, b in zip(votes, self.right_on_good, self.right_on_bad):
            up, down = math.log(a / (1 - b)), math.log((1 - a) / b)
            logit = logit + F.when(vote == 1, up).when(vote == -1, down).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def fit(patterns: dict[tuple[int, ...], int], names: Sequence[str], rounds: int = 50) -> Model:
    """Expectation-maximisation over counts of vote patterns.

    A starting guess doubts a text with any bad vote.  Junk comes in kinds, and
    a kind that only one rule sees must not pass for good because all others
    are content.  So prior knowledge bounds the estimates: good texts are at
    least half of all; a rule, which abstains in between, is right on at least
    0.998 of the good texts that it votes on; and it is right on 0.3 to 0.7 of
    the bad ones, so neither a bad vote nor a good one counts for nothing.
    """
    m = len(names)
    good, a, b = 0.9, [0.998] * m, [0.3] * m
    clip = lambda x, low, high: min(high, max(low, x))
    for k in range(rounds):
        total = weight = 0.0
        hits, cast = [[0.0, 0.0] for _ in range(m)], [[0.0, 0.0] for _ in range(m)]
        for votes, n in sorted(patterns.items()):
            if k == 0:
                p = 1 / (1 + math.exp(-(3.0 - 8.0 * sum(v < 0 for v in votes))))
            else:
                logit = math.log(good / (1 - good))
                for v, x, y in zip(votes, a, b):
                    if v:
                        logit += math.log(x / (1 - y)) if v > 0 else math.log((1 - x) / y)
                p = 1 / (1 + math.exp(-clip(logit, -500, 500)))
            total, weight = total + n, weight + n * p
            for j, v in enumerate(votes):
                if v:
                    for side, q in ((0, p), (1, 1 - p)):
                        cast[j][side] += n * q
                        hits[j][side] += n * q * ((v > 0) == (side == 0))
        if not total:
            break
        good = clip((weight + 9) / (total + 10), 0.5, 0.999)
        a = [clip((h[0] + 9.99) / (c[0] + 10), 0.998, 0.9998) for h, c in zip(hits, cast)]
        b = [clip((h[1] + 1) / (c[1] + 4), 0.3, 0.7) for h, c, x in zip(hits, cast, a)]
    return Model(tuple(names), good, tuple(a), tuple(b))


def judged(docs: DataFrame, text: str = "text", threshold: float = 0.5, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` with statistics, votes, ``quality`` (posterior) and ``kept``.

    The statistics are written to the shared folder once, because both the
    fit and the verdict read them.
    """
    chosen = rules()
    votes = [r.vote().alias(f"vote_{r.name}") for r in chosen]
    names = [f"vote_{r.name}" for r in chosen]
    clash = {*STATISTICS, *names, "quality", "kept"}
    carried = [c for c in carry if c not in clash]
    found = statistics(docs.select(*dict.fromkeys([*carried, text])).withColumn("_body", F.col(text)), "_body")
    table = stored(found.select(*carried, *STATISTICS, *votes), "rules")
    counted = table.groupBy(*names).count().collect()
    model = fit({tuple(row[n] for n in names): row["count"] for row in counted}, [r.name for r in chosen])
    quality = model.probability([F.col(n) for n in names])
    return table.withColumn("quality", quality).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )


def filtered(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept; all columns stay, and none clashes with those made here."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    body = names[docs.columns.index(text)]
    chosen = rules()
    votes = [r.vote().alias(f"vote_{r.name}") for r in chosen]
    found = statistics(plain.withColumn("_body", F.col(body)), "_body")
    # explode(array(x)) keeps the statistics columns of their own: a filter on the votes would compute them again and again.
    one = F.explode(F.array(F.struct(*STATISTICS, *EXTRA))).alias("_s")
    given = found.select(*names, one).select(*names, "_s.*").select(*names, "base_failed", *votes)
    fields = [f"vote_{r.name}" for r in chosen]
    # Two passes over the texts instead of a second copy of them on disk.
    counted = given.groupBy(*fields).count().collect()
    model = fit({tuple(row[n] for n in fields): row["count"] for row in counted}, [r.name for r in chosen])
    good = model.probability([F.col(n) for n in fields]) >= threshold
    return given.where(~F.col("base_failed") & good).select(*names).toDF(*docs.columns)
