"""Global order without one global task: running totals, exact quantile picks, exact selection."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Usual number of value ranges a global order is cut in.  A range is one task's work, so
#: take about (distinct values / 1 million), rounded up to a power of two, if that is more.
RANGES = 1024


def _range_of(df: DataFrame, column: str, splits: DataFrame, ranges: int) -> DataFrame:
    """Column ``_range``: how many split points lie below the value (binary search)."""
    steps, step = [], ranges // 2
    while step >= 1:
        steps.append(str(step))
        step //= 2
    # A probe beyond the array is null and leaves the position as it is.
    move = f"_at + if(try_element_at(_splits, _at + _step) < `{column}`, _step, 0)"
    found = f"aggregate(array({', '.join(steps)}), 0, (_at, _step) -> {move})"
    return df.withColumn("_splits", splits.scalar()).withColumn("_range", F.expr(found)).drop("_splits")


def running_totals(
    df: DataFrame, value: str, sums: dict[str, Column], descending: bool = False, ranges: int = RANGES
) -> DataFrame:
    """One row per distinct value: each sum, and its total up to and including the value.

    Output: ``value``, and for each name ``name`` and ``cum_name``.  Rows are
    first combined per value; values are then cut in ranges of about equal size
    at approximate quantiles (which only balance the work), and range totals, at
    most ``ranges`` rows, give each range its starting point.  ``ranges`` is a
    power of two.
    """
    if ranges < 2 or ranges & (ranges - 1):
        raise ValueError("ranges must be a power of two")
    df = df.filter(F.col(value).isNotNull())
    per_value = df.groupBy(value).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    points = [i / ranges for i in range(1, ranges)]
    splits = df.agg(F.percentile_approx(F.col(value), points, F.lit(ranges * 4)))
    ranged = _range_of(per_value, value, splits, ranges)

    def order(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    before = Window.orderBy(order("_range")).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(*[F.sum(n).alias(f"_t_{n}") for n in sums])
        .select("_range", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    )
    within = Window.partitionBy("_range").orderBy(order(value)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # At most ``ranges`` rows on the broadcast side.
    return (
        ranged.withColumns({f"_w_{n}": F.sum(n).over(within) for n in sums})
        .join(F.broadcast(starts), "_range")
        .select(value, *sums, *[(F.col(f"_w_{n}") + F.col(f"_b_{n}")).alias(f"cum_{n}") for n in sums])
    )


def percentile_name(q: float) -> str:
    """p50 for 0.5, p99 for 0.99, p99_4 for 0.994."""
    return "p" + f"{q * 100:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def floor_percentiles(df: DataFrame, column: str, quantiles: Sequence[float]) -> DataFrame:
    """One row: for each q the element ``floor(n * q)`` (from 0) of the sorted values, and ``n``.

    Nulls are left out; an empty input gives nulls and n = 0.
    """
    kind = df.schema[column].dataType.simpleString()
    wanted = {percentile_name(q): (column, lambda n, q=q: math.floor(n * q) + 1) for q in quantiles}
    found, n = values_at(df, wanted)
    schema = ", ".join([f"{name} {kind}" for name in wanted] + ["n long"])
    return df.sparkSession.createDataFrame([(*[found[name] for name in wanted], n[column])], schema)


def quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5, accuracy: int = 10_000) -> dict[str, object]:
    """The exact q-quantile of each column: the smallest value with at least q * n values at or below it; null if there are none."""
    wanted = {c: (c, lambda n: max(1, math.ceil(q * n - 1e-9))) for c in columns}
    return values_at(df, wanted, accuracy)[0]


def values_at(
    df: DataFrame, wanted: Mapping[str, tuple[str, Callable[[int], int]]], accuracy: int = 10_000
) -> tuple[dict[str, object], dict[str, int]]:
    """Exact order statistics: per name the value of a rank (from 1) of a column, and per column the number of values.

    ``wanted`` names a column and a function from the number of values to the
    rank; a rank beyond that number gives null.  A sketch gives two values that
    surely enclose the rank.  Counting what lies below, at and between them
    either shows that one of the two has the rank, or leaves a small part of the
    values strictly between them, on which the next round works, until the
    sketch is exact for what is left.  So a value of any weight costs one round.
    All names share the passes, two per round; the rounds grow with the
    logarithm of the size.  Only the enclosing values come to the driver.
    """
    low: dict[str, object] = dict.fromkeys(wanted)
    high: dict[str, object] = dict.fromkeys(wanted)
    found: dict[str, object] = {}
    sizes: dict[str, int] = {}
    while todo := [name for name in wanted if name not in found]:
        inside, counts = {}, []
        for k, name in enumerate(todo):
            c = F.col(wanted[name][0])
            inside[name] = c.isNotNull()
            if df.schema[wanted[name][0]].dataType.typeName() in ("float", "double"):
                inside[name] &= ~F.isnan(c)  # above all numbers; the sketch does not order it
            below = first = last = F.lit(0)
            if low[name] is not None:
                a, b = F.lit(low[name]), F.lit(high[name])
                inside[name] &= (c > a) & (c < b)
                below, first, last = F.count_if(c < a), F.count_if(c == a), F.count_if(c == b)
            m = F.count_if(inside[name])
            seen = {"n": F.count(c), "below": below, "first": first, "m": m, "last": last}
            counts.append(F.struct(*[x.alias(key) for key, x in seen.items()]).alias(f"_{k}"))
        seen, asked = df.agg(*counts).first(), []
        for k, name in enumerate(todo):
            column, rank_of = wanted[name]
            n, m = seen[k]["n"], seen[k]["m"]
            sizes[column] = n
            rank = rank_of(n)
            if not 1 <= rank <= n:
                found[name] = None
                continue
            rank -= seen[k]["below"] + seen[k]["first"]  # from 1 among the values inside
            if low[name] is not None and (rank < 1 or rank > m):
                found[name] = low[name] if rank < 1 else high[name]
                continue
            if rank > m:
                found[name] = math.nan
                continue
            at, sure = (rank - 0.5) / m, m <= accuracy
            slack = 0.0 if sure else 2.0 / accuracy
            points = [max(0.0, at - slack), min(1.0, at + slack)]
            # Four times the number of values: the sketch is off by less than one rank.
            fine = 4 * accuracy if sure else accuracy
            asked.append((name, sure, F.percentile_approx(F.when(inside[name], F.col(column)), points, fine).alias(f"_{k}")))
        if not asked:
            break
        for (name, sure, _), (a, b) in zip(asked, df.agg(*[x for *_, x in asked]).first()):
            if sure or a == b:
                found[name] = a
            low[name], high[name] = a, b
    return found, sizes


def few_rows(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df``, to be broadcast if it is known to have at most ``most`` rows; joined like any other table if not."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def pick_by_hash(
    df: DataFrame,
    id_col: str,
    k: Column,
    by: Sequence[str] = (),
    seed: str = "",
) -> DataFrame:
    """All rows with ``picked``: exactly ``k`` rows per stratum, those of smallest hash.

    ``k`` is the same for all rows of a stratum.  Rows are ordered by (md5 of
    seed and id, id).  Counts per hash prefix tell which prefix a stratum's
    limit falls in; only the rows of that one prefix are ranked, all others are
    decided by comparing prefixes.
    """
    by = list(by)
    digest = F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string")))
    hashed = df.withColumns({"_k": k.cast("long"), "_h": digest}).withColumn("_p", F.substring("_h", 1, 4))
    # At most 65,536 prefixes per stratum.
    counts = hashed.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_c"), F.max("_k").alias("_k"))
    through = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("_through") - F.col("_c")
    cut = (
        counts.withColumn("_through", F.sum("_c").over(through))
        .filter((F.col("_through") >= F.col("_k")) & (before < F.col("_k")))
        .select(*by, F.col("_p").alias("_cut"), (F.col("_k") - before).alias("_left"))
    )
    if by:
        placed = hashed.join(few_rows(cut), by, "left")
    else:
        one = cut.select(F.struct("_cut", "_left")).scalar()
        placed = hashed.withColumn("_limit", one).select("*", "_limit._cut", "_limit._left").drop("_limit")
    at_cut = F.coalesce(F.col("_p") == F.col("_cut"), F.lit(False))
    # No cut means the stratum has fewer rows than wanted (all are picked), or none is wanted.
    clear = F.when(F.col("_cut").isNull(), F.coalesce(F.col("_k") > 0, F.lit(False))).otherwise(
        F.col("_p") < F.col("_cut")
    )
    decided = placed.filter(~at_cut).withColumn("picked", clear)
    rank = F.row_number().over(Window.partitionBy(*by, "_p").orderBy("_h", F.col(id_col)))
    ranked = placed.filter(at_cut).withColumn("picked", rank <= F.col("_left"))
    return decided.unionByName(ranked).select(*df.columns, "picked")


def top_fraction_flag(
    df: DataFrame,
    score: str,
    id_col: str,
    fraction: float = 0.01,
    flag: str = "anomaly_label",
) -> DataFrame:
    """Flag exactly ``max(1, floor(n * fraction))`` rows of the highest scores.

    Ties at the border are settled by (md5 of the id, id).
    """
    top = lambda n: max(1, math.floor(n * fraction))
    found, sizes = values_at(df, {"border": (score, lambda n: n - top(n) + 1)})
    border = found["border"]
    if border is None:
        return df.withColumn(flag, F.lit(0))
    at, tie = F.lit(border), F.coalesce(F.col(score) == F.lit(border), F.lit(False))
    above = df.agg(F.count_if(F.col(score) > at)).first()[0]
    clear = df.filter(~tie).withColumn("picked", F.coalesce(F.col(score) > at, F.lit(False)))
    ties = pick_by_hash(df.filter(tie), id_col, F.lit(top(sizes[score]) - above))
    return clear.unionByName(ties).withColumn(flag, F.col("picked").cast("int")).drop("picked")
