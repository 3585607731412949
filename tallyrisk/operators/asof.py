"""Point-in-time join: the newest feature row at or before each row's time.

A window over a whole entity would put a hot entity in one task.  Time is cut
in short slices and the window partition is (entity, slice).  What a slice
needs from its past is one row, the newest earlier feature row, which is
carried over a table with one row per entity and slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_S = 900
#: Left rows for each task of a many-table join.
TASK_ROWS = 100_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    features: Sequence[str] | None = None,
    ttl_s: int | None = None,
    prefix: str = "",
    tie: Sequence[str] = (),
    slice_s: int = SLICE_S,
) -> DataFrame:
    """Every left row with the feature columns of its newest right row (or nulls).

    A right row qualifies when its keys are equal, its time is at or before the
    left time and, with ``ttl_s``, at most that many seconds older.  Among right
    rows of the same time the highest ``tie`` values win.
    """
    by = list(by)
    features = [c for c in (features or right.columns) if c not in by]
    micros = lambda name: F.unix_micros(F.col(name).cast("timestamp"))
    slice_of = lambda name: F.floor(micros(name) / (slice_s * 1_000_000)).cast("long")

    facts = right.filter(F.col(right_ts).isNotNull())
    for key in by:
        facts = facts.filter(F.col(key).isNotNull())
    tie_key = F.struct(*[F.col(c) for c in tie]) if tie else F.struct(F.lit(0).alias("none"))
    facts = facts.select(
        *by,
        slice_of(right_ts).alias("_slice"),
        micros(right_ts).alias("_at"),
        tie_key.alias("_tie"),
        F.struct(micros(right_ts).alias("_at"), *[F.col(c).alias(c) for c in features]).alias("_fact"),
    )
    rows = left.select(
        *by,
        slice_of(left_ts).alias("_slice"),
        micros(left_ts).alias("_at"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_row"),
    )

    newest = facts.groupBy(*by, "_slice").agg(
        F.max_by("_fact", F.struct("_at", "_tie")).alias("_fact")
    )
    wanted = rows.select(*by, "_slice").distinct().withColumn("_wanted", F.lit(True))
    earlier = Window.partitionBy(*by).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        newest.unionByName(wanted, allowMissingColumns=True)
        .withColumn("_past", F.last("_fact", ignorenulls=True).over(earlier))
        .filter(F.col("_wanted") & F.col("_past").isNotNull())
        .select(*by, "_slice", F.col("_past._at").alias("_at"), F.col("_past").alias("_fact"))
    )

    # Feature rows sort before left rows of the same time: _row null comes first.
    both = rows.unionByName(facts, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*by, "_slice")
        .orderBy("_at", F.col("_row").isNotNull(), F.col("_tie").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("_hit", F.last("_fact", ignorenulls=True).over(so_far)).filter(
        F.col("_row").isNotNull()
    )
    if ttl_s is not None:
        fresh = F.col("_at") - F.col("_hit._at") <= F.lit(ttl_s * 1_000_000)
        found = found.withColumn("_hit", F.when(fresh, F.col("_hit")))
    return found.select(
        *[F.col("_row")[c].alias(c) for c in left.columns],
        *[F.col("_hit")[c].alias(f"{prefix}{c}") for c in features],
    )


@dataclass(frozen=True)
class Side:
    """A feature table of a many-table join: keys, time, features, time to live, tie columns, and a name of its own."""

    name: str
    table: DataFrame
    by: tuple[str, ...]
    ts: str
    features: tuple[str, ...]
    ttl_s: int | None = None
    tie: tuple[str, ...] = ()


def asof_many(
    left: DataFrame, row_id: str, left_ts: str, sides: Sequence[Side], slice_s: int = SLICE_S, tasks: int | None = None
) -> DataFrame:
    """Every left row with one struct column per side: its newest row as of the left time, or null.

    Feature names are unique across sides by the struct they are in.  ``row_id``
    is unique in ``left``.  Only (keys, time, row id) of the left rows meet the
    features: tables with the same keys share one union and one window, and the
    wide left rows move once, to be joined by row id.  Left rows without a time
    or a key find nothing and take no part.

    The left rows are counted first: with them grows the number of tasks, not what
    one task sorts.  ``tasks`` sets that number, for features far longer than ``left``.
    """
    if tasks is None:
        tasks = max(left.sparkSession.sparkContext.defaultParallelism, -(-left.count() // TASK_ROWS))
    hits = None
    for by in dict.fromkeys(side.by for side in sides):
        found = _hits(left, row_id, left_ts, by, [s for s in sides if s.by == by], slice_s, tasks)
        hits = found if hits is None else hits.unionByName(found, allowMissingColumns=True)
    # Dealt before they are merged: a task that looks up would sort its hits once more for nothing.
    merged = hits.repartition(tasks, "_id").groupBy("_id").agg(*[F.first(s.name, ignorenulls=True).alias(s.name) for s in sides])
    return left.repartition(tasks, row_id).join(merged, F.col(row_id) == F.col("_id"), "left").drop("_id")


def _hits(
    left: DataFrame, row_id: str, left_ts: str, by: Sequence[str], sides: Sequence[Side], slice_s: int, tasks: int
) -> DataFrame:
    """_id and a struct per side, for left rows that have a key and a time and find something."""
    micros = lambda name: F.unix_micros(F.col(name).cast("timestamp"))
    keys = [f"_k{n}" for n in range(len(by))]

    def placed(df: DataFrame, ts: str, *more: Column) -> DataFrame:
        for c in (*by, ts):
            df = df.filter(F.col(c).isNotNull())
        slices = F.floor(micros(ts) / (slice_s * 1_000_000)).cast("long")
        return df.select(*[F.col(c).alias(k) for k, c in zip(keys, by)], slices.alias("_slice"), micros(ts).alias("_at"), *more)

    rows = placed(left, left_ts, F.col(row_id).alias("_id"))
    facts, ties = None, [[f"_tie{n}"] if side.tie else [] for n, side in enumerate(sides)]
    for side, tie in zip(sides, ties):
        fact = F.struct(micros(side.ts).alias("_at"), *side.features).alias(side.name)
        part = placed(side.table, side.ts, fact, *[F.struct(*side.tie).alias(t) for t in tie])
        facts = part if facts is None else facts.unionByName(part, allowMissingColumns=True)

    names = [s.name for s in sides]
    newest = facts.repartition(tasks, *keys, "_slice").groupBy(*keys, "_slice").agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.struct("_at", *t))).alias(n) for n, t in zip(names, ties)]
    )
    wanted = rows.select(*keys, "_slice").repartition(tasks, *keys, "_slice").distinct().withColumn("_wanted", F.lit(True))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        newest.unionByName(wanted, allowMissingColumns=True)
        .repartition(tasks, *keys)
        .select(*keys, "_slice", "_wanted", *[F.last(n, ignorenulls=True).over(earlier).alias(n) for n in names])
        .filter(F.col("_wanted"))
        .drop("_wanted")
    )

    # What is carried has no time and sorts first; features sort before left rows of the same time.
    both = rows.unionByName(facts, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    both = both.repartition(tasks, *keys, "_slice")
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(F.col("_at").asc_nulls_first(), F.col("_id").isNotNull(), *[F.col(t).asc_nulls_first() for tie in ties for t in tie])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.select("_id", "_at", *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names])
    fresh = [
        F.col(s.name) if s.ttl_s is None else F.when(F.col("_at") - F.col(s.name)["_at"] <= s.ttl_s * 1_000_000, F.col(s.name)).alias(s.name)
        for s in sides
    ]
    return found.filter(F.col("_id").isNotNull()).select("_id", *fresh)
