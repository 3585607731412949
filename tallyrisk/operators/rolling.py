"""Exact time-range aggregates per entity, with bounded work per task.

Frame: all rows of the entity with ``second - N <= their second <= second``,
both ends included, so rows of the same second count each other.

A plain ``RANGE BETWEEN N PRECEDING AND CURRENT ROW`` window sends a whole
entity to one task and re-reads the frame for every row, which fails for an
entity that holds a large share of the table.  Rows of one entity and second
share their results, so the work is done on that grain instead:

1. partial aggregates per (entity, second), combined before the shuffle;
2. time is cut in chunks at least as long as the longest frame; partials near a
   chunk's end also go to the next chunk as look-back, so a window partition is
   (entity, chunk) and holds a bounded number of seconds, whatever the entity's
   row count;
3. a frame is the running total up to the row minus the running total up to
   the row before the frame: two growing frames, linear in the partition;
4. results are joined back to the rows on (entity, second), where the adaptive
   skew join can split any hot second.

Differences of running totals lose digits when a frame is small beside what came
before it.  Each addend is therefore split in a high part, whose sums are exact
in double arithmetic, and a small rest; squares are taken around the chunk mean.

Distinct counts are running totals too.  An occurrence of an (entity, partner)
pair opens a run if the pair did not occur within N seconds before it, and closes
one if the pair does not occur within N seconds after it.  The partners in a frame
are the runs opened up to its end less the runs closed before its start.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from tallyrisk.functions.timestamps import epoch_seconds

SECOND = "_epoch_s"
HOUR_S = 3600
DAY_S = 86400
_ROUNDING = "1e-14D"
_HIGH = str(2**32)
_UNBOUNDED = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


@dataclass(frozen=True)
class Rolling:
    """One output column: ``fn`` in count, sum, mean, std (sample), distinct."""

    name: str
    fn: str
    seconds: int
    column: str | None = None


@dataclass(frozen=True)
class _Chunks:
    """How time is cut: chunk length and look-back, in seconds, as SQL expressions."""

    longest: int

    @property
    def length(self) -> int:
        # Longer chunks copy fewer rows; about a month bounds a partition's seconds.
        return max(self.longest, min(4 * self.longest, 32 * DAY_S))

    @property
    def own(self) -> str:
        # A null second keeps its own place: first in chunk 0.
        return f"coalesce(floor({SECOND} / {self.length}), 0L)"

    @property
    def copied(self) -> str:
        """Whether the row is look-back of the next chunk."""
        return f"coalesce({SECOND} - {self.own} * {self.length} >= {self.length - self.longest}, false)"

    @property
    def place(self) -> str:
        return f"explode(if({self.copied}, array({self.own}, {self.own} + 1), array({self.own}))) AS _chunk"


def _measures(specs: Sequence[Rolling], *fns: str) -> list[str]:
    return list(dict.fromkeys(s.column for s in specs if s.fn in fns))


def _runs(rows: DataFrame, entity: str, spec: Rolling, chunks: _Chunks, gap: int) -> DataFrame:
    """Per pair occurrence: does it open a run (``_u``, and ``_w`` seen from the next chunk), or close one (``_v``).

    Each occurrence stands where its partials will stand.  Its predecessor is
    found in the same chunk, its successor in the last chunk it stands in.
    """
    name = spec.name
    by_pair = f"OVER (PARTITION BY `{entity}`, `{spec.column}`, _chunk ORDER BY {SECOND})"
    opens = f"if(coalesce(_since <= {gap}, false), 0L, 1L)"
    closes = f"if(coalesce(_until <= {gap}, false), 0L, 1L)"
    return (
        rows.where(f"`{spec.column}` IS NOT NULL")
        .select(entity, spec.column, SECOND)
        .distinct()
        .selectExpr("*", chunks.place)
        .selectExpr(
            f"`{entity}`",
            SECOND,
            f"_chunk = {chunks.own} AS _own",
            f"{SECOND} - lag({SECOND}) {by_pair} AS _since",
            f"lead({SECOND}) {by_pair} - {SECOND} AS _until",
        )
        .selectExpr(
            f"`{entity}`",
            SECOND,
            f"if(_own, {opens}, null) AS _u_{name}",
            f"if(_own, null, {opens}) AS _w_{name}",
            f"if(_own AND {chunks.copied}, null, {closes}) AS _v_{name}",
        )
    )


def _per_second(rows: DataFrame, entity: str, specs: Sequence[Rolling], chunks: _Chunks, back: int) -> DataFrame:
    """One row per (entity, second): counts, sums and centred squares per measure, run counts per distinct."""
    kinds = {f.name: f.dataType for f in rows.schema}
    aggs = ["count(_row) AS _n"]
    for m in _measures(specs, "sum", "mean", "std"):
        aggs.append(f"count(`{m}`) AS _n_{m}")
        if not isinstance(kinds[m], (DoubleType, FloatType)):
            # Integers and decimals are summed exactly.
            if not isinstance(kinds[m], (IntegralType, DecimalType)):
                raise TypeError(f"column {m} is {kinds[m].simpleString()}, not a number")
            exact = f"`{m}`" if isinstance(kinds[m], DecimalType) else f"bigint(`{m}`)"
            aggs.append(f"sum({exact}) AS _s_{m}")
            if m in _measures(specs, "std"):
                aggs.append(f"var_pop(double(`{m}`)) * count(`{m}`) AS _m2_{m}")
            continue
        # Whether +inf (or NaN) and -inf (or NaN) occur: two counters in one number,
        # each at most the seconds of a window partition.
        high = f"isnan(`{m}`) OR `{m}` = double('inf')"
        low = f"isnan(`{m}`) OR `{m}` = double('-inf')"
        finite = f"FILTER (WHERE NOT ({high} OR {low}))"
        aggs.append(f"sum(`{m}`) {finite} AS _s_{m}")
        aggs.append(f"{_HIGH}L * int(coalesce(bool_or({high}), false)) + int(coalesce(bool_or({low}), false)) AS _odd_{m}")
        if m in _measures(specs, "std"):
            aggs.append(f"var_pop(`{m}`) {finite} * count(`{m}`) {finite} AS _m2_{m}")
    for spec in specs:
        if spec.fn == "distinct":
            runs = _runs(rows, entity, spec, chunks, spec.seconds - back)
            aggs += [f"sum({c}_{spec.name}) AS {c}_{spec.name}" for c in ("_u", "_w", "_v")]
            rows = rows.unionByName(runs, allowMissingColumns=True)
    return rows.groupBy(entity, SECOND).agg(*[F.expr(a) for a in aggs])


def _centred(parts: DataFrame, measures: Sequence[str], window: str) -> DataFrame:
    """First and second moments of each partial around the mean of its (entity, chunk)."""
    if not measures:
        return parts
    whole = f"OVER ({window} {_UNBOUNDED})"
    mids, moments = [], []
    for m in measures:
        mids.append(f"sum(double(_s_{m})) {whole} / nullif(sum(_n_{m}) {whole}, 0) AS _mid_{m}")
        off = f"(double(_s_{m}) - _n_{m} * _mid_{m})"
        moments += [f"{off} AS _c1_{m}", f"_m2_{m} + {off} * {off} / nullif(_n_{m}, 0) AS _c2_{m}"]
    return parts.selectExpr("*", *mids).selectExpr("*", *moments)


def _split(parts: DataFrame, columns: Sequence[str], window: str) -> DataFrame:
    """Each addend as ``_high`` (a multiple of one fixed step, so sums are exact) and ``_rest``."""
    if not columns:
        return parts
    steps, highs, rests = [], [], []
    for c in columns:
        size = f"nullif(sum(abs({c})) OVER ({window} {_UNBOUNDED}), 0D)"
        steps.append(f"pow(2D, ceil(log2(coalesce({size}, 1D))) + 1) AS _step{c}")
        highs.append(f"({c} + _step{c}) - _step{c} AS {c}_high")
        rests.append(f"{c} - {c}_high AS {c}_rest")
    return parts.selectExpr("*", *steps).selectExpr("*", *highs).selectExpr("*", *rests)


class _Frames:
    """The growing frames a set of outputs needs, and their differences, as SQL expressions."""

    def __init__(self, window: str, split: Sequence[str], back: int):
        self.window, self.split, self.back = window, split, back
        self.sums: dict[str, str] = {}
        self.totals: dict[str, str] = {}

    def _sum(self, column: str, behind: int) -> str:
        """The column's total over all seconds up to ``behind`` seconds ago."""
        name = f"_to{behind}{column}"
        end = f"{behind} PRECEDING" if behind else "CURRENT ROW"
        frame = f"RANGE BETWEEN UNBOUNDED PRECEDING AND {end}"
        self.sums.setdefault(name, f"sum({column}) OVER ({self.window} {frame}) AS {name}")
        return f"coalesce({name}, 0)"

    def total(self, column: str, seconds: int, gone: str | None = None) -> str:
        """Sum of ``column`` up to the frame's end less the sum of ``gone`` before its start."""
        name = f"_t{seconds}{column}"
        if name not in self.totals:
            pieces = [f"{column}_high", f"{column}_rest"] if column in self.split else [column]
            upto = [self._sum(p, self.back) for p in pieces]
            before = [self._sum(gone or p, seconds + 1) for p in pieces]
            # Rows without a time are peers of each other only.
            parts = [f"({u} - if({SECOND} IS NULL, 0, {b}))" for u, b in zip(upto, before)]
            self.totals[name] = f"{' + '.join(parts)} AS {name}"
        return name

    def output(self, spec: Rolling, floating: bool) -> str:
        m, seconds = spec.column, spec.seconds
        if spec.fn == "count":
            return self.total("_n", seconds)
        if spec.fn == "distinct":
            return self.total(f"_u_{spec.name}", seconds, gone=f"_v_{spec.name}")
        n = self.total(f"_n_{m}", seconds)
        enough = f"{n} > 0"
        if spec.fn == "std":
            enough = f"{n} > 1"
            c1, c2 = self.total(f"_c1_{m}", seconds), self.total(f"_c2_{m}", seconds)
            # Below the rounding of its two terms the spread is zero.
            spread = f"({c2} - {c1} * {c1} / nullif({n}, 0))"
            spread = f"if({spread} > {c2} * {_ROUNDING}, {spread}, 0D)"
            value = f"sqrt({spread} / nullif({n} - 1, 0))"
        else:
            value = self.total(f"_s_{m}", seconds)
            if spec.fn == "mean":
                value = f"double({value}) / nullif({n}, 0)"
        if floating:
            odd = self.total(f"_odd_{m}", seconds)
            inf = "NaN" if spec.fn == "std" else "inf"
            value = (
                f"CASE WHEN {odd} = 0 THEN {value} WHEN {odd} >= {_HIGH} AND {odd} % {_HIGH} > 0 THEN double('NaN') "
                f"WHEN {odd} >= {_HIGH} THEN double('{inf}') ELSE -double('{inf}') END"
            )
        return f"if({enough}, {value}, null)"


def rolling_by_second(
    df: DataFrame,
    entity: str,
    ts: str,
    specs: Sequence[Rolling],
    include_current: bool = True,
) -> DataFrame:
    """The aggregates per (entity, second): columns entity, ``_epoch_s`` and one per spec.

    ``include_current=False`` ends the frame one second before the row.
    """
    back = 0 if include_current else 1
    chunks = _Chunks(max(s.seconds for s in specs))
    columns = [c for c in dict.fromkeys(s.column for s in specs if s.column) if c != entity]
    rows = df.select(entity, epoch_seconds(F.col(ts)).alias(SECOND), *columns, F.lit(1).alias("_row"))
    parts = _per_second(rows, entity, specs, chunks, back).selectExpr("*", chunks.place)
    opened = [s.name for s in specs if s.fn == "distinct"]
    if opened:
        parts = parts.withColumns({f"_u_{n}": F.expr(f"if(_chunk = {chunks.own}, _u_{n}, _w_{n})") for n in opened})

    window = f"PARTITION BY `{entity}`, _chunk ORDER BY {SECOND}"
    squared = _measures(specs, "std")
    floating = [m for m in _measures(specs, "sum", "mean", "std") if f"_odd_{m}" in parts.columns]
    addends = [f"_s_{m}" for m in _measures(specs, "sum", "mean") if m in floating]
    addends += [f"{c}_{m}" for m in squared for c in ("_c1", "_c2")]
    parts = _split(_centred(parts, squared, window), addends, window)

    frames = _Frames(window, addends, back)
    outputs = [f"{frames.output(s, s.column in floating)} AS `{s.name}`" for s in specs]
    return (
        parts.selectExpr(f"`{entity}`", SECOND, f"_chunk = {chunks.own} AS _own", *frames.sums.values())
        .where("_own")
        .selectExpr(f"`{entity}`", SECOND, *frames.totals.values())
        .selectExpr(f"`{entity}`", SECOND, *outputs)
    )


def rolling(
    df: DataFrame,
    entity: str,
    ts: str,
    specs: Sequence[Rolling],
    include_current: bool = True,
    per_entity: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``df`` with one more column per spec; null entities form one group.

    ``per_entity`` may hold more columns, one row per entity.  They are joined
    to the narrow per-second table, so that the wide rows are joined only once.
    """
    per_second = rolling_by_second(df, entity, ts, specs, include_current)
    if per_entity is not None:
        per_second = per_second.join(per_entity, entity, "left")
    per_second = per_second.withColumnsRenamed({entity: "_r_entity", SECOND: "_r_second"})
    rows = df.withColumn(SECOND, epoch_seconds(F.col(ts)))
    same = rows[entity].eqNullSafe(per_second["_r_entity"]) & rows[SECOND].eqNullSafe(per_second["_r_second"])
    return rows.join(per_second, same, "left").drop("_r_entity", "_r_second", SECOND)


def velocity(
    df: DataFrame,
    entity: str = "customer_id",
    ts: str = "transaction_ts",
    amount: str = "amount_usd",
    hours: Sequence[int] = (1, 6, 24),
    include_current: bool = True,
    per_entity: DataFrame | None = None,
) -> DataFrame:
    """Count and amount sum of the entity over the last k hours, for each k."""
    specs = []
    for h in hours:
        specs.append(Rolling(f"customer_tx_count_{h}h", "count", h * HOUR_S))
        specs.append(Rolling(f"customer_tx_amount_sum_{h}h", "sum", h * HOUR_S, amount))
    return rolling(df, entity, ts, specs, include_current, per_entity)
