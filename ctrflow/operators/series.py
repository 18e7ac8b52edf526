"""Windows over cumulative counters: latest value, increase, rate, delta.

A series is long: ``metric``, label columns, ``ts``, ``value``. A *step* is the change
from the previous sample of the same series, dated at the later one; a negative step is a
counter reset and counts as the new value; the first sample's step is 0. A frame is
``[t - w, t]``, closed at both ends, and nothing is extrapolated to its edges, unless asked for (``extrapolated``).

A single busy series can hold much of the data, so no window is partitioned by
series alone: each series is cut into time slabs, and a slab is given the samples it needs from
before its start (those within one frame, and the last one before these).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.functions.scalars import micros

SECOND = 1_000_000
SLAB_ROWS = 2_000_000
_T, _SLAB, _HALO = "__t", "__slab", "__halo"


def _floor_div(t: Column, by: int) -> Column:
    """Whole-number quotient, exact for times in microseconds."""
    return ((t - F.pmod(t, F.lit(by))) / F.lit(by)).cast("bigint")


def counter_latest(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Value at the latest time per key."""
    return series.groupBy(*by).agg(F.max_by("value", "ts").alias("value"))


def _slabs(series: DataFrame, key: Sequence[str], slab_us: int, frame_us: int) -> DataFrame:
    """Cut each series into slabs and add the samples each needs from before its start.

    The last sample before a slab's halo may be any time back. It is found from one
    row per slab: the last sample of the slab, and the last one outside the next halo.
    """
    base = series.withColumn(_T, micros(F.col("ts")))
    slab = _floor_div(F.col(_T), slab_us)
    home = base.withColumn(_SLAB, slab).withColumn(_HALO, F.lit(False))
    if frame_us:
        ahead = _floor_div(F.col(_T) + frame_us, slab_us)
        home = home.withColumn(_SLAB, F.explode(F.sequence(F.col(_SLAB), ahead))).withColumn(
            _HALO, F.col(_SLAB) != slab
        )
    sample = F.struct(_T, *[c for c in series.columns])
    start_next = (slab + 1) * slab_us
    ends = (
        base.groupBy(*key, slab.alias(_SLAB))
        .agg(
            F.max_by(sample, F.col(_T)).alias("any"),
            F.max_by(sample, F.when(F.col(_T) < start_next - frame_us, F.col(_T))).alias("early"),
        )
    )
    # One row per series and slab. The sample before a slab's halo: the early one of the
    # slab just before, else the last of an older slab.
    by = Window.partitionBy(*key).orderBy(_SLAB)
    older = F.lag("any").over(by)
    prev_slab, prev_any, prev_early = F.lag(_SLAB).over(by), older, F.lag("early").over(by)
    prev_prev = F.lag("any", 2).over(by)
    adjacent = prev_slab == F.col(_SLAB) - 1
    before = F.when(adjacent, F.coalesce(prev_early, prev_prev)).otherwise(prev_any)
    # a slab with no sample of its own is never evaluated, so it needs none from before
    carried = ends.withColumn("s", before).where("s is not null").select(
        *[F.col("s." + c).alias(c) for c in series.columns],
        F.col("s." + _T).alias(_T),
        F.col(_SLAB),
        F.lit(True).alias(_HALO),
    )
    return home.unionByName(carried)


def _slab_us(
    series: DataFrame, key: Sequence[str], frame_seconds: int, slab_seconds: int | None
) -> int:
    """Slab length. Unless it is given: a day, or 20 frames if that is more, or as much
    less as keeps the fullest slab near ``SLAB_ROWS`` samples, but never under one frame."""
    if slab_seconds is not None:
        return slab_seconds * SECOND
    length = max(86_400, 20 * frame_seconds)
    slab = _floor_div(micros(F.col("ts")), length * SECOND).alias(_SLAB)
    fullest = series.groupBy(*key, slab).count().agg(F.max("count")).first()[0] or 0
    return max(frame_seconds, length // max(1, -(-fullest // SLAB_ROWS)), 1) * SECOND


def _step() -> tuple[Column, Column]:
    prev = F.col("__prev")
    change = F.col("value") - prev
    return prev, F.when(prev.isNull(), F.lit(0)).when(change < 0, F.col("value")).otherwise(change)


def _in_frames(rows: DataFrame, key: Sequence[str], frame_us: int, of) -> DataFrame:
    """Add what a frame ``[t - w, t]`` holds as two structs: ``__in`` of its own cell of time, ``__from`` of the cell before.

    Cells are as long as a frame, which so lies in two of them: it is what its own cell holds up to the sample, and what the
    cell before holds after the last sample that has left. In a sweep over time each sample comes, and leaves a frame
    later; what remains of its cell is carried to the samples after that. Nothing is subtracted, and a sample costs
    the same however many a frame holds. ``of(upto, later, cell)`` gives the three structs of a sample in these windows.
    """
    width = frame_us + 1  # the first instant whose frame does not hold a sample any more
    cell = Window.partitionBy(*key, _SLAB, "__cell")
    in_time = cell.orderBy(_T)
    upto = in_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    later = cell.orderBy(F.desc(_T)).rangeBetween(Window.unboundedPreceding, -1)
    held, remains, whole = of(upto, later, cell)
    rows = rows.withColumn("__cell", _floor_div(F.col(_T), width)).withColumns(
        {"__in": held, "__remains": remains, "__whole": whole, "__nth": F.row_number().over(in_time)}
    )

    def event(at, turn, carried):
        return F.struct(at.alias("at"), F.lit(turn).alias("turn"), carried.alias("carried"))

    t, own = F.col(_T), F.col("__cell")
    begins = F.when(F.col("__nth") == 1, event((own + 1) * F.lit(width), 0, F.struct(own.alias("cell"), F.col("__whole").alias("x"))))
    leaves = event(t + F.lit(width), 1, F.struct(own.alias("cell"), F.col("__remains").alias("x")))
    comes = event(t, 2, F.when(F.lit(False), F.struct(own.alias("cell"), F.col("__whole").alias("x"))))
    swept = rows.withColumn("__e", F.explode(F.array_compact(F.array(begins, leaves, comes)))).drop("__remains", "__whole", "__nth")
    sweep = Window.partitionBy(*key, _SLAB).orderBy("__e.at", "__e.turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.withColumn("__c", F.last("__e.carried", ignorenulls=True).over(sweep)).where("__e.turn = 2")
    before = F.when(F.col("__c.cell") == F.col("__cell") - 1, F.col("__c.x"))
    return swept.withColumn("__from", before).drop("__e", "__c", "__cell")


def _framed(
    series: DataFrame, key: Sequence[str], frame_seconds: int, slab_seconds: int | None, add
) -> DataFrame:
    frame_us = frame_seconds * SECOND
    slab_us = _slab_us(series, key, frame_seconds, slab_seconds)
    if frame_us > slab_us:
        raise ValueError("a slab must be at least as long as the frame")
    rows = _slabs(series, key, slab_us, frame_us)
    in_order = Window.partitionBy(*key, _SLAB).orderBy(_T)
    rows = rows.withColumn("__prev", F.lag("value").over(in_order))
    rows = rows.withColumn("__step", _step()[1])
    out = add(rows, frame_us).where(~F.col(_HALO))
    return out.drop(_T, _SLAB, _HALO, "__prev", "__step", "__in", "__from")


def steps(
    series: DataFrame, key: Sequence[str], slab_seconds: int | None = None, name: str = "step"
) -> DataFrame:
    """Add the step of each sample."""
    return _framed(series, key, 0, slab_seconds, lambda r, f: r.withColumn(name, F.col("__step")))


def increase_at(
    series: DataFrame, key: Sequence[str], frame_seconds: int, slab_seconds: int | None = None
) -> DataFrame:
    """Add, per sample, the ``increase`` over the frame that ends there."""

    def sums(*windows):
        return [F.struct(F.sum("__step").over(w).alias("s")) for w in windows]

    def add(rows, frame_us):
        own, older = F.col("__in.s"), F.col("__from.s")
        return _in_frames(rows, key, frame_us, sums).withColumn("increase", F.coalesce(own + older, own, older))

    return _framed(series, key, frame_seconds, slab_seconds, add)


def rate_at(
    series: DataFrame, key: Sequence[str], frame_seconds: int, slab_seconds: int | None = None
) -> DataFrame:
    """Add, per sample, the ``rate`` per second over the frame that ends there."""
    out = increase_at(series, key, frame_seconds, slab_seconds)
    return out.withColumn("rate", F.col("increase") / F.lit(frame_seconds)).drop("increase")


def delta_at(
    series: DataFrame, key: Sequence[str], frame_seconds: int, slab_seconds: int | None = None
) -> DataFrame:
    """Add, per sample, ``delta``: last minus first value in the frame, null below two samples."""

    def firsts(upto, later, cell):
        # the sample carried in from before the halo lies outside every frame
        values = (upto, F.first("value").over(upto)), (later, F.last("value").over(later)), (cell, F.col("value"))
        return [F.struct(F.count(F.lit(1)).over(w).alias("n"), v.alias("v")) for w, v in values]

    def add(rows, frame_us):
        older = F.coalesce("__from.n", F.lit(0))
        first = F.when(older > 0, F.col("__from.v")).otherwise(F.col("__in.v"))
        rows = _in_frames(rows, key, frame_us, firsts)
        return rows.withColumn("delta", F.when(older + F.col("__in.n") >= 2, F.col("value") - first))

    return _framed(series, key, frame_seconds, slab_seconds, add)


def increase(
    series: DataFrame,
    key: Sequence[str],
    frame_seconds: int,
    by: Sequence[str],
    every_seconds: int | None = None,
    slab_seconds: int | None = None,
    extrapolate: bool = False,
) -> DataFrame:
    """``sum(increase)`` by label at instants ``every_seconds`` apart: ``(by..., at, increase)``.

    ``at`` is in seconds since 1970. Each step is sent to the instants whose frame
    holds it, so the sums are pre-aggregated before the shuffle. With ``extrapolate`` the series'
    increases are carried on to the frame's edges first (``extrapolated``).
    """
    if extrapolate:
        each = extrapolated(series, key, frame_seconds, "increase", every_seconds, slab_seconds)
        return each.groupBy(*by, "at").agg(F.sum("value").alias("increase"))
    every_us, frame_us = (every_seconds or frame_seconds) * SECOND, frame_seconds * SECOND
    t = micros(F.col("ts"))
    first, last = _floor_div(t + (every_us - 1), every_us), _floor_div(t + frame_us, every_us)
    stepped = steps(series, key, slab_seconds, "__s")
    return (
        stepped.where(first <= last)
        .select(*by, "__s", F.explode(F.sequence(first, last)).alias("__k"))
        .groupBy(*by, (F.col("__k") * F.lit(every_us // SECOND)).cast("bigint").alias("at"))
        .agg(F.sum("__s").alias("increase"))
    )


def extrapolated(
    series: DataFrame,
    key: Sequence[str],
    frame_seconds: int,
    kind: str = "increase",
    every_seconds: int | None = None,
    slab_seconds: int | None = None,
) -> DataFrame:
    """``increase``, ``rate`` or ``delta`` per series at instants, carried on to the frame's edges: ``(key..., at, value)``.

    The rule is PromQL's. The change between the first and the last sample of the frame is stretched to the
    frame's start and end, each unless it is 1.1 average sample distances or more away, and else by half such a
    distance. A counter (``increase``, ``rate``) is not carried back beyond where it would have been zero. Below two samples there
    is no value. Samples are sent to the instants whose frame holds them, and pre-aggregated per instant.
    """
    if kind not in ("increase", "rate", "delta"):
        raise ValueError(f"no such kind: {kind}")
    every_us, frame_us = (every_seconds or frame_seconds) * SECOND, frame_seconds * SECOND
    t = micros(F.col("ts"))
    first, last = _floor_div(t + (every_us - 1), every_us), _floor_div(t + frame_us, every_us)
    sample = F.struct(t.alias("t"), F.col("value").cast("double").alias("v"), F.col("__s").cast("double").alias("s"))
    sent = (
        steps(series, key, slab_seconds, "__s")
        .where(first <= last)
        .select(*key, sample.alias("x"), F.explode(F.sequence(first, last)).alias("k"))
        .groupBy(*key, "k")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min_by("x", "x.t").alias("a"), F.max_by("x", "x.t").alias("b"),
            F.sum("x.s").alias("s"),
        )
        .where("n > 1 and a.t < b.t")
    )
    counter = kind != "delta"
    change = F.col("s") - F.col("a.s") if counter else F.col("b.v") - F.col("a.v")
    end = F.col("k") * F.lit(every_us)
    framed = sent.select(
        *key, (F.col("k") * F.lit(every_us // SECOND)).cast("bigint").alias("at"), change.alias("change"),
        F.col("a.v").alias("zero"), (F.col("b.t") - F.col("a.t")).cast("double").alias("covered"),
        (F.col("a.t") - (end - frame_us)).cast("double").alias("before"), (end - F.col("b.t")).cast("double").alias("after"),
        (F.col("n") - 1).cast("double").alias("gaps"),
    )
    distance = F.col("covered") / F.col("gaps")

    def reach(c: str) -> Column:
        return F.when(F.col(c) >= 1.1 * distance, distance / 2).otherwise(F.col(c))

    before = reach("before")
    if counter:
        from_zero = F.when((F.col("change") > 0) & (F.col("zero") >= 0), F.col("covered") * F.col("zero") / F.col("change"))
        before = F.least(before, F.coalesce(from_zero, before))
    value = F.col("change") * ((F.col("covered") + before + reach("after")) / F.col("covered"))
    if kind == "rate":
        value = value / F.lit(float(frame_seconds))
    return framed.select(*key, "at", value.alias("value"))


def delta_ratio(
    series: DataFrame,
    labels: Sequence[str],
    frame_seconds: int,
    by: Sequence[str],
    over: str,
    per: str,
    scale: float = 1000.0,
    slab_seconds: int | None = None,
) -> DataFrame:
    """``avg(delta(over) / (1 + delta(per)) / scale)`` by label and time: mean cost per request.

    The two metrics meet by series and time in one aggregation, which keeps instants
    where both have a delta.
    """
    both = series.where(F.col("metric").isin(over, per))
    deltas = delta_at(both, ["metric", *labels], frame_seconds, slab_seconds)

    def of(metric):
        return F.max(F.when(F.col("metric") == metric, F.col("delta")))

    paired = (
        deltas.groupBy(*labels, "ts")
        .agg(of(over).alias("__o"), of(per).alias("__p"))
        .where("__o is not null and __p is not null")
    )
    ratio = F.col("__o") / (1 + F.col("__p")) / F.lit(scale)
    return paired.groupBy(*by, "ts").agg(F.avg(ratio).alias("value"))


def over_target(df: DataFrame, target: float, value: str = "value") -> DataFrame:
    """Rows whose metric exceeds its target."""
    return df.where(F.col(value) > target)
