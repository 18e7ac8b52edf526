"""Queries: ROC AUC, rolling AUC, alerts, runs, counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ctrflow.functions.scalars import micros
from ctrflow.operators import metrics, runs as run_ops, series as counters
from ctrflow.plans.fixtures import (
    SQL_ALERTS,
    SQL_RATIO_SERIES,
    SQL_RUNS,
    SQL_SCORED,
    SQL_SERIES,
    alert_rows,
    ratio_series,
    runs,
    scored,
    series,
    with_sql,
)
from ctrflow.plans.registry import query, rounded, sql_round

N = 200
ARRIVAL = ["ts", "event_id"]
HOURS6 = 6 * 3600


@query(
    "roc_auc",
    with_sql(
        SQL_SCORED,
        """g as (select round(predval * 500, 0) as s, sum(trueval) as pos, sum(1 - trueval) as neg
                 from scored group by 1)""",
        """c as (select pos, neg, sum(neg) over (order by s) - neg as below,
                 sum(pos) over () as p, sum(neg) over () as n from g)""",
        body=f"""select {sql_round('sum(pos * (below + neg / 2.0)) / (any_value(p) * any_value(n))', 9)} as auc,
          cast(any_value(p) as bigint) as n_pos, cast(any_value(n) as bigint) as n_neg from c""",
    ),
)
def roc_auc(spark, sf):
    rows = scored(spark, sf).withColumn("s", F.round(F.col("predval") * 500, 0))
    return rounded(metrics.roc_auc(rows, "trueval", "s"), "auc", digits=9)


@query(
    "class_counts",
    with_sql(SQL_SCORED, body="select trueval as label, count(*) as n from scored group by 1"),
)
def class_counts(spark, sf):
    return metrics.class_counts(scored(spark, sf), "trueval")


def _sql_rolling(body: str, key: str | None = None) -> str:
    """Rolling AUC by rank sums over the pairs (row, row in its window)."""
    number = (
        f"row_number() over (partition by {key} order by seq)" if key else "seq"
    )
    same = f"and b.{key} = a.{key}" if key else ""
    return with_sql(
        SQL_SCORED,
        f"s as (select event_id, model_key, trueval, predval, seq as arrival, {number} as n from scored)",
        f"""w as (select a.event_id, a.model_key, a.n, b.trueval as y, b.predval as p
             from s a join s b on b.n between a.n - {N - 1} and a.n {same})""",
        """ranked as (select event_id, model_key, n, y,
             rank() over (partition by event_id order by p)
             + (count(*) over (partition by event_id, p) - 1) / 2.0 as r from w)""",
        """sums as (select event_id, any_value(model_key) as model_key, any_value(n) as n,
             count(*) as in_window, sum(y) as pos, sum(case when y = 1 then r else 0 end) as ranks
             from ranked group by event_id)""",
        """rolling as (select event_id, model_key, n, in_window,
             case when pos > 0 and pos < in_window then
               (ranks - pos * (pos + 1) / 2.0) / (pos * (in_window - pos)) end as auc from sums)""",
        """carried as (select event_id, model_key, n, in_window, auc, coalesce(
             last_value(auc ignore nulls) over (order by n rows unbounded preceding), 1.0) as held
             from rolling)""",
        body=body,
    )


def rolled(spark, sf, key=()):
    rows = scored(spark, sf)
    return metrics.rolling_auc(rows, ARRIVAL, "trueval", "predval", N, key, unique=True)


@query(
    "rolling_auc",
    _sql_rolling(f"select event_id, {sql_round('auc', 9)} as rolling_auc, in_window from rolling"),
)
def rolling_auc(spark, sf):
    out = rolled(spark, sf).select("event_id", "rolling_auc", "in_window")
    return rounded(out, "rolling_auc", digits=9)


@query(
    "rolling_auc_by_model",
    _sql_rolling(
        f"select event_id, model_key, {sql_round('auc', 9)} as rolling_auc, in_window from rolling",
        "model_key",
    ),
)
def rolling_auc_by_model(spark, sf):
    out = rolled(spark, sf, ["model_key"]).select("event_id", "model_key", "rolling_auc", "in_window")
    return rounded(out, "rolling_auc", digits=9)


def carried(spark, sf):
    return metrics.rolling_auc_held(scored(spark, sf), ARRIVAL, "trueval", "predval", N, unique=True)


@query(
    "carry_last_valid",
    _sql_rolling(f"select event_id, {sql_round('held', 9)} as rolling_auc from carried"),
)
def carry_last_valid(spark, sf):
    return rounded(carried(spark, sf).select("event_id", "rolling_auc"), "rolling_auc", digits=9)


@query(
    "min_length_guard",
    with_sql(
        SQL_SCORED,
        body=f"""select event_id, least(seq, {N}) as in_window, least(seq, {N}) > 0.5 * {N} as enough
        from scored""",
    ),
)
def min_length_guard(spark, sf):
    return rolled(spark, sf).select(
        "event_id", "in_window", metrics.long_enough(N, 0.5).alias("enough")
    )


@query(
    "threshold_alert",
    _sql_rolling(
        f"""select event_id, {sql_round('held', 9)} as rolling_auc, in_window from carried
        where held < 0.45 and in_window > 0.5 * {N}"""
    ),
)
def threshold_alert(spark, sf):
    alerts = metrics.threshold_alerts(carried(spark, sf), N, 0.45, 0.5)
    return rounded(alerts.select("event_id", "rolling_auc", "in_window"), "rolling_auc", digits=9)


# --- runs -----------------------------------------------------------------------------------


@query(
    "filter_runs",
    with_sql(SQL_RUNS, body="select run_id, status from runs where pipeline = 'ctr-7'"),
)
def filter_runs(spark, sf):
    return run_ops.filter_runs(runs(spark, sf), "ctr-7").select("run_id", "status")


@query(
    "suppress_while_running",
    with_sql(
        SQL_RUNS, SQL_ALERTS,
        body="""select event_id, pipeline from alert_rows
        where pipeline in (select pipeline from runs)
          and pipeline not in (select pipeline from runs where status = 'Running')""",
    ),
)
def suppress_while_running(spark, sf):
    return run_ops.suppress_while_running(alert_rows(spark, sf), runs(spark, sf)).select(
        "event_id", "pipeline"
    )


@query(
    "join_runs_semi_anti",
    with_sql(
        SQL_RUNS, SQL_ALERTS,
        body="""select event_id, pipeline, 'known' as side from alert_rows
        where pipeline in (select pipeline from runs)
        union all select event_id, pipeline, 'idle' from alert_rows
        where pipeline not in (select pipeline from runs where status = 'Running')""",
    ),
)
def join_runs_semi_anti(spark, sf):
    alerts, all_runs = alert_rows(spark, sf), runs(spark, sf)
    known = run_ops.alerts_of_known(alerts, all_runs).withColumn("side", F.lit("known"))
    idle = run_ops.alerts_not_running(alerts, all_runs).withColumn("side", F.lit("idle"))
    return known.unionByName(idle).select("event_id", "pipeline", "side")


@query(
    "latest_run",
    with_sql(
        SQL_RUNS,
        """r as (select *, row_number() over (partition by pipeline
               order by listed_at desc, run_id desc) as k from runs)""",
        body="select pipeline, run_id, experiment, status from r where k = 1",
    ),
)
def latest_run(spark, sf):
    return run_ops.latest_run(runs(spark, sf)).select("pipeline", "run_id", "experiment", "status")


# --- counters -------------------------------------------------------------------------------

SERIES_KEY = ["metric", "instance"]
SQL_STEPS = """
prev as (select *, lag(value) over (partition by metric, instance order by ts) as before from series),
steps as (select metric, instance, ts, value,
  case when before is null then 0 when value < before then value else value - before end as step
  from prev)"""


@query(
    "counter_latest",
    with_sql(
        SQL_SERIES,
        body="select metric, instance, arg_max(value, ts) as value from series group by 1, 2",
    ),
)
def counter_latest(spark, sf):
    return counters.counter_latest(series(spark, sf), SERIES_KEY)


@query(
    "counter_increase",
    with_sql(
        SQL_RATIO_SERIES,
        """prev as (select *, lag(value) over (partition by instance, le order by ts) as before
             from ratio_series)""",
        """steps as (select le, epoch_us(ts) as t,
             case when before is null then 0 when value < before then value else value - before end as step
             from prev)""",
        f"""sent as (select le, step, unnest(range(
             (t + {HOURS6 * 10**6 - 1}) // {HOURS6 * 10**6},
             (t + {HOURS6 * 10**6}) // {HOURS6 * 10**6} + 1)) as k from steps)""",
        body=f"""select le, cast(k * {HOURS6} as bigint) as at, cast(sum(step) as bigint) as increase
        from sent group by le, k""",
    ),
)
def counter_increase(spark, sf):
    return counters.increase(ratio_series(spark, sf), ["instance", "le"], HOURS6, ["le"])


def _sql_extrapolated(source: str, key: str, change: str, zero: str) -> tuple[str, ...]:
    """CTEs up to ``carried(key, at, value)``: the change in each frame, carried on to its edges."""
    us = HOURS6 * 10**6
    return (
        f"prev as (select *, lag(value) over (partition by {key} order by ts) as before from {source})",
        f"""sent as (select {key}, epoch_us(ts) as t, value::double as v,
             case when before is null then 0 when value < before then value else value - before end as step,
             unnest(range((epoch_us(ts) + {us - 1}) // {us}, (epoch_us(ts) + {us}) // {us} + 1)) as k from prev)""",
        f"""framed as (select {key}, k, count(*) - 1 as gaps, {change} as change, arg_min(v, t) as first_v,
             (max(t) - min(t))::double as covered, (min(t) - (k * {us} - {us}))::double as head, (k * {us} - max(t))::double as tail
             from sent group by {key}, k having count(*) > 1 and max(t) > min(t))""",
        f"""edges as (select *, case when head >= 1.1 * covered / gaps then covered / gaps / 2 else head end as head_1,
             case when tail >= 1.1 * covered / gaps then covered / gaps / 2 else tail end as tail_1 from framed)""",
        f"""carried as (select {key}, cast(k * {HOURS6} as bigint) as "at", change * (covered + {zero} + tail_1) / covered as value
             from edges)""",
    )


_TO_ZERO = "least(head_1, case when change > 0 and first_v >= 0 then covered * first_v / change else head_1 end)"


@query(
    "counter_increase_extrapolated",
    with_sql(
        SQL_RATIO_SERIES,
        *_sql_extrapolated("ratio_series", "instance, le", "sum(step) - arg_min(step, t)", _TO_ZERO),
        body=f"""select le, "at", {sql_round('sum(value)')} as increase from carried group by le, "at\"""",
    ),
)
def counter_increase_extrapolated(spark, sf):
    out = counters.increase(ratio_series(spark, sf), ["instance", "le"], HOURS6, ["le"], extrapolate=True)
    return rounded(out, "increase")


@query(
    "counter_delta_extrapolated",
    with_sql(
        SQL_SERIES,
        *_sql_extrapolated("series", "metric, instance", "arg_max(v, t) - arg_min(v, t)", "head_1"),
        body=f"""select metric, instance, "at", {sql_round('value', 5)} as value from carried""",
    ),
)
def counter_delta_extrapolated(spark, sf):
    return rounded(counters.extrapolated(series(spark, sf), SERIES_KEY, HOURS6, "delta"), "value", digits=5)


def _sql_rate(metric: str) -> str:
    return with_sql(
        SQL_SERIES, SQL_STEPS,
        body=f"""select instance, epoch_us(ts) as at_us,
          {sql_round(f'''sum(step) over (partition by instance order by ts
            range between interval 6 hours preceding and current row) / {HOURS6}.0 / 1000''', 9)} as rate
        from steps where metric = '{metric}'""",
    )


def _rate(spark, sf, metric):
    one = series(spark, sf).where(F.col("metric") == metric)
    out = counters.rate_at(one, SERIES_KEY, HOURS6).select(
        "instance", micros(F.col("ts")).alias("at_us"), (F.col("rate") / 1000).alias("rate")
    )
    return rounded(out, "rate", digits=9)


@query("counter_rate_queue", _sql_rate("queue_us"))
def counter_rate_queue(spark, sf):
    return _rate(spark, sf, "queue_us")


@query("counter_rate_compute", _sql_rate("compute_us"))
def counter_rate_compute(spark, sf):
    return _rate(spark, sf, "compute_us")


SQL_RATIO = f"""
d as (select metric, instance, ts, count(*) over f as n, value - first_value(value) over f as delta
  from series window f as (partition by metric, instance order by ts
    range between interval 6 hours preceding and current row)),
ratio as (select q.instance, q.ts, q.delta / (1.0 + s.delta) / 1000 as value
  from d q join d s on q.metric = 'queue_us' and s.metric = 'success'
    and q.instance = s.instance and q.ts = s.ts where q.n >= 2 and s.n >= 2),
grouped as (select instance, ts, avg(value) as value from ratio group by instance, ts)"""


def _ratio(spark, sf):
    return counters.delta_ratio(
        series(spark, sf), ["instance"], HOURS6, ["instance"], over="queue_us", per="success"
    )


@query(
    "counter_delta_ratio",
    with_sql(
        SQL_SERIES, SQL_RATIO,
        body=f"select instance, epoch_us(ts) as at_us, {sql_round('value', 9)} as value from grouped",
    ),
)
def counter_delta_ratio(spark, sf):
    out = _ratio(spark, sf).select("instance", micros(F.col("ts")).alias("at_us"), "value")
    return rounded(out, "value", digits=9)


@query(
    "metric_threshold",
    with_sql(
        SQL_SERIES, SQL_RATIO,
        body=f"""select instance, epoch_us(ts) as at_us, {sql_round('value', 9)} as value from grouped
        where value > 50""",
    ),
)
def metric_threshold(spark, sf):
    out = counters.over_target(_ratio(spark, sf), 50.0)
    return rounded(out.select("instance", micros(F.col("ts")).alias("at_us"), "value"), "value", digits=9)
