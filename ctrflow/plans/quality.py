"""Queries: statistics, schema inference, anomalies, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ctrflow.operators import dailystats as daily
from ctrflow.operators import drift, heavy
from ctrflow.operators import statistics as st
from ctrflow.operators import validation as val
from ctrflow.plans.fixtures import CLICKS, SQL_CLICKS, clicks, day_log, kept_clicks, with_sql
from ctrflow.plans.registry import query, rounded, sql_round
from ctrflow.scratch import local_table, materialize, new_path

CONTS, CATS = list(CLICKS.conts), list(CLICKS.cats)
COLS = CONTS + CATS
REF, NEW = "day < 12", "day >= 12"


def _log(spark, sf):
    """The whole click log as day files, for queries that read it several times."""
    return day_log(spark, sf, ("l_orderkey", *COLS))


def _each(template: str, names) -> str:
    return " union all ".join(template.format(c=c) for c in names)


def _sql_long(name: str, source: str, cols, where: str = "true") -> str:
    return f"{name} as (" + _each(
        "select '{c}' as feature, {c} as v from " + source + " where {c} is not null and " + where, cols
    ) + ")"


SQL_COMMON = _each(
    """select '{c}' as feature, count(*) as n_rows, count({c}) as n_present,
    count(*) - count({c}) as n_missing, """ + sql_round("count({c}) / count(*)") + " as presence from clicks",
    COLS,
)


@query("stats_common", with_sql(SQL_CLICKS, body=SQL_COMMON))
def stats_common(spark, sf):
    return rounded(st.stats_common(clicks(spark, sf), COLS), "presence")


@query(
    "stats_numeric",
    with_sql(
        SQL_CLICKS,
        body=_each(
            "select '{c}' as feature, min({c}) as min, max({c}) as max, " + sql_round("avg({c})", 7)
            + " as mean, " + sql_round("stddev_pop({c})")
            + " as std, count(*) filter ({c} = 0) as zeros, " + sql_round("median({c})")
            + " as median from clicks",
            CONTS,
        ),
    ),
)
def stats_numeric(spark, sf):
    out = st.stats_numeric(kept_clicks(spark, sf, CONTS), CONTS)
    return rounded(rounded(out, "std", "median"), "mean", digits=7)


def _sql_hist(name: str, source: str, ranges: str) -> str:
    """Ten-bin histogram of long values over given ranges, empty bins included."""
    return f"""
{name}_n as (select feature, least(9, cast(floor((v - mn) / (mx - mn) * 10) as int)) as bin, count(*) as n
  from {source} join {ranges} using (feature) group by 1, 2),
{name} as (select feature, bin, mn + (mx - mn) / 10 * bin as lo,
    case when bin < 9 then mn + (mx - mn) / 10 * (bin + 1) else mx end as hi, coalesce(n, 0) as n
  from (select feature, mn, mx, unnest(range(10)) as bin from {ranges})
  left join {name}_n using (feature, bin))"""


@query(
    "stats_std_histogram",
    with_sql(
        SQL_CLICKS,
        _sql_long("long", "clicks", CONTS),
        "rng as (select feature, min(v) as mn, max(v) as mx from long group by 1)",
        _sql_hist("hist", "long", "rng"),
        body=f"""select feature, cast(bin as int) as bin, {sql_round('lo')} as lo, {sql_round('hi')} as hi,
          cast(n as bigint) as count from hist""",
    ),
)
def stats_std_histogram(spark, sf):
    return rounded(st.histogram(clicks(spark, sf), CONTS), "lo", "hi")


@query(
    "stats_quantile_histogram",
    with_sql(
        SQL_CLICKS,
        _sql_long("long", "clicks", CONTS),
        """q as (select feature, unnest(range(11)) as q,
             unnest(quantile_cont(v, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) as v
             from long group by feature)""",
        body=f"select feature, cast(q as int) as q, {sql_round('v')} as value from q",
    ),
)
def stats_quantile_histogram(spark, sf):
    return rounded(st.quantiles(kept_clicks(spark, sf, CONTS), CONTS, 10), "value")


@query(
    "stats_string",
    with_sql(
        SQL_CLICKS,
        body=_each(
            "select '{c}' as feature, count(distinct {c}) as n_unique, "
            + sql_round("avg(length({c}))") + " as avg_len from clicks",
            CATS,
        ),
    ),
)
def stats_string(spark, sf):
    return rounded(st.string_stats(clicks(spark, sf), CATS), "avg_len")


SQL_COUNTS = (
    "counts as ("
    + _each(
        "select '{c}' as feature, {c} as value, count(*) as n from clicks where {c} is not null group by 2",
        CATS,
    )
    + """), ranked as (select feature, value, n,
      row_number() over (partition by feature order by n desc, value) as r from counts)"""
)


def _sql_top(k: int) -> str:
    return with_sql(
        SQL_CLICKS, SQL_COUNTS,
        body=f"select feature, value, n as count, cast(r as int) as rank from ranked where r <= {k}",
    )


@query("stats_top_values", _sql_top(20))
def stats_top_values(spark, sf):
    return st.top_values(clicks(spark, sf), CATS, 20)


@query("stats_rank_histogram", _sql_top(1000))
def stats_rank_histogram(spark, sf):
    return st.rank_histogram(clicks(spark, sf), CATS, 1000)


@query(
    "feature_stats",
    with_sql(
        SQL_CLICKS,
        body=_each(
            "select '{c}' as feature, 'numeric' as type, count({c}) as n_present, "
            + sql_round("avg({c})", 7) + " as mean, " + sql_round("quantile_cont({c}, 0.3)")
            + " as q3, cast(null as bigint) as n_unique, cast(null as varchar) as most from clicks",
            CONTS,
        )
        + " union all "
        + _each(
            "select '{c}', 'string', count({c}), null, null, count(distinct {c}), "
            "(select {c} from clicks where {c} is not null group by {c} order by count(*) desc, {c} limit 1) "
            "from clicks",
            CATS,
        ),
    ),
)
def feature_stats(spark, sf):
    out = st.feature_stats(kept_clicks(spark, sf, COLS), COLS).select(
        "feature", "type", "n_present", F.col("num.mean").alias("mean"),
        F.col("num.quantiles")[3].alias("q3"), F.col("str.n_unique").alias("n_unique"),
        F.col("str.top")[0]["value"].alias("most"),
    )
    return rounded(rounded(out, "q3"), "mean", digits=7)


# --- schema and anomalies -------------------------------------------------------------------


def _typed_stats(df, cols):
    numeric, _ = st.split_kinds(df, cols)
    kind = F.when(F.col("feature").isin(numeric), "numeric").otherwise("string")
    return st.stats_common(df, cols).withColumn("type", kind)


def _ref_schema(rows):
    ref = rows.where(REF)
    return val.with_threshold(val.infer_schema(_typed_stats(ref, COLS)), "i1", 0.06)


def _ref_domain(rows):
    return materialize(val.infer_domain(st.string_counts(rows.where(REF), CATS)), "domain")


SQL_REF_STATS = (
    "ref_stats as ("
    + _each(
        "select '{c}' as feature, 'numeric' as type, count({c}) / count(*) as presence from clicks where " + REF,
        CONTS,
    )
    + " union all "
    + _each(
        "select '{c}', 'string', count({c}) / count(*) from clicks where " + REF, CATS
    )
    + ")"
)
SQL_REF_DOMAIN = (
    "ref_values as ("
    + _each("select distinct '{c}' as feature, {c} as value from clicks where {c} is not null and " + REF, CATS)
    + """), ref_domain as (select feature, string_agg(value, '|' order by value) as domain
      from ref_values group by feature having count(*) <= 100)"""
)


@query(
    "infer_schema",
    with_sql(
        SQL_CLICKS, SQL_REF_STATS, SQL_REF_DOMAIN,
        body=f"""select feature, type, {sql_round('presence')} as min_presence, domain
        from ref_stats left join ref_domain using (feature)""",
    ),
)
def infer_schema(spark, sf):
    rows = clicks(spark, sf)
    schema = val.listed_domain(_ref_schema(rows), _ref_domain(rows))
    schema = schema.withColumn("domain", F.array_join("domain", "|"))
    return rounded(schema.select("feature", "type", "min_presence", "domain"), "min_presence")


@query(
    "set_drift_threshold",
    with_sql(
        SQL_CLICKS, SQL_REF_STATS,
        body="""select feature, case when feature = 'i1' then 0.06::double end as jsd_threshold
        from ref_stats""",
    ),
)
def set_drift_threshold(spark, sf):
    return _ref_schema(clicks(spark, sf)).select("feature", "jsd_threshold")


@query(
    "validate_schema",
    with_sql(
        SQL_CLICKS, SQL_REF_STATS, SQL_REF_DOMAIN,
        # new data: i6 dropped, i7 added, c1 as a number, i2 with gaps, c4 with a new value
        f"""new_rows as (select * exclude (i6, c1, i2, c4), i5 as i7,
             case when c1 = 'O' then 1.0 else 0.0 end as c1,
             case when l_orderkey % 3 = 0 then null else i2 end as i2,
             case when l_orderkey % 50 = 0 then 'NOWHERE' else c4 end as c4
             from clicks where {NEW})""",
        "new_stats as ("
        + _each(
            "select '{c}' as feature, 'numeric' as type, count({c}) / count(*) as presence from new_rows",
            ["i1", "i2", "i3", "i4", "i5", "i7", "c1"],
        )
        + " union all "
        + _each("select '{c}', 'string', count({c}) / count(*) from new_rows", CATS[1:])
        + ")",
        "new_values as ("
        + _each("select distinct '{c}' as feature, {c} as value from new_rows where {c} is not null", CATS[1:])
        + ")",
        """pair as (select coalesce(o.feature, n.feature) as feature, o.type as t0, n.type as t1,
             o.presence as p0, n.presence as p1
             from ref_stats o full join new_stats n on o.feature = n.feature)""",
        body="""select feature, 'column_missing' as anomaly from pair where t1 is null
        union all select feature, 'new_column' from pair where t0 is null
        union all select feature, 'type_changed' from pair where t0 <> t1
        union all select feature, 'presence_low' from pair where p1 < p0
        union all select distinct v.feature, 'out_of_domain' from new_values v
          where v.feature in (select feature from ref_values)
            and (v.feature, v.value) not in (select (feature, value) from ref_values)""",
    ),
)
def validate_schema(spark, sf):
    order, rows = F.col("l_orderkey"), clicks(spark, sf)
    new = (
        rows.where(NEW)
        .drop("i6")
        .withColumn("i7", F.col("i5"))
        .withColumn("c1", F.when(F.col("c1") == "O", 1.0).otherwise(0.0))
        .withColumn("i2", F.when(order % 3 != 0, F.col("i2")))
        .withColumn("c4", F.when(order % 50 == 0, "NOWHERE").otherwise(F.col("c4")))
    )
    # one scan a side gives presence and values
    stats, counts = st.presence_and_values(new, ["i1", "i2", "i3", "i4", "i5", "i7", *CATS])
    ref_stats, ref_counts = st.presence_and_values(rows.where(REF), COLS)
    return val.validate(stats, val.infer_schema(ref_stats), counts, val.infer_domain(ref_counts))


@query(
    "join_stats_pair",
    with_sql(
        SQL_CLICKS,
        body=_each(
            "select '{c}' as feature, count({c}) filter (" + REF + ") as n_present_ref, "
            "count({c}) filter (" + NEW + ") as n_present_new from clicks",
            COLS,
        ),
    ),
)
def join_stats_pair(spark, sf):
    rows = clicks(spark, sf)
    left = st.stats_common(rows.where(REF), COLS).select("feature", "n_present")
    right = st.stats_common(rows.where(NEW), COLS).select("feature", "n_present")
    return val.join_stats_pair(left, right)


# --- drift ------------------------------------------------------------------------------------

SQL_SIDES = ",".join(
    [
        _sql_long("ref_long", "clicks", CONTS, REF),
        _sql_long("new_long", "clicks", CONTS, NEW),
        """rng as (select feature, min(v) as mn, max(v) as mx
          from (select * from ref_long union all select * from new_long) group by 1)""",
        _sql_hist("ref_hist", "ref_long", "rng"),
        _sql_hist("new_hist", "new_long", "rng"),
        """paired as (select feature, bin, r.n as n_ref, w.n as n_new
          from ref_hist r join new_hist w using (feature, bin))""",
    ]
)
SQL_JSD = """
shares as (select feature, n_ref / sum(n_ref) over (partition by feature) as p,
    n_new / sum(n_new) over (partition by feature) as q from paired),
jsd as (select feature, (
    sum(case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end)
    + sum(case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end)) / 2 as value
  from shares group by feature)"""


def _sides(spark, sf, rows=None):
    rows = clicks(spark, sf) if rows is None else rows
    return rows.where(REF), rows.where(NEW)


@query(
    "join_hist_bins",
    with_sql(
        SQL_CLICKS, SQL_SIDES,
        body="""select feature, cast(bin as int) as bin, cast(n_ref as bigint) as n_ref,
          cast(n_new as bigint) as n_new from paired""",
    ),
)
def join_hist_bins(spark, sf):
    return drift.paired_histograms(*_sides(spark, sf), CONTS)


@query(
    "drift_js",
    with_sql(SQL_CLICKS, SQL_SIDES, SQL_JSD, body=f"select feature, {sql_round('value', 9)} as value from jsd"),
)
def drift_js(spark, sf):
    return rounded(drift.js_divergence(*_sides(spark, sf), CONTS), "value", digits=9)


SQL_SAVED = ",".join(
    [
        _sql_long("ref_long", "clicks", CONTS, REF),
        _sql_long("new_long", "clicks", CONTS, NEW),
        "ref_rng as (select feature, min(v) as mn, max(v) as mx from ref_long group by 1)",
        "new_rng as (select feature, min(v) as mn, max(v) as mx from new_long group by 1)",
        _sql_hist("ref_hist", "ref_long", "ref_rng"),
        _sql_hist("new_hist", "new_long", "new_rng"),
        """both_hist as (select feature, lo, hi, n, 'ref' as side from ref_hist
          union all select feature, lo, hi, n, 'new' from new_hist)""",
        "edges as (select feature, lo as e from both_hist union select feature, hi from both_hist)",
        """cells as (select * from (select feature, e as a,
          lead(e) over (partition by feature order by e) as b from edges) where b is not null)""",
        """paired as (select c.feature, c.a, c.b,
          sum(case when side = 'ref' then n * (least(hi, b) - greatest(lo, a)) / (hi - lo) else 0 end) as n_ref,
          sum(case when side = 'new' then n * (least(hi, b) - greatest(lo, a)) / (hi - lo) else 0 end) as n_new
          from cells c join both_hist h on c.feature = h.feature and h.lo < c.b and h.hi > c.a
          group by 1, 2, 3)""",
    ]
)


def _saved_sides(spark, rows):
    """Saved records of both sides, from the same scans of the rows of both."""
    path = new_path(spark, "stats")
    rows = rows.select(*CONTS, F.when(F.expr(REF), "ref").when(F.expr(NEW), "new").alias("side"))
    both = st.feature_stats(rows.where("side is not null"), CONTS, by="side")
    for side in ("ref", "new"):
        st.save_stats(both.where(F.col("side") == side).drop("side"), f"{path}/{side}")
    return st.load_stats(spark, f"{path}/ref"), st.load_stats(spark, f"{path}/new")


@query(
    "drift_js_saved",
    with_sql(SQL_CLICKS, SQL_SAVED, SQL_JSD, body=f"select feature, {sql_round('value')} as value from jsd"),
)
def drift_js_saved(spark, sf):
    out = drift.js_from_stats(*_saved_sides(spark, kept_clicks(spark, sf, [*CONTS, "day"])), CONTS)
    return rounded(out, "value")


@query(
    "drift_decision",
    with_sql(
        SQL_CLICKS, SQL_SIDES, SQL_JSD,
        body=f"""select feature, 'jensen_shannon' as measure, {sql_round('value', 9)} as value,
          case when feature = 'i1' then 0.06 else 0.00005 end::double as threshold,
          not (value < case when feature = 'i1' then 0.06 else 0.00005 end) as drift
        from jsd where feature in ('i1', 'i2')""",
    ),
)
def drift_decision(spark, sf):
    rows = _log(spark, sf)
    ref, new = _sides(spark, sf, rows)
    schema = val.with_threshold(_ref_schema(rows), "i2", 0.00005)
    return rounded(drift.drift_report(drift.js_divergence(ref, new, CONTS), schema), "value", digits=9)


# --- daily records ----------------------------------------------------------------------------

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@query(
    "stats_merge_days",
    with_sql(
        SQL_CLICKS,
        body=_each(
            "select '{c}' as feature, count(*) as n_rows, count({c}) as n_present, " + sql_round("avg({c})", 7)
            + " as mean, " + sql_round("stddev_pop({c})", 5) + " as std, min({c}) as min, max({c}) as max, "
            "count(*) filter ({c} = 0) as zeros, cast(null as double) as avg_len, "
            f"{len(PROBS)}::bigint as quantiles_held, true as distinct_held, true as frequent_held from clicks where {REF}",
            CONTS,
        )
        + " union all "
        + _each(
            "select '{c}', count(*), count({c}), null, null, null, null, null, " + sql_round("avg(length({c}))", 7)
            + f", 0::bigint, true, true from clicks where {REF}",
            CATS,
        ),
    ),
)
def stats_merge_days(spark, sf):
    """Daily records saved in two goes and merged over the reference days; how many estimates keep to their bounds.

    The exact ranks, distinct counts and value counts that estimates are held against are taken from the rows here only.
    """
    rows, path = kept_clicks(spark, sf, [*COLS, "day"]).where("day is not null"), new_path(spark, "days")
    for part in (REF, NEW):
        daily.save_days(daily.daily_records(rows.where(part), COLS), path)
    record = materialize(daily.merge_days(daily.load_days(spark, path, last=11)), "merged")
    told = daily.describe(record, PROBS).collect()
    ref = rows.where(REF)
    counts = materialize(st.string_counts(ref, CATS), "counts")
    n_values = {r.feature: r["count"] for r in counts.groupBy("feature").count().collect()}
    # an estimate keeps to its bound if its ranks, from the first of its equals to the last, come near the wanted one
    checks = []
    for r in told:
        if r.quantiles is None:
            continue
        x = F.col(r.feature)
        kept = [
            (F.count(F.when(x < v, 1)) <= (p + daily.RANK_ERROR) * F.count(x))
            & (F.count(F.when(x <= v, 1)) >= (p - daily.RANK_ERROR) * F.count(x))
            for p, v in zip(PROBS, r.quantiles)
        ]
        checks.append(sum(k.cast("bigint") for k in kept).alias(r.feature))
    held_at = ref.agg(*checks).first().asDict() if checks else {}
    exact = {**{r.feature: n_values.get(r.feature, 0) for r in told}, **held_at}
    held = local_table(
        spark, "feature string, quantiles_held bigint, distinct_ok bigint",
        [
            (r.feature, exact[r.feature] if r.quantiles is not None else 0,
             int(r.n_unique is None or abs(r.n_unique - exact[r.feature]) <= max(1, daily.DISTINCT_ERROR * exact[r.feature])))
            for r in told
        ],
    )
    frequent = daily.frequent(record, 50).join(counts, ["feature", "value"], "left").groupBy("feature").agg(
        F.bool_and(F.col("count").between(F.col("low"), F.col("high"))).alias("frequent_ok")
    )
    out = daily.describe(record, PROBS).join(held, "feature").join(frequent, "feature", "left").select(
        "feature", "n_rows", "n_present", "mean", "std", "min", "max", "zeros", "avg_len", "quantiles_held",
        (F.col("distinct_ok") == 1).alias("distinct_held"), F.coalesce("frequent_ok", F.lit(True)).alias("frequent_held"),
    )
    return rounded(rounded(out, "mean", "avg_len", digits=7), "std", digits=5)


@query(
    "top_values_two_scans",
    with_sql(
        SQL_CLICKS,
        body=_each(
            """select * from (select '{c}' as feature, {c} as value, count(*) as count,
              cast(row_number() over (order by count(*) desc, {c}) as int) as rank from clicks where {c} is not null
              group by {c}) where rank <= 20""",
            CATS[:6],
        ),
    ),
)
def top_values_two_scans(spark, sf):
    """Summaries first, then exact counts of what may be among the first; a column they leave open is counted in full."""
    rows = clicks(spark, sf).select(*CATS[:6])
    found, undecided = heavy.top_values_in_two_scans(rows, CATS[:6], 20, size=300)
    if undecided:
        found = found.unionByName(st.top_values(rows, undecided, 20).select(*found.columns))
    return found.select("feature", "value", "count", "rank")
