"""Queries: projections, transforms, vocabularies, workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ctrflow.operators import columns as ops
from ctrflow.operators.transforms import (
    Categorify,
    Clip,
    FillMissing,
    HashBucket,
    LambdaOp,
    LogOp,
    Normalize,
    Rename,
)
from ctrflow.operators.workflow import FittedWorkflow, Workflow
from ctrflow.plans.fixtures import (
    CLICKS,
    N_TRAIN,
    N_VAL,
    ROW_KEY,
    SQL_CLICKS,
    SQL_SCORED,
    clicks,
    day_log,
    kept_clicks,
    scored,
    with_sql,
    workflow,
)
from ctrflow.plans.registry import query, rounded, sql_round
from ctrflow.scratch import materialize, new_path
from ctrflow.sources.scans import day_split
from ctrflow.sources.sinks import to_events, typed_features, write_features

KEY = ", ".join(ROW_KEY)
CONTS, CATS = CLICKS.conts, CLICKS.cats
TRAIN = f"day < {N_TRAIN}"


def _filled(c: str) -> str:
    return f"greatest(coalesce({c}, 0), 0)"


# --- the fitted state in SQL --------------------------------------------------------------

SQL_MOMENTS = (
    "moments as (select "
    + ", ".join(f"avg({_filled(c)}) as m_{c}, stddev_samp({_filled(c)}) as s_{c}" for c in CONTS)
    + f" from clicks where {TRAIN})"
)
SQL_VOCAB = (
    "counted as ("
    + " union all ".join(
        f"select '{c}' as col, {c} as val, count(*) as freq from clicks "
        f"where {TRAIN} and {c} is not null group by {c}"
        for c in CATS
    )
    + "), vocab as (select col, val, freq, "
    "row_number() over (partition by col order by val) as code, "
    "row_number() over (partition by col order by freq desc, val) as freq_code from counted)"
)


def _z(c: str) -> str:
    x = f"{_filled(c)} - m_{c}"
    return f"case when s_{c} > 0 then ({x}) / s_{c} else {x} end"


def _sql_transformed(code: str = "code") -> str:
    """All rows, transformed by the state of the training days."""
    joins = " ".join(
        f"left join vocab v_{c} on v_{c}.col = '{c}' and v_{c}.val = k.{c}" for c in CATS
    )
    cats = ", ".join(f"coalesce(v_{c}.{code}, 0) as {c}" for c in CATS)
    conts = ", ".join(f"{sql_round(_z(c))} as {c}" for c in CONTS)
    return with_sql(
        SQL_CLICKS,
        SQL_MOMENTS,
        SQL_VOCAB,
        "k as (select * exclude (l_extendedprice), l_extendedprice as price from clicks)",
        body=f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, price as l_extendedprice,
          {cats}, {conts}, cast(label as double) as label
        from k cross join moments {joins}""",
    )


def _days(spark, sf):
    return day_split(day_log(spark, sf), N_TRAIN, N_VAL)


def _kept_days(spark, sf, *columns):
    """Training and validation days of the click log (or some columns), written down as one table."""
    return day_split(kept_clicks(spark, sf, (*columns, "day") if columns else ()), N_TRAIN, N_VAL)


def fit(spark, sf, order: str = "value") -> FittedWorkflow:
    return workflow(order).fit(_days(spark, sf)[0])


def _typed(df):
    return rounded(typed_features(df, CLICKS, ROW_KEY, "double"), *CONTS)


# --- 2.2 projections ------------------------------------------------------------------


@query("select_group", with_sql(SQL_CLICKS, body=f"select {KEY}, {', '.join(CONTS)} from clicks"))
def select_group(spark, sf):
    return ops.select_group(clicks(spark, sf), [*ROW_KEY, *CONTS])


@query(
    "concat_groups",
    with_sql(SQL_CLICKS, body=f"select {KEY}, {', '.join(CATS)}, {', '.join(CONTS)}, label from clicks"),
)
def concat_groups(spark, sf):
    return ops.concat_groups(clicks(spark, sf), ROW_KEY, CATS, CONTS, [CLICKS.label])


@query(
    "split_features_label",
    with_sql(
        SQL_CLICKS,
        body=f"select {KEY}, {', '.join([*CONTS, *CATS])}, label from clicks",
    ),
)
def split_features_label(spark, sf):
    # both frames come from these rows
    rows = kept_clicks(spark, sf, [*ROW_KEY, *CONTS, *CATS, "label"])
    features, label = ops.split_features_label(rows, CLICKS)
    return features.join(label, list(ROW_KEY)).select(
        *ROW_KEY, *CONTS, *CATS, "label"
    )


@query(
    "cast_types",
    with_sql(
        SQL_CLICKS,
        body=f"""select {KEY}, try_cast(c6 as bigint) as c6, try_cast(c1 as bigint) as c1,
          cast(label as double) as label, cast(day as varchar) as day from clicks""",
    ),
)
def cast_types(spark, sf):
    types = {"c6": "bigint", "c1": "bigint", "label": "double", "day": "string"}
    return ops.cast_all(clicks(spark, sf), types).select(*ROW_KEY, *types)


SQL_NUMERIC_CATS = (
    "numeric_clicks as (select "
    + KEY
    + ", label, "
    + ", ".join(CONTS)
    + ", cast(l_suppkey as double) as c1, cast(l_partkey as double) as c2, label * 0.5::double as predval from clicks)"
)


def numeric_clicks(spark, sf):
    """Clicks whose categories are whole numbers, as in scoring requests."""
    return clicks(spark, sf).select(
        *ROW_KEY, "label", *CONTS,
        F.col("l_suppkey").cast("double").alias("c1"), F.col("l_partkey").cast("double").alias("c2"),
        (F.col("label") * 0.5).alias("predval"),
    )


def kept_numeric_clicks(spark, sf):
    """The same, written down for a query that reads it several times."""
    return materialize(numeric_clicks(spark, sf).drop("predval"), "clicks")


EVENT_SCHEMA = type(CLICKS)(conts=CONTS, cats=("c1", "c2"), key=ROW_KEY)


@query(
    "pack_event",
    with_sql(
        SQL_CLICKS, SQL_NUMERIC_CATS,
        body=f"""select {KEY}, coalesce(i1, -1) as first_real, i6 as last_real, c2 as last_cat,
          6 as n_reals, 2 as n_cats, cast(label as double) as trueval, predval from numeric_clicks""",
    ),
)
def pack_event(spark, sf):
    event = ops.pack_event(CONTS, ["c1", "c2"], "label", "predval")
    packed = numeric_clicks(spark, sf).select(*ROW_KEY, event.alias("e"))
    return packed.select(
        *ROW_KEY,
        F.coalesce(F.col("e.input0")[0], F.lit(-1.0)).alias("first_real"),
        F.element_at("e.input0", -1).alias("last_real"),
        F.element_at("e.input1", -1).alias("last_cat"),
        F.size("e.input0").alias("n_reals"),
        F.size("e.input1").alias("n_cats"),
        "e.trueval",
        "e.predval",
    )


SQL_UNPACKED = with_sql(
    SQL_CLICKS, SQL_NUMERIC_CATS,
    body=f"select {KEY}, cast(label as double) as label, {', '.join(CONTS)}, c1, c2 from numeric_clicks",
)


@query("unpack_event", SQL_UNPACKED)
def unpack_event(spark, sf):
    event = ops.pack_event(CONTS, ["c1", "c2"], "label", "predval")
    packed = numeric_clicks(spark, sf).select(*ROW_KEY, event.alias("e")).select(*ROW_KEY, "e.*")
    return ops.unpack_event(packed, EVENT_SCHEMA, ROW_KEY)


@query("sink_events", SQL_UNPACKED)
def sink_events(spark, sf):
    """Encode as JSON, decode again, unpack."""
    messages = to_events(numeric_clicks(spark, sf), EVENT_SCHEMA)
    return ops.unpack_event(ops.parse_events(messages), EVENT_SCHEMA, ROW_KEY)


@query(
    "slice_batches",
    with_sql(
        SQL_CLICKS,
        f"n as (select {KEY}, row_number() over (order by {KEY}) - 1 as seq from clicks)",
        body=f"select {KEY}, seq, cast(floor(seq / 64) as bigint) as batch from n",
    ),
)
def slice_batches(spark, sf):
    rows = clicks(spark, sf).select(*ROW_KEY)
    return ops.with_batch(rows, 64, ROW_KEY)


# --- 2.3 column-wise transforms --------------------------------------------------------


def _columnwise(group):
    def run(spark, sf):
        fitted = FittedWorkflow(group.branches)
        return fitted.transform(clicks(spark, sf), ROW_KEY)

    return run


query(
    "fill_missing",
    with_sql(
        SQL_CLICKS, body=f"select {KEY}, {', '.join(f'coalesce({c}, 0) as {c}' for c in CONTS)} from clicks"
    ),
)(_columnwise(CONTS >> FillMissing()))
query(
    "clip",
    with_sql(
        SQL_CLICKS,
        body=f"""select {KEY}, case when i1 is null then null else least(greatest(i1, 0), 30) end as i1,
          {', '.join(f'case when {c} is null then null else greatest({c}, 0) end as {c}' for c in CONTS[1:])}
        from clicks""",
    ),
)(_columnwise((CONTS[:1] >> Clip(0.0, 30.0)) + (CONTS[1:] >> Clip(min_value=0.0))))
query(
    "log_op",
    with_sql(SQL_CLICKS, body=f"select {KEY}, {sql_round('ln(1 + i2)')} as i2 from clicks"),
)(lambda spark, sf: rounded(_columnwise(["i2"] >> LogOp())(spark, sf), "i2"))
query(
    "rename_op",
    with_sql(SQL_CLICKS, body=f"select {KEY}, i1 as i1_raw, i2 as i2_raw from clicks"),
)(_columnwise(["i1", "i2"] >> Rename(postfix="_raw")))
query(
    "lambda_op",
    with_sql(SQL_CLICKS, body=f"select {KEY}, upper(c3) as c3, {sql_round('i2 / 1000')} as i2 from clicks"),
)(
    lambda spark, sf: rounded(
        _columnwise((["c3"] >> LambdaOp(F.upper)) + (["i2"] >> LambdaOp(lambda c: c / 1000)))(spark, sf),
        "i2",
    )
)


@query(
    "hash_bucket",
    with_sql(
        SQL_CLICKS,
        body=" union all ".join(
            f"""select '{c}' as feature, count(*) as n, count(*) filter ({c} is null) as own_bucket,
              count(distinct {c}) as n_values, true as one_each, true as in_range from clicks"""
            for c in CATS
        ),
    ),
)
def hash_bucket(spark, sf):
    """Per column: rows, those in the bucket of missing values, and whether each value has one bucket in range."""
    buckets = 64
    coded = FittedWorkflow((CATS >> HashBucket(buckets)).branches).transform(clicks(spark, sf), ROW_KEY)
    both = clicks(spark, sf).select(*ROW_KEY, *[F.col(c).alias(f"raw_{c}") for c in CATS]).join(coded, list(ROW_KEY))
    pairs = both.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"raw_{c}").alias("raw"), F.col(c).alias("bucket")) for c in CATS
        ])).alias("x")
    ).select("x.*")
    per_value = pairs.groupBy("feature", "raw").agg(
        F.count(F.lit(1)).alias("n"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi")
    )
    missing = F.col("raw").isNull()
    return per_value.groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("hi") == buckets, F.col("n")).otherwise(0)).alias("own_bucket"),
        F.count("raw").alias("n_values"),
        F.bool_and(F.col("lo") == F.col("hi")).alias("one_each"),
        F.bool_and(F.when(missing, F.col("lo") == buckets).otherwise((F.col("lo") >= 0) & (F.col("hi") < buckets))).alias("in_range"),
    )


# --- 2.3 fitted transforms ----------------------------------------------------------------


@query(
    "normalize_fit",
    with_sql(
        SQL_CLICKS, SQL_MOMENTS,
        body=" union all ".join(
            f"select '{c}' as feature, {sql_round(f'm_{c}', 7)} as mean, {sql_round(f's_{c}', 7)} as std from moments"
            for c in CONTS
        ),
    ),
)
def normalize_fit(spark, sf):
    train, _ = _days(spark, sf)
    fitted = Workflow(CONTS >> FillMissing() >> Clip(min_value=0) >> Normalize()).fit(train)
    state = [(c, m["mean"], m["std"]) for c, m in fitted.moments.items()]
    out = spark.createDataFrame(state, "feature string, mean double, std double")
    return rounded(out, "mean", "std", digits=7)


@query(
    "normalize_transform",
    with_sql(
        SQL_CLICKS, SQL_MOMENTS,
        body=f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
          {', '.join(f'{sql_round(_z(c))} as {c}' for c in CONTS)}
        from clicks cross join moments""",
    ),
)
def normalize_transform(spark, sf):
    train, valid = _days(spark, sf)
    fitted = Workflow(CONTS >> FillMissing() >> Clip(min_value=0) >> Normalize()).fit(train)
    return rounded(fitted.transform(train.unionByName(valid), ROW_KEY), *CONTS)


@query(
    "categorify_fit",
    with_sql(
        SQL_CLICKS, SQL_VOCAB,
        body='select col as "column", val as "value", code, freq from vocab',
    ),
)
def categorify_fit(spark, sf):
    train, _ = _days(spark, sf)
    fitted = Workflow(CATS >> Categorify()).fit(train)
    return fitted.vocab.select("column", "value", "code", "freq")


@query(
    "categorify_fit_freq",
    with_sql(
        SQL_CLICKS, SQL_VOCAB,
        body='select col as "column", val as "value", freq_code as code, freq from vocab',
    ),
)
def categorify_fit_freq(spark, sf):
    train, _ = _days(spark, sf)
    fitted = Workflow(CATS >> Categorify("freq")).fit(train)
    return fitted.vocab.select("column", "value", "code", "freq")


def _sql_codes(names):
    joins = " ".join(f"left join vocab v_{c} on v_{c}.col = '{c}' and v_{c}.val = k.{c}" for c in names)
    codes = ", ".join(f"coalesce(v_{c}.code, 0) as {c}" for c in names)
    return with_sql(
        SQL_CLICKS, SQL_VOCAB, "k as (select * from clicks)",
        body=f"select {KEY}, {codes} from k {joins}",
    )


@query("categorify_transform", _sql_codes(CATS))
def categorify_transform(spark, sf):
    train, valid = _kept_days(spark, sf, *ROW_KEY, *CATS)
    return Workflow(CATS >> Categorify()).fit(train).transform(train.unionByName(valid), ROW_KEY)


@query("join_vocab", _sql_codes(["c6", "c7"]))
def join_vocab(spark, sf):
    """Lookup by shuffle join, as for vocabularies too large to broadcast."""
    from ctrflow.operators.vocab import LookupLimits

    rows = kept_clicks(spark, sf, [*ROW_KEY, "c6", "c7", "day"])
    fitted = Workflow(["c6", "c7"] >> Categorify()).fit(day_split(rows, N_TRAIN, N_VAL)[0])
    fitted.limits = LookupLimits(column_bytes=0)
    return fitted.transform(rows, ROW_KEY)


@query(
    "embedding_cardinality",
    with_sql(
        SQL_CLICKS, SQL_VOCAB,
        body='select col as "column", count(*) + 1 as cardinality from vocab group by col',
    ),
)
def embedding_cardinality(spark, sf):
    return fit(spark, sf).embedding_sizes(spark).select("column", "cardinality")


@query(
    "embedding_dim",
    with_sql(
        SQL_CLICKS, SQL_VOCAB,
        body="""select col as "column",
          cast(least(16, round(1.6 * pow(count(*) + 1, 0.56))) as bigint) as dim
        from vocab group by col""",
    ),
)
def embedding_dim(spark, sf):
    return fit(spark, sf).embedding_sizes(spark).select("column", "dim")


@query("workflow_compose", _sql_transformed())
def workflow_compose(spark, sf):
    train, valid = _days(spark, sf)
    fitted = workflow().fit(train)
    return _typed(fitted.transform(train, ROW_KEY).union(fitted.transform(valid, ROW_KEY)))


@query(
    "workflow_fit",
    with_sql(
        SQL_CLICKS, SQL_MOMENTS, SQL_VOCAB,
        body=" union all ".join(
            f"select '{c}' as name, {sql_round(f'm_{c}', 7)} as mean, cast(null as bigint) as n from moments"
            for c in CONTS
        )
        + " union all select col, null, count(*) from vocab group by col",
    ),
)
def workflow_fit(spark, sf):
    fitted = fit(spark, sf)
    rows = [(c, m["mean"], None) for c, m in fitted.moments.items()]
    rows += [(c, None, s.n) for c, s in fitted.sizes.items()]
    return rounded(spark.createDataFrame(rows, "name string, mean double, n bigint"), "mean", digits=7)


@query("workflow_transform", _sql_transformed())
def workflow_transform(spark, sf):
    train, valid = _days(spark, sf)
    return _typed(workflow().fit(train).transform(train.unionByName(valid), ROW_KEY))


@query("workflow_transform_new", _sql_transformed())
def workflow_transform_new(spark, sf):
    """The table as it comes, not the staged days, through a workflow that was saved and loaded again."""
    path, rows = new_path(spark, "workflow"), kept_clicks(spark, sf)
    workflow().fit(day_split(rows, N_TRAIN, N_VAL)[0]).save(spark, path)
    return _typed(FittedWorkflow.load(spark, path).transform(rows, ROW_KEY))


@query(
    "save_workflow",
    with_sql(SQL_CLICKS, SQL_VOCAB, body='select col as "column", val as "value", code from vocab'),
)
def save_workflow(spark, sf):
    """The vocabularies as saved."""
    path = new_path(spark, "workflow")
    fit(spark, sf).save(spark, path)
    return spark.read.parquet(f"{path}/vocab").select("column", "value", "code")


@query("load_workflow", _sql_transformed())
def load_workflow(spark, sf):
    path = new_path(spark, "workflow")
    train, valid = _days(spark, sf)
    workflow().fit(train).save(spark, path)
    return _typed(FittedWorkflow.load(spark, path).transform(train.unionByName(valid), ROW_KEY))


@query("sink_features", _sql_transformed())
def sink_features(spark, sf):
    """Both parts as written, training rows in shuffled order within partitions."""
    train, valid = _kept_days(spark, sf)
    fitted, path = workflow().fit(train), new_path(spark, "features")
    for name, part, seed in (("train", train, 7), ("valid", valid, None)):
        out = fitted.transform(part, ROW_KEY)
        write_features(out, f"{path}/{name}", CLICKS, ROW_KEY, shuffle_seed=seed, real="double")
    return rounded(spark.read.parquet(f"{path}/train", f"{path}/valid"), *CONTS)
