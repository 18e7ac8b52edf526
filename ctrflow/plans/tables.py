"""Queries: limits, shuffles, unions, versions, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ctrflow.functions import scalars
from ctrflow.operators import sampling
from ctrflow.operators.metrics import join_label_score
from ctrflow.operators.order import dense_seq
from ctrflow.operators.statistics import top_values
from ctrflow.plans.fixtures import (
    ROW_KEY,
    SQL_CLICKS,
    SQL_SCORED,
    clicks,
    numbered,
    scored,
    table,
    with_sql,
)
from ctrflow.plans.registry import query

KEY = ", ".join(ROW_KEY)


@query("shuffle_within_partition", with_sql(SQL_CLICKS, body=f"select {KEY}, label from clicks"))
def shuffle_within_partition(spark, sf):
    rows = clicks(spark, sf).select(*ROW_KEY, "label")
    return sampling.shuffle_within_partition(rows, ROW_KEY, 11)


@query("limit_rows", "select event_id, value from events order by ts, event_id limit 1000")
def limit_rows(spark, sf):
    return sampling.head(table(spark, sf, "events"), 1000, ["ts", "event_id"]).select("event_id", "value")


@query(
    "latest_version",
    """with log as (
      select o_clerk as model, version, min(path) as path from (
        select 'm' || cast(o_custkey % 17 as varchar) as o_clerk, o_orderkey % 997 as version,
          'models/m' || cast(o_custkey % 17 as varchar) || '/v' || cast(o_orderkey % 997 as varchar)
            || '/weights.bin' as path from orders) group by 1, 2)
    select model, cast(max(version) as bigint) as version, arg_max(path, version) as path,
      cast(max(version) + 1 as bigint) as next_version from log group by model""",
)
def latest_version(spark, sf):
    paths = table(spark, sf, "orders").select(
        F.concat(
            F.lit("models/m"), (F.col("o_custkey") % 17).cast("string"),
            F.lit("/v"), (F.col("o_orderkey") % 997).cast("string"), F.lit("/weights.bin"),
        ).alias("path")
    )
    return sampling.latest_version(sampling.artifact_versions(paths))


@query(
    "top_k_values",
    """select 'p_brand' as feature, value, count, rank from (
         select p_brand as value, count(*) as count,
           row_number() over (order by count(*) desc, p_brand) as rank
         from lineitem join part on l_partkey = p_partkey group by p_brand) where rank <= 20""",
)
def top_k_values(spark, sf):
    parts = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    out = top_values(parts, ["p_brand"], 20)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "union_frames",
    """select c_custkey as k, c_name as name, c_mktsegment as segment, cast(null as double) as price
       from customer
       union all select p_partkey, p_name, null, p_retailprice from part""",
)
def union_frames(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    return sampling.union_frames(customer, part)


@query(
    "union_batches",
    with_sql(
        SQL_SCORED,
        body="select event_id, cast(floor((seq - 1) / 64) as bigint) as batch, predval from scored",
    ),
)
def union_batches(spark, sf):
    """Even and odd batches appended to each other: every row once, its batch kept."""
    rows = numbered(spark, sf).withColumn("batch", F.floor((F.col("seq") - 1) / 64).cast("bigint"))
    rows = rows.select("event_id", "batch", "predval")
    return sampling.union_frames(rows.where("batch % 2 = 0"), rows.where("batch % 2 = 1"))


@query("dense_seq", with_sql(SQL_SCORED, body="select event_id, seq from scored"))
def dense_sequence(spark, sf):
    return dense_seq(scored(spark, sf), ["ts", "event_id"], unique=True).select("event_id", "seq")


@query(
    "join_label_score",
    with_sql(SQL_SCORED, body="select event_id, trueval, predval from scored"),
)
def label_score(spark, sf):
    rows = scored(spark, sf)
    return join_label_score(rows.select("event_id", "trueval"), rows.select("event_id", "predval"), ["event_id"])


@query(
    "scalar_paths_dates",
    """with p as (
      select event_id, ts, 'base/' || event_type || '/' || cast(user_id as varchar) || '/day_'
        || cast(event_id % 30 as varchar) || '.parquet' as path, event_id % 30 as d from events)
    select event_id, 'day_' || cast(d as varchar) || '.parquet' as name,
      regexp_matches(split_part(path, '/', 4), '^day_[0-9]{1,2}\\.parquet$') as is_day,
      split_part(path, '/', 4) as base, split_part(path, '/', 3) as version,
      'base/' || split_part(path, '/', 2) || '/7/' || split_part(path, '/', 4) as moved,
      strftime(ts, '%d_%m_%Y-%H-%M-%S') as log_time,
      cast(epoch(date_trunc('second', ts)) as bigint) as parsed,
      epoch_us(ts) - epoch_us(timestamp '2024-01-10') >= 60000000 as due from p""",
)
def scalar_paths_dates(spark, sf):
    day = F.col("event_id") % 30
    rows = table(spark, sf, "events").select(
        "event_id", "ts", day.alias("d"),
        F.concat_ws(
            "/", F.lit("base"), "event_type", F.col("user_id").cast("string"), scalars.day_file(day)
        ).alias("path"),
    )
    log_time = scalars.log_file_time(F.col("ts"))
    base = scalars.base_name(F.col("path"))
    return rows.select(
        "event_id",
        scalars.day_file(F.col("d")).alias("name"),
        scalars.is_day_file(base).alias("is_day"),
        base.alias("base"),
        scalars.path_part(F.col("path"), 2).alias("version"),
        scalars.with_version(F.col("path"), F.lit(7)).alias("moved"),
        log_time.alias("log_time"),
        F.unix_seconds(scalars.parse_log_time(log_time)).alias("parsed"),
        scalars.due(F.col("ts"), F.lit("2024-01-10 00:00:00"), 60).alias("due"),
    )
