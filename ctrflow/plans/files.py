"""Queries: scans and sinks. Tables are staged in the shared folder first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ctrflow.operators.sampling import head, sample_one_file
from ctrflow.operators.statistics import feature_stats, load_stats, save_stats
from ctrflow.plans.fixtures import CLICKS, ROW_KEY, SQL_CLICKS, clicks, kept_clicks, table, with_sql
from ctrflow.plans.registry import query, rounded, sql_round
from ctrflow.scratch import new_path
from ctrflow.sources import scans, sinks
from ctrflow.streaming import events as streams

KEY = ", ".join(ROW_KEY)


@query(
    "scan_day_split",
    with_sql(
        SQL_CLICKS,
        body=f"""select {KEY}, day, case when day < 2 then 'train' else 'valid' end as split
        from clicks where day between 0 and 3""",
    ),
)
def scan_day_split(spark, sf):
    train, valid = scans.day_split(clicks(spark, sf), 2, 2)
    return train.select(*ROW_KEY, "day", F.lit("train").alias("split")).unionByName(
        valid.select(*ROW_KEY, "day", F.lit("valid").alias("split"))
    )


@query("scan_count_days", with_sql(SQL_CLICKS, body="select count(distinct day) as days from clicks"))
def scan_count_days(spark, sf):
    return scans.count_days(clicks(spark, sf))


def _staged(spark, sf, name="orders"):
    path = new_path(spark, name)
    table(spark, sf, name).write.parquet(path)
    return path


ORDERS = "select * from orders"


@query("scan_new_files", ORDERS)
def scan_new_files(spark, sf):
    return scans.scan_new(spark, _staged(spark, sf))


@query("scan_parquet_files", ORDERS)
def scan_parquet_files(spark, sf):
    return scans.read_parquet_dir(spark, _staged(spark, sf))


@query(
    "scan_whole_file",
    "select * from lineitem",
)
def scan_whole_file(spark, sf):
    return table(spark, sf, "lineitem")


@query(
    "scan_head",
    with_sql(SQL_CLICKS, body=f"select {KEY}, label from clicks order by {KEY} limit 640"),
)
def scan_head(spark, sf):
    return head(clicks(spark, sf), 64 * 10, ROW_KEY).select(*ROW_KEY, "label")


def _csv(spark, sf):
    path = new_path(spark, "csv")
    orders = table(spark, sf, "orders")
    orders.write.option("header", True).csv(path)
    return path, orders.schema


@query("scan_csv_files", ORDERS)
def scan_csv_files(spark, sf):
    path, schema = _csv(spark, sf)
    return scans.read_csv_dir(spark, path, schema)


@query("sink_parquet_single", ORDERS)
def sink_parquet_single(spark, sf):
    path, schema = _csv(spark, sf)
    out = new_path(spark, "parquet")
    sinks.csv_to_parquet(spark, path, out, schema)
    return spark.read.parquet(out)


@query("list_files_limit", "select 10::bigint as n, true as filled, true as first_ones")
def list_files_limit(spark, sf):
    """Ten files of the written click log: none empty, and none left out that comes before them."""
    path = new_path(spark, "days")
    clicks(spark, sf).write.partitionBy("day").parquet(path)
    files = scans.list_files(spark, path, 10).select("path", "length")
    last = files.agg(F.max("path").alias("last"))
    upto = scans.list_files(spark, path).join(last, F.col("path") <= F.col("last")).agg(F.count(F.lit(1)).alias("upto"))
    return files.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("length") > 0).alias("filled")).join(
        upto, F.col("n") <= F.col("upto")
    ).select("n", "filled", (F.col("n") == F.col("upto")).alias("first_ones"))


@query(
    "sink_manifest",
    with_sql(
        SQL_CLICKS,
        body="""select 'day=' || cast(day as varchar) as folder, count(*) as rows
        from clicks group by day""",
    ),
)
def sink_manifest(spark, sf):
    """Rows per written file, added up per day folder."""
    path = new_path(spark, "days")
    clicks(spark, sf).write.partitionBy("day").parquet(path)
    files = sinks.manifest(spark.read.parquet(path))
    folder = F.element_at(F.split("file", "/"), -2)
    return files.groupBy(folder.alias("folder")).agg(F.sum("rows").alias("rows"))


@query("sample_one_file", "select 1::bigint as files, true as known")
def sample_one(spark, sf):
    """One of the files of the written click log."""
    path = new_path(spark, "days")
    clicks(spark, sf).write.partitionBy("day").parquet(path)
    rows = spark.read.parquet(path)
    found = sample_one_file(rows, seed=3).join(sinks.manifest(rows), "file", "left")
    return found.agg(F.count(F.lit(1)).alias("files"), F.bool_and(F.col("rows") > 0).alias("known"))


@query("land_full", ORDERS)
def land_full(spark, sf):
    src, dst = _staged(spark, sf), new_path(spark, "base")
    sinks.land(spark, src, dst, "full")
    return spark.read.parquet(dst)


@query("land_incremental", ORDERS)
def land_incremental(spark, sf):
    """Landed twice from the same area: each file once."""
    src, dst = _staged(spark, sf), new_path(spark, "new")
    sinks.land(spark, src, dst, "incremental")
    sinks.land(spark, src, dst, "incremental")
    return spark.read.parquet(dst)


@query("drain_directory", ORDERS)
def drain_directory(spark, sf):
    src, dst = _staged(spark, sf), new_path(spark, "drained")
    schema = spark.read.parquet(src).schema
    streams.drain(spark, src, dst, new_path(spark, "ckpt"), schema).awaitTermination()
    left = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(src).count()
    # nothing counts as moved while a file is left
    return streams.read_drained(spark, dst, schema).where(F.lit(left) == 0)


def _sql_hist(c: str) -> str:
    return f"""select '{c}' as feature, cast(bin as int) as bin, cast(count(*) as double) as count from (
      select least(9, cast(floor(({c} - mn) / (mx - mn) * 10) as int)) as bin
      from clicks cross join (select min({c}) as mn, max({c}) as mx from clicks) where {c} is not null)
    group by bin"""


@query("sink_stats", with_sql(SQL_CLICKS, body=" union all ".join(_sql_hist(c) for c in CLICKS.conts)))
def sink_stats(spark, sf):
    """Histograms inside a saved record."""
    path = new_path(spark, "stats")
    save_stats(feature_stats(kept_clicks(spark, sf, CLICKS.conts), CLICKS.conts), path)
    hist = load_stats(spark, path).select("feature", F.posexplode("num.std_hist").alias("bin", "h"))
    return hist.select("feature", "bin", F.col("h.count").alias("count")).where("count > 0")


_STATS_COLS = [*CLICKS.conts, *CLICKS.cats]


@query(
    "load_stats",
    with_sql(
        SQL_CLICKS,
        body=" union all ".join(
            f"""select '{c}' as feature, count({c}) as n_present,
              {sql_round(f'avg({c})', 7) if c[0] == 'i' else 'null'} as mean,
              {'null' if c[0] == 'i' else f'count(distinct {c})'} as n_unique from clicks"""
            for c in _STATS_COLS
        ),
    ),
)
def load_saved_stats(spark, sf):
    path = new_path(spark, "stats")
    save_stats(feature_stats(kept_clicks(spark, sf, _STATS_COLS), _STATS_COLS), path)
    out = load_stats(spark, path).select(
        "feature", "n_present", F.col("num.mean").alias("mean"), F.col("str.n_unique").alias("n_unique")
    )
    return rounded(out, "mean", digits=7)
