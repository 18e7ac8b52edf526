"""Click logs, predictions, counters and runs derived from the test tables.

Each derivation has an SQL twin, so that a query and its oracle start from equal rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.operators.order import dense_seq, running_sums
from ctrflow.operators.transforms import Categorify, Clip, FillMissing, Normalize
from ctrflow.operators.workflow import Workflow
from ctrflow.schema import CtrSchema
from ctrflow.scratch import materialize, new_path

ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
CLICKS = CtrSchema(
    conts=tuple(f"i{n}" for n in range(1, 7)),
    cats=tuple(f"c{n}" for n in range(1, 8)),
    key=ROW_KEY,
)
N_TRAIN, N_VAL = 22, 2


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Click logs written by ``stage``, by application and folder: as one table, and in a folder per day.
_STAGED: dict[tuple[str, str], str] = {}
_STAGED_DAYS: dict[tuple[str, str], str] = {}


def stage(spark: SparkSession, sf: str) -> None:
    """Write the click log once, both ways; this application's queries then read it instead of deriving it."""
    rows, path, days = clicks(spark, sf), new_path(spark, "clicks"), new_path(spark, "days")
    rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.parquet(path)
    key = spark.sparkContext.applicationId, sf
    _STAGED[key] = path
    spark.read.parquet(path).write.partitionBy("day").parquet(days)
    _STAGED_DAYS[key] = days


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Click log: one row per line item."""
    staged = _STAGED.get((spark.sparkContext.applicationId, sf))
    if staged:
        return spark.read.parquet(staged)
    line, orders, customer, part = (
        table(spark, sf, t) for t in ("lineitem", "orders", "customer", "part")
    )
    # the narrow orders meet their customers first, so the wide rows are exchanged for orders and parts only
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_acctbal", "c_mktsegment"
    )
    joined = line.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    months = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 23941
    row = F.col("l_orderkey") + F.col("l_linenumber")
    return joined.select(
        *ROW_KEY,
        F.floor(months / 3.5).cast("int").alias("day"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.when(row % 7 != 0, F.col("l_quantity")).alias("i1"),
        F.col("l_extendedprice").alias("i2"),
        F.col("l_discount").alias("i3"),
        F.col("l_tax").alias("i4"),
        F.col("c_acctbal").alias("i5"),
        F.col("p_size").cast("double").alias("i6"),
        F.col("l_linestatus").alias("c1"),
        F.col("p_brand").alias("c2"),
        F.col("p_type").alias("c3"),
        F.col("c_mktsegment").alias("c4"),
        F.col("o_orderpriority").alias("c5"),
        F.col("l_suppkey").cast("string").alias("c6"),
        F.when(row % 11 != 0, F.col("l_partkey").cast("string")).alias("c7"),
    )


def kept_clicks(spark: SparkSession, sf: str, columns: Sequence[str] = ()) -> DataFrame:
    """The click log (or some columns) written down, for queries that read it several times."""
    rows = clicks(spark, sf)
    if columns:
        rows = rows.select(*columns)
    return rows if (spark.sparkContext.applicationId, sf) in _STAGED else materialize(rows, "clicks")


def day_log(spark: SparkSession, sf: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """The click log (or some columns), landed as files in one folder per day."""
    rows = clicks(spark, sf)
    if columns:
        rows = rows.select(*columns, "day")
    staged = _STAGED_DAYS.get((spark.sparkContext.applicationId, sf))
    if staged:
        return spark.read.schema(rows.schema).parquet(staged)
    path = new_path(spark, "days")
    rows.write.partitionBy("day").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


SQL_CLICKS = """
clicks as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    cast(floor((year(l_shipdate) * 12 + month(l_shipdate) - 23941) / 3.5) as int) as day,
    case when l_returnflag = 'R' then 1 else 0 end as label,
    case when (l_orderkey + l_linenumber) % 7 = 0 then null else l_quantity end as i1,
    l_extendedprice as i2, l_discount as i3, l_tax as i4, c_acctbal as i5,
    cast(p_size as double) as i6,
    l_linestatus as c1, p_brand as c2, p_type as c3, c_mktsegment as c4, o_orderpriority as c5,
    cast(l_suppkey as varchar) as c6,
    case when (l_orderkey + l_linenumber) % 11 = 0 then null
         else cast(l_partkey as varchar) end as c7
  from lineitem join orders on l_orderkey = o_orderkey
       join customer on o_custkey = c_custkey join part on l_partkey = p_partkey
)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions: one per event."""
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        (F.col("user_id") % 4).alias("model_key"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("trueval"),
        (F.col("value") / 500).alias("predval"),
    )


SQL_SCORED = """
scored as (
  select event_id, ts, row_number() over (order by ts, event_id) as seq,
         user_id % 4 as model_key,
         case when event_type = 'purchase' then 1 else 0 end as trueval, value / 500 as predval
  from events
)"""


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Counters per event type that restart every seventh day of the month, in long form.

    Written down as scraped samples would be: the counter operators read them twice.
    """
    events = table(spark, sf, "events").select(
        "ts",
        "event_id",
        F.col("event_type").alias("instance"),
        F.floor((F.dayofmonth("ts") - 1) / 7.0).cast("int").alias("epoch"),
        F.round(F.col("value") * 1000).cast("bigint").alias("us"),
        F.round(F.col("value") * 300).cast("bigint").alias("busy_us"),
        F.when(F.col("event_id") % 17 == 0, 1).otherwise(0).alias("failed"),
    )
    counters = {
        "success": F.lit(1), "queue_us": F.col("us"), "compute_us": F.col("busy_us"), "failure": F.col("failed"),
    }
    wide = running_sums(events, ["ts", "event_id"], counters, key=["instance", "epoch"], unique=True)
    long = wide.unpivot(["instance", "ts"], list(counters), "metric", "value")
    return materialize(long, "series")


SQL_SERIES = """
wide as (
  select event_type as instance, ts,
    count(*) over (partition by event_type, cast(floor((dayofmonth(ts) - 1) / 7.0) as int)
                   order by ts, event_id rows unbounded preceding) as success,
    cast(sum(cast(round(value * 1000) as bigint)) over w as bigint) as queue_us,
    cast(sum(cast(round(value * 300) as bigint)) over w as bigint) as compute_us,
    cast(sum(case when event_id % 17 = 0 then 1 else 0 end) over w as bigint) as failure
  from events
  window w as (partition by event_type, cast(floor((dayofmonth(ts) - 1) / 7.0) as int)
               order by ts, event_id rows unbounded preceding)
),
series as (
  select 'success' as metric, instance, ts, cast(success as bigint) as value from wide
  union all
  select 'queue_us', instance, ts, queue_us from wide
  union all
  select 'compute_us', instance, ts, compute_us from wide
  union all
  select 'failure', instance, ts, failure from wide
)"""


def ratio_series(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of requests per load-ratio bucket ``le`` and event type."""
    events = table(spark, sf, "events").select(
        "ts",
        "event_id",
        F.col("event_type").alias("instance"),
        (F.floor(F.col("value") / 50) * 50 + 50).cast("double").alias("le"),
        F.floor((F.dayofmonth("ts") - 1) / 7.0).cast("int").alias("epoch"),
    )
    counted = running_sums(
        events, ["ts", "event_id"], {"value": F.lit(1)}, key=["instance", "le", "epoch"], unique=True
    )
    return materialize(counted.select("instance", "le", "ts", "value"), "series")


SQL_RATIO_SERIES = """
ratio_series as (
  select event_type as instance, cast(floor(value / 50) * 50 + 50 as double) as le, ts,
    count(*) over (partition by event_type, floor(value / 50),
                                cast(floor((dayofmonth(ts) - 1) / 7.0) as int)
                   order by ts, event_id rows unbounded preceding) as value
  from events
)"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Retrain runs: orders of a customer group, the newer half of whose open orders run."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.concat(F.lit("ctr-"), (F.col("o_custkey") % 331).cast("string")).alias("pipeline"),
        F.col("o_orderpriority").alias("experiment"),
        F.when((F.col("o_orderstatus") == "O") & (F.year("o_orderdate") >= 2001), "Running")
        .when(F.col("o_orderstatus") == "P", "Failed")
        .otherwise("Succeeded")
        .alias("status"),
        F.col("o_orderdate").alias("listed_at"),
    )


SQL_RUNS = """
runs as (
  select cast(o_orderkey as varchar) as run_id,
    'ctr-' || cast(o_custkey % 331 as varchar) as pipeline, o_orderpriority as experiment,
    case when o_orderstatus = 'O' and year(o_orderdate) >= 2001 then 'Running'
         when o_orderstatus = 'P' then 'Failed' else 'Succeeded' end as status,
    o_orderdate as listed_at
  from orders
)"""


def alert_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts: error events, each about one pipeline; some pipelines never ran."""
    return table(spark, sf, "events").where("event_type = 'error'").select(
        "event_id", F.concat(F.lit("ctr-"), (F.col("user_id") % 400).cast("string")).alias("pipeline")
    )


SQL_ALERTS = """
alert_rows as (
  select event_id, 'ctr-' || cast(user_id % 400 as varchar) as pipeline
  from events where event_type = 'error'
)"""


def workflow(order: str = "value") -> Workflow:
    """The usual chain: codes for categories; fill, clip and normalise for numbers."""
    cats = CLICKS.cats >> Categorify(order)
    conts = CLICKS.conts >> FillMissing() >> Clip(min_value=0) >> Normalize()
    return Workflow(cats + conts + [CLICKS.label])


def numbered(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions with their arrival number."""
    return dense_seq(scored(spark, sf), ["ts", "event_id"], unique=True)


def with_sql(*ctes: str, body: str) -> str:
    """A statement from derivations and a final select."""
    return "with " + ",".join(ctes) + "\n" + body
