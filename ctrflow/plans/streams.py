"""Queries on streams: a table is staged as files and played through the stream operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.plans.features import KEY, _sql_transformed, _typed
from ctrflow.plans.fixtures import (
    CLICKS,
    N_TRAIN,
    N_VAL,
    ROW_KEY,
    SQL_ALERTS,
    SQL_CLICKS,
    SQL_RUNS,
    SQL_SCORED,
    SQL_SERIES,
    alert_rows,
    clicks,
    runs,
    scored,
    series,
    table,
    with_sql,
    workflow,
)
from ctrflow.plans.monitoring import ARRIVAL, N, _sql_rolling
from ctrflow.plans.registry import query, rounded, sql_round
from ctrflow.scratch import new_path, set_times
from ctrflow.sources.scans import day_split
from ctrflow.streaming import events as ev
from ctrflow.streaming import monitor as mon
from ctrflow.streaming.requestlog import log_requests
from ctrflow.streaming.windows import live_increase, window_deltas

ROWS_PER_BATCH = 1_000_000


def feed(spark, df: DataFrame, order, rows_per_batch: int = ROWS_PER_BATCH, least: int = 8, files: int = 4) -> DataFrame:
    """The rows as a stream in the given order: batches of about ``rows_per_batch`` rows, ``least`` at least, whatever the session's partitions.

    The files of a batch are written side by side, one range of the order per task. A file stream goes by modification
    time, so the files get times in the order of their ranges.
    """
    path = new_path(spark, "feed")
    ranges = max(least, -(-df.count() // rows_per_batch)) * files
    df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.parquet(path)
    set_times(spark, path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def played(stream: DataFrame, spark) -> tuple[DataFrame, list[int]]:
    """Play an append stream to its end; what it wrote, and the rows of each batch."""
    out, progress = followed(stream, spark)
    return out, [p["numInputRows"] for p in progress if p["numInputRows"]]


def followed(stream: DataFrame, spark) -> tuple[DataFrame, list]:
    """Play an append stream to its end; what it wrote, and the progress of every batch."""
    path = new_path(spark, "out")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1_000_000)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    # every batch commits one state store per partition, and the streams here have a few dozen keys at most
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(partitions), spark.sparkContext.defaultParallelism)))
    try:
        query_ = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", new_path(spark, "ckpt"))
            .trigger(availableNow=True)
            .start(path)
        )
        query_.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return spark.read.schema(stream.schema).parquet(path), query_.recentProgress


def dropped_rows(progress: list) -> int:
    """Rows that came behind the watermark."""
    return sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])


def sql_passed(ts: str, step_ms: int, latest: str, delay_ms: int) -> str:
    """Whether the watermark passes the end of the step that holds a time before the stream ends."""
    return f"(epoch_us({ts}) // {step_ms * 1000} + 1) * {step_ms} <= epoch_us({latest}) // 1000 - {delay_ms}"


def run(stream: DataFrame, spark) -> DataFrame:
    return played(stream, spark)[0]


HOUR = 3_600_000


@query(
    "stream_rolling_auc",
    _sql_rolling(
        f"""select event_id, model_key, in_window, {sql_round('held', 9)} as rolling_auc from (
          select *, coalesce(last_value(auc ignore nulls) over (
            partition by model_key order by n rows unbounded preceding), 1.0) as held from rolling)""",
        "model_key",
    ),
)
def stream_rolling_auc(spark, sf):
    """Without resets: every batch in blocks of all keys."""
    path = new_path(spark, "rolling")
    # a batch is put in order as a whole, so it may as well be large
    events = feed(spark, scored(spark, sf), ARRIVAL, 4 * ROWS_PER_BATCH, least=2)
    mon.rolling_auc_stream(events, path, new_path(spark, "ckpt"), N).awaitTermination()
    out = mon.read_rolling(spark, path)
    return rounded(
        out.select("event_id", "model_key", "in_window", "rolling_auc"), "rolling_auc", digits=9
    )


LIMIT, COOLDOWN = 0.45, 50

#: From each start of a buffer to the next accepted alert, which is the start of the next one. Window sums come
#: from pairs (older row i, newer row j) less than N apart: what enters with j, less what leaves with i.
SQL_RESETS = "with recursive " + ",".join([
    SQL_SCORED,
    """s as (select event_id, model_key as k, trueval as y, predval as p,
         row_number() over (partition by model_key order by seq) as n from scored)""",
    f"""pairs as (select b.k, a.n as i, b.n as j, case when a.y = b.y then 0.0 when a.p = b.p then 0.5
           when (a.y > b.y) = (a.p > b.p) then 1.0 else 0.0 end as c
         from s a join s b on a.k = b.k and b.n > a.n and b.n < a.n + {N})""",
    """entering as (select k, j as n, sum(c) as v from pairs group by 1, 2)""",
    """leaving as (select k, i as n, sum(c) as v from pairs group by 1, 2)""",
    f"""full_windows as (
         select s.k, s.n, sum(coalesce(e.v, 0) - coalesce(l.v, 0)) over (partition by s.k order by s.n) as area,
           sum(s.y) over (partition by s.k order by s.n rows {N - 1} preceding) as pos
         from s left join entering e on e.k = s.k and e.n = s.n left join leaving l on l.k = s.k and l.n = s.n - {N})""",
    f"""resets(k, start, event_id, in_window, auc, step) as (
         select k, cast(1 as bigint), cast(null as bigint), cast(null as bigint), cast(null as double), 0
         from s group by k
       union all
         select k, hit_at + 1, event_id, size, held, step + 1 from (
           select *, row_number() over (partition by k order by n) as first_hit, n as hit_at from (
             select *, coalesce(last_value(case when pos > 0 and pos < size then area / (pos * (size - pos)) end ignore nulls)
               over (partition by k order by n rows unbounded preceding), 1.0) as held
             from (
               select w.k, w.step, w.start, w.n, w.event_id, least(w.n - w.start + 1, {N}) as size,
                 case when w.n - w.start + 1 >= {N} then f.area
                   else sum(w.v) over (partition by w.k order by w.n) end as area,
                 case when w.n - w.start + 1 >= {N} then f.pos
                   else sum(w.y) over (partition by w.k order by w.n) end as pos
               from (
                 select r.k, r.step, r.start, s.n, any_value(s.event_id) as event_id, any_value(s.y) as y,
                   coalesce(sum(q.c), 0) as v
                 from resets r join s on s.k = r.k and s.n >= r.start
                 left join pairs q on q.k = r.k and q.j = s.n and q.i >= r.start and s.n < r.start + {N}
                 group by r.k, r.step, r.start, s.n) w
               join full_windows f on f.k = w.k and f.n = w.n))
           where held < {LIMIT} and size > {N // 2} and (step = 0 or n - start + 1 > {COOLDOWN}))
         where first_hit = 1)""",
]) + f"""
select event_id, k as model_key, in_window, {sql_round('auc', 9)} as rolling_auc from resets
join scored using (event_id) where step > 0 and {sql_passed('ts', HOUR, '(select max(ts) from events)', 0)}"""


@query("stream_trigger_reset", SQL_RESETS)
def stream_trigger_reset(spark, sf):
    """Accepted alerts, each of which cleared its model's buffer, in the hours that the stream has passed."""
    cfg = mon.MonitorConfig(n=N, threshold=LIMIT, cooldown=COOLDOWN)
    events = scored(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    out = run(mon.monitor_stream(feed(spark, events, ARRIVAL), cfg, step="1 hour"), spark).where("accepted")
    return rounded(out.select("event_id", "model_key", "in_window", "rolling_auc"), "rolling_auc", digits=9)


@query(
    "stream_trigger_action",
    with_sql(
        SQL_RUNS, SQL_ALERTS,
        body="""select event_id, pipeline from alert_rows
        where pipeline in (select pipeline from runs)
          and pipeline not in (select pipeline from runs where status = 'Running')""",
    ),
)
def stream_trigger_action(spark, sf):
    """Alerts that would start a run, as stored by the stream."""
    alerts = alert_rows(spark, sf).withColumn("accepted", F.lit(True))
    path, stored = new_path(spark, "alerts"), new_path(spark, "stored")
    alerts.write.parquet(path)
    stream = spark.readStream.schema(alerts.schema).parquet(path)
    mon.act_on_alerts(
        stream, lambda: runs(spark, sf), stored, new_path(spark, "ckpt"), start=lambda name: None
    ).awaitTermination()
    return spark.read.parquet(stored).select("event_id", "pipeline")


SQL_REQUESTS = with_sql(
    SQL_CLICKS,
    body=f"""select {KEY}, cast(label as double) as label, {', '.join([*CLICKS.conts, *CLICKS.cats])}
    from clicks""",
)


@query(
    "stream_request_log",
    SQL_REQUESTS,
)
def stream_request_log(spark, sf):
    """Everything logged, the rest written out when the stream stops."""
    requests = clicks(spark, sf).select(
        *ROW_KEY, F.col("label").cast("double").alias("label"), *CLICKS.conts, *CLICKS.cats
    )
    path = new_path(spark, "requests")
    requests.write.parquet(path)
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 4).parquet(path)
    running, log = log_requests(
        stream, new_path(spark, "log"), new_path(spark, "ckpt"), 320, timedelta(seconds=1),
        availableNow=True,
    )
    running.awaitTermination()
    log.close(requests.schema)
    return log.read()


@query("sink_request_log", SQL_REQUESTS)
def sink_request_log(spark, sf):
    """The log written by hand, batch by batch, without a stream: the files it left."""
    from ctrflow.streaming.requestlog import RequestLog

    requests = clicks(spark, sf).select(
        *ROW_KEY, F.col("label").cast("double").alias("label"), *CLICKS.conts, *CLICKS.cats
    )
    log = RequestLog(spark, new_path(spark, "log"), 320, timedelta(seconds=0))
    for batch in range(3):
        log.batch(requests.where(F.pmod(F.xxhash64(*ROW_KEY), F.lit(3)) == batch), batch)
    log.close(requests.schema)
    return log.read()


@query("stream_drain", "select *, 0::bigint as left_behind from events")
def stream_drain(spark, sf):
    events = table(spark, sf, "events")
    src, dst = new_path(spark, "src"), new_path(spark, "dst")
    events.write.parquet(src)
    ev.drain(spark, src, dst, new_path(spark, "ckpt"), events.schema, max_files=2).awaitTermination()
    left = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(src).count()
    return ev.read_drained(spark, dst, events.schema).withColumn("left_behind", F.lit(left).cast("bigint"))


@query(
    "source_events",
    with_sql(
        SQL_SCORED,
        """said as (select event_id, model_key, event_id % 13 = 0 as corrupt, event_id % 5 = 0 as gap, event_id % 3 as k,
             predval, cast(trueval as double) as trueval from scored)""",
        body="""select event_id, cast(model_key as varchar) as model_key, corrupt,
          case when not corrupt and not gap then predval end as predval, case when not corrupt then trueval end as trueval,
          case when not corrupt then cast(event_id as double) end as a0, case when not corrupt and k <> 0 then -1.5::double end as a1,
          case when not corrupt then k::double end as b0, case when not corrupt and k > 0 then 7::double end as b1,
          case when not corrupt and k > 1 then cast(model_key as double) end as b2,
          case when not corrupt then 2 end::int as n_a, case when not corrupt then k + 1 end::int as n_b from said""",
    ),
)
def source_events(spark, sf):
    """Messages read as a stream: arrays of several numbers, of different lengths, with bare NaN, and unreadable JSON."""
    k = F.col("event_id") % 3

    def text(c):
        return F.col(c).cast("string")

    lists = F.concat(
        F.lit('{"input0":['), text("event_id"), F.lit(","), F.when(k == 0, "NaN").otherwise("-1.5"),
        F.lit('],"input1":['), k.cast("string"), F.when(k > 0, ",7").otherwise(""),
        F.when(k > 1, F.concat(F.lit(","), text("model_key"))).otherwise(""),
    )
    payload = F.when(F.col("event_id") % 13 == 0, "{broken").otherwise(
        F.concat(
            lists, F.lit('],"trueval":'), text("trueval"), F.lit(',"predval":'),
            F.when(F.col("event_id") % 5 == 0, "NaN").otherwise(text("predval")), F.lit("}"),
        )
    )
    path = new_path(spark, "messages")
    messages = scored(spark, sf).select(
        "event_id", text("model_key").alias("model_key"), F.col("ts").cast("timestamp").alias("ts"), payload.alias("payload")
    )
    messages.repartition(6, "event_id").write.json(path)
    out = run(ev.read_events(spark, path, max_files=2), spark)

    def at(array, i):
        return F.get(array, F.lit(i)).alias(f"{'a' if array == 'input0' else 'b'}{i}")

    return out.select(
        "event_id", "model_key", F.col("corrupt").isNotNull().alias("corrupt"), "predval", "trueval",
        *[at("input0", i) for i in range(2)], *[at("input1", i) for i in range(3)],
        F.when(F.col("corrupt").isNull(), F.size("input0")).alias("n_a"),
        F.when(F.col("corrupt").isNull(), F.size("input1")).alias("n_b"),
    )


@query("stream_backpressure", f"select event_id, {sql_round('value')} as predval, true as held_back from events")
def stream_backpressure(spark, sf):
    """All events, taken in one of several files per batch at most."""
    files = 6
    messages = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("model_key"), F.col("ts").cast("timestamp").alias("ts"),
        F.to_json(F.struct(F.col("value").alias("predval"))).alias("payload"),
    )
    path = new_path(spark, "messages")
    messages.repartition(files, "event_id").write.json(path)
    stream = ev.read_events(spark, path, max_files=1).select("event_id", "predval")
    out, sizes = played(stream, spark)
    bound = messages.count() * 2 // files
    held_back = len(sizes) == files and max(sizes) <= bound
    return rounded(out, "predval").withColumn("held_back", F.lit(held_back))


@query("stream_transform", _sql_transformed())
def stream_transform(spark, sf):
    """All rows through the workflow fitted on the training days."""
    new = clicks(spark, sf)
    path = new_path(spark, "arriving")
    new.write.parquet(path)
    out = new_path(spark, "features")
    stream = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 4).parquet(path)
    # fitted on the rows that arrive, so that they are derived once
    fitted = workflow().fit(day_split(spark.read.schema(new.schema).parquet(path), N_TRAIN, N_VAL)[0])
    ev.transform_stream(stream, fitted, out, new_path(spark, "ckpt"), ROW_KEY).awaitTermination()
    return _typed(ev.read_transformed(spark, out))


@query(
    "stream_metric_window",
    with_sql(
        SQL_SERIES,
        """w as (select metric, instance, value, ts, unnest(range(
             (epoch_us(ts) - 21600000000) // 7200000000 + 1, epoch_us(ts) // 7200000000 + 1)) as k
             from series)""",
        """d as (select metric, instance, k * 7200 as start_s, count(*) as samples,
             arg_max(value, ts) - arg_min(value, ts) as delta from w group by 1, 2, 3)""",
        body="""select metric, instance, cast(start_s as bigint) as start_s, samples,
          case when samples >= 2 then delta end as delta from d""",
    ),
)
def stream_metric_window(spark, sf):
    """Six-hour windows every two hours. A last sample long after the others closes them all."""
    live = series(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    last = live.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).where("ts is not null")
    tick = last.select(F.lit("tick").alias("metric"), F.lit("tick").alias("instance"), "ts", F.lit(0).cast("bigint").alias("value"))
    stream = feed(spark, live.unionByName(tick), ["ts", "metric", "instance"])
    out = run(window_deltas(stream, ["metric", "instance"], "6 hours", "2 hours", "1 day"), spark)
    return out.where("metric <> 'tick'").select(
        "metric", "instance", F.unix_seconds("start").alias("start_s"), "samples",
        F.col("delta").cast("bigint").alias("delta"),
    )


@query(
    "stream_metric_increase",
    with_sql(
        SQL_SERIES,
        """stepped as (select *, case when change is null then 0 when change < 0 then value else change end as step from (
             select *, value - lag(value) over (partition by metric, instance order by ts, value) as change from series))""",
        """w as (select *, unnest(range((epoch_us(ts) + 7199999999) // 7200000000, (epoch_us(ts) + 21600000000) // 7200000000 + 1)) as k
             from stepped)""",
        f"""d as (select metric, instance, k * 7200 as at_s, count(*) as samples, sum(step) as increase,
             last(value order by ts, value) - first(value order by ts, value) as delta
             from w where ((k * 7200000) // {6 * HOUR} + 1) * {6 * HOUR} <= (select epoch_us(max(ts)) // 1000 from events) - 43200000
             group by 1, 2, 3)""",
        body=f"""select metric, instance, cast(at_s as bigint) as at_s, samples, cast(increase as bigint) as increase,
          {sql_round('increase / 21600.0', 9)} as rate, case when samples > 1 then delta end as delta from d""",
    ),
)
def stream_metric_increase(spark, sf):
    """Increase, rate and delta over six hours every two hours, of samples that arrive up to half a day late."""
    live = series(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    # each series has its own lag, so that rows of different times meet in a batch
    lag = F.pmod(F.crc32(F.concat("metric", "instance").cast("binary")), F.lit(43_000)) * 1_000_000
    stream = feed(spark, live.withColumn("arrival", F.unix_micros("ts") + lag), ["arrival", "ts", "metric", "instance"])
    out = run(live_increase(stream, ["metric", "instance"], "6 hours", "2 hours", "12 hours", "6 hours"), spark)
    out = out.select("metric", "instance", F.unix_seconds("at").alias("at_s"), "samples", "increase", "rate", "delta")
    return rounded(out, "rate", digits=9)


SQL_LATE = "event_id % 50 = 0 and ts < (select max(ts) from events) - interval 2 days"


@query(
    "stream_late_data",
    f"""select event_id, (select count(*) from events where {SQL_LATE}) as dropped
    from events where not ({SQL_LATE})""",
)
def stream_late_data(spark, sf):
    """Rows that arrive days behind the watermark are dropped and counted, all others are kept."""
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id")
    last = events.agg(F.max("ts")).first()[0]
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(last) - F.expr("interval 2 days"))
    arriving = events.withColumn("late", late.cast("int"))
    path, checkpoint, out = (new_path(spark, n) for n in ("feed", "ckpt", "out"))
    dropped = 0
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1_000_000)
    # what is late arrives after all the rest
    for turn in (0, 1):
        part = arriving.where(F.col("late") == turn)
        part.repartitionByRange(4, "ts", "event_id").write.mode("append").parquet(path)
        if turn == 0:
            set_times(spark, path)
        stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 1).parquet(path)
        kept = mon.late_data(stream, "ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
        query_ = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        query_.awaitTermination()
        dropped += dropped_rows(query_.recentProgress)
    return spark.read.parquet(out).select("event_id", F.lit(dropped).cast("bigint").alias("dropped"))


#: Every fiftieth event of the first half of the time comes last.
SQL_LAST = """event_id % 50 = 0 and epoch_us(ts) < (select (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 from events)"""
SQL_ON_TIME = SQL_SCORED.replace("from events", f"from events where not ({SQL_LAST})")


@query(
    "stream_event_order",
    _sql_rolling(
        f"""select event_id, model_key, in_window, {sql_round('held', 9)} as rolling_auc,
          (select count(*) from events where {SQL_LAST}) as dropped from (
            select *, coalesce(last_value(auc ignore nulls) over (
              partition by model_key order by n rows unbounded preceding), 1.0) as held from rolling)
        join scored using (event_id, model_key)
        where {sql_passed('ts', HOUR, '(select max(ts) from events)', HOUR)}""",
        "model_key",
    ).replace(SQL_SCORED, SQL_ON_TIME),
)
def stream_event_order(spark, sf):
    """Events that arrive up to an hour out of order are evaluated in their order; what is far too late is dropped and counted."""
    events = scored(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    late = (F.col("event_id") % 50 == 0) & (F.unix_micros("ts") < (first + last) // 2)
    on_the_way = F.pmod(F.xxhash64("event_id"), F.lit(3_599_000_000))
    arrival = F.when(late, F.lit(last + 2 * HOUR * 1000)).otherwise(F.unix_micros("ts") + on_the_way)
    stream = feed(spark, events.withColumn("arrival", arrival), ["arrival", "event_id"])
    cfg = mon.MonitorConfig(n=N, reset=False)
    out, progress = followed(mon.monitor_stream(stream, cfg, delay="1 hour", step="1 hour"), spark)
    out = out.withColumn("dropped", F.lit(dropped_rows(progress)).cast("bigint"))
    return rounded(
        out.select("event_id", "model_key", "in_window", "rolling_auc", "dropped"), "rolling_auc", digits=9
    )
