"""Live monitoring: rolling AUC per model, alerts, and the reset an accepted alert brings."""

from __future__ import annotations

import inspect
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ctrflow.functions.liveauc import WindowAuc
from ctrflow.operators.metrics import rolling_auc_held
from ctrflow.operators.runs import run_state, suppress_while_running
from ctrflow.scratch import delete_path, discard, exists, local_table, materialize
from ctrflow.streaming.ordered import TIME, InOrder, in_event_order, milliseconds


@dataclass(frozen=True)
class MonitorConfig:
    """Settings of the monitor.

    ``cooldown`` is how many rows after an accepted alert the next one can be accepted.
    Whether an alert is accepted has to be known where the buffer is kept, so a row
    carries it (``accepts``, see ``mark_accepting``) instead of asking the job runner.
    """

    n: int = 500
    threshold: float = 0.5
    frac: float = 0.5
    reset: bool = True
    cooldown: int = 0


#: Rows of the window in one entry of the state.
PIECE = 256


class _Monitor(InOrder):
    """The monitor of one key: a window in pieces, its pairs, the last AUC and the rows since the last reset.

    What is written back per step are the pieces that got rows; pieces that have left the window are removed.
    """

    def __init__(self, columns, order, step, cfg: MonitorConfig, key: str, label: str, score: str):
        super().__init__(columns, order, step)
        self.cfg, self.key, self.label, self.score = cfg, key, label, score

    def init(self, handle) -> None:
        super().init(handle)
        self._rows = handle.getMapState("rows", "piece bigint", "first bigint, labels array<double>, scores array<double>")
        self._totals = handle.getValueState(
            "totals", "start bigint, stop bigint, twice bigint, auc double, since bigint"
        )

    def _window(self, start: int, stop: int, twice: int) -> WindowAuc:
        held = []
        for piece in range(start // PIECE, -(-stop // PIECE) if stop > start else 0):
            first, labels, scores = self._rows.getValue((piece,))
            held += list(zip(labels, scores))[max(0, start - first) :]
        return WindowAuc(self.cfg.n, held, twice)

    def take(self, key, rows, end_ms):
        if rows is None:
            return
        cfg = self.cfg
        start, stop, twice, last, since = self._totals.get() or (0, 0, 0, 1.0, cfg.cooldown)
        kept = range(start // PIECE, -(-stop // PIECE) if stop > start else 0)
        window = self._window(start, stop, twice)
        at = stop
        auc, size, alert, accepted = [], [], [], []
        for y, p, may in zip(rows[self.label], rows[self.score], rows["accepts"]):
            window.push(math.nan if y is None else y, math.nan if p is None else p)
            at += 1
            now = window.value
            last = last if now is None else now
            since += 1
            low = last < cfg.threshold and len(window) > cfg.frac * cfg.n
            ok = bool(low and may and since > cfg.cooldown)
            auc.append(last)
            size.append(len(window))
            alert.append(low)
            accepted.append(ok)
            if ok and cfg.reset:
                window.clear()
                last, since, stop = 1.0, 0, at
        start = at - len(window)
        for piece in kept:
            if piece < start // PIECE or start == at:
                self._rows.removeKey((piece,))
        held = list(window.rows)
        for piece in range(max(start, stop) // PIECE, -(-at // PIECE) if held else 0):
            first, end = max(start, piece * PIECE), min(at, (piece + 1) * PIECE)
            labels, scores = zip(*held[first - start : end - start])
            self._rows.updateValue((piece,), (first, list(labels), list(scores)))
        self._totals.update((start, at, window.twice, last, since))
        out = rows[self.order].copy()
        out[self.key] = key[0]
        out["rolling_auc"], out["in_window"], out["alert"], out["accepted"] = auc, size, alert, accepted
        yield out[[self.key, *self.order, "rolling_auc", "in_window", "alert", "accepted"]]


def mark_accepting(events: DataFrame, runs: DataFrame, pipeline: str) -> DataFrame:
    """Add ``accepts``: the row's pipeline has run before and is not running now."""
    state = run_state(runs).select(
        F.col("pipeline").alias("__p"), (F.col("running") == 0).alias("__ok")
    )
    joined = events.join(state, F.col(pipeline) == F.col("__p"), "left")
    return joined.withColumn("accepts", F.coalesce("__ok", F.lit(False))).drop("__p", "__ok")


def monitor_stream(
    events: DataFrame,
    cfg: MonitorConfig,
    key: str = "model_key",
    order: Sequence[str] = ("ts", "event_id"),
    label: str = "trueval",
    score: str = "predval",
    delay: str = "0 seconds",
    step: str = "1 minute",
) -> DataFrame:
    """Rolling AUC and alert flags per event in event-time order, state kept per model key.

    The first of ``order`` is the event time, the others break its ties. Events may arrive in any order up to
    ``delay`` behind the latest; those behind that are dropped and counted by the stream. A ``step``'s rows come
    out when the watermark has passed its end. Clearing the window changes what all later rows see, so
    one key is sequential; a step of it is in memory at a time. Give distinct models distinct keys. Without
    resets, ``rolling_auc_stream`` spreads a key of any size.
    """
    fields = {f.name: f for f in events.schema.fields}
    ts, ties = order[0], list(order[1:])
    if "accepts" not in events.columns:
        events = events.withColumn("accepts", F.lit(True))
    events = events.withColumns({c: F.col(c).cast("double") for c in (label, score)})
    double, flag = T.DoubleType(), T.BooleanType()
    columns = [
        *[fields[c] for c in ties],
        T.StructField(label, double), T.StructField(score, double), T.StructField("accepts", flag),
    ]
    output = T.StructType(
        [
            fields[key], T.StructField(TIME, T.LongType()), *[fields[c] for c in ties],
            T.StructField("rolling_auc", double), T.StructField("in_window", T.LongType()),
            T.StructField("alert", flag), T.StructField("accepted", flag),
        ]
    )
    processor = _Monitor(columns, ties, milliseconds(step), cfg, key, label, score)
    return in_event_order(events, ts, [key], processor, output, delay)


def rolling_auc_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 500,
    key: str = "model_key",
    order: Sequence[str] = ("ts", "event_id"),
    label: str = "trueval",
    score: str = "predval",
    block: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Rolling AUC of a stream without resets, written to ``path``; a key of any size is spread over all tasks.

    Each batch is evaluated by ``operators.metrics`` in blocks, together with the last ``n - 1`` rows of each key
    of earlier batches. These, and each key's last AUC, are a small table that is written anew with each batch.
    Rows are taken in ``order`` within a batch, and batches in order of arrival. A batch that is played again starts
    from the same table and replaces what it wrote; ``read_rolling`` reads the results.
    """
    spark = events.sparkSession
    rows = events.select(key, *order, F.col(label).cast("double").alias(label), F.col(score).cast("double").alias(score))

    def batch(df: DataFrame, batch_id: int) -> None:
        fresh = df.withColumns({"__turn": F.lit(batch_id).cast("bigint"), "__known": F.lit(None).cast("double")})
        before = f"{path}/tail/{batch_id - 1}"
        if exists(spark, before):
            fresh = spark.read.schema(fresh.schema).parquet(before).unionByName(fresh)
        held = rolling_auc_held(fresh, ["__turn", *order], label, score, n, [key], block, known="__known")
        held = materialize(held, "held")
        mine = held.where(F.col("__turn") == batch_id).select(key, *order, "rolling_auc", "in_window")
        mine.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        latest = Window.partitionBy(key).orderBy(F.desc("__turn"), *[F.desc(c) for c in order])
        tail = held.withColumn("__at", F.row_number().over(latest)).where(F.col("__at") < max(n, 2))
        tail.withColumn("__known", F.col("rolling_auc")).select(*fresh.columns).write.mode("overwrite").parquet(
            f"{path}/tail/{batch_id}"
        )
        discard(held)
        delete_path(spark, f"{path}/tail/{batch_id - 2}")

    return (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rolling(spark: SparkSession, path: str) -> DataFrame:
    """What ``rolling_auc_stream`` has written."""
    return spark.read.parquet(f"{path}/rows").drop("batch_id")


def late_data(events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Give events a watermark. Without it they are taken as they arrive."""
    return events.withWatermark(ts, delay)


def _read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else local_table(spark, schema, [])


def _not_listed(requests: DataFrame, listed: DataFrame) -> DataFrame:
    """Requests ``(pipeline, listed)`` of pipelines that have no more runs ``now`` than they had then."""
    now = requests.join(listed, "pipeline", "left").where(F.coalesce("now", F.lit(0)) <= F.col("listed"))
    return now.select("pipeline", "listed")


def act_on_alerts(
    monitored: DataFrame,
    runs: Callable[[], DataFrame],
    alerts_path: str,
    checkpoint: str,
    start: Callable[..., None],
    pipeline: str = "pipeline",
    **trigger,
) -> StreamingQuery:
    """Store accepted alerts and start the retrain job of each pipeline that may run.

    ``runs`` is asked anew for every batch. ``start`` gets a pipeline name and, if it takes two arguments, the id of the
    request, which is the same when a request is repeated. A batch that is played again keeps the decision of
    its first time. What it is going to start is written down before the first start. After a failure it starts
    what has neither been recorded as started nor been listed since; a job service that
    lists runs late can tell a repeated request by its id. A pipeline that was started but is not listed yet, so
    that it has no more runs than when it was started, is not started again by later alerts.
    """
    base = alerts_path.rstrip("/")
    record = "pipeline string, listed bigint"
    named = len(inspect.signature(start).parameters) > 1

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        stored, intents, started = f"{base}/batch_id={batch_id}", f"{base}_intents/{batch_id}", f"{base}_started/{batch_id}"
        listed = runs().groupBy("pipeline").agg(F.count(F.lit(1)).alias("now"))
        # in flight: started by earlier batches and not listed yet
        waiting = materialize(_not_listed(_read_if_there(spark, f"{base}_open/{batch_id - 1}", record), listed), "waiting")
        if not exists(spark, f"{stored}/_SUCCESS"):
            fresh = suppress_while_running(df.where("accepted"), runs())
            fresh = fresh.join(waiting.select(F.col("pipeline").alias(pipeline)), pipeline, "left_anti")
            fresh.select(*df.columns).write.mode("overwrite").parquet(stored)
        again = exists(spark, f"{intents}/_SUCCESS")
        if not again:
            # one name per pipeline, not per alert
            names = spark.read.schema(df.schema).parquet(stored).select(F.col(pipeline).alias("pipeline")).distinct()
            names = names.join(listed, "pipeline", "left").select("pipeline", F.coalesce("now", F.lit(0)).alias("listed"))
            names.coalesce(1).write.mode("overwrite").parquet(intents)
        wanted = spark.read.schema(record).parquet(intents)
        todo = wanted.join(_read_if_there(spark, started, record).select("pipeline"), "pipeline", "left_anti")
        if again:
            todo = _not_listed(todo, listed)
        for name, n in todo.select("pipeline", "listed").toLocalIterator():
            start(name, f"{batch_id}/{name}") if named else start(name)
            local_table(spark, record, [(name, n)]).coalesce(1).write.mode("append").parquet(started)
        waiting.unionByName(wanted).coalesce(1).write.mode("overwrite").parquet(f"{base}_open/{batch_id}")
        delete_path(spark, f"{base}_open/{batch_id - 2}")

    return (
        monitored.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
