import os
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from naive import monitor
from pyspark.sql import functions as F

from ctrflow.functions.auc import rolling_auc
from ctrflow.functions.liveauc import WindowAuc
from ctrflow.operators import series
from ctrflow.operators.transforms import Categorify, FillMissing, Normalize
from ctrflow.operators.workflow import Workflow
from ctrflow.streaming import events as ev
from ctrflow.streaming import monitor as mon
from ctrflow.streaming.requestlog import RequestLog, log_requests
from ctrflow.streaming.windows import live_increase, window_deltas

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCORED = "model_key string, ts timestamp, event_id bigint, trueval double, predval double, accepts boolean"


def in_order(path, pieces):
    """Write frames as one file each, with rising modification times."""
    for i, df in enumerate(pieces):
        df.coalesce(1).write.mode("append").parquet(path)
    local = path[len("file:"):]
    files = [os.path.join(local, f) for f in os.listdir(local) if f.endswith(".parquet")]
    files.sort(key=os.path.getmtime)
    for i, f in enumerate(files):
        os.utime(f, (1_700_000_000 + 10 * i,) * 2)


def play(stream, spark, tmp, name="out"):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/{name}-ckpt")
        .trigger(availableNow=True).start(f"{tmp}/{name}")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{tmp}/{name}"), query


def scores(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = float(rng.random() < 0.4)
        good = i % 300 < 150  # the model goes bad again and again
        p = 0.3 + 0.4 * y * (1 if good else -1) + 0.3 * rng.random()
        rows.append((rng.choice(["m1", "m2"]), START + timedelta(seconds=i), i, y, round(p, 2), rng.random() < 0.7))
    return rows


@pytest.mark.parametrize(
    "reset, cooldown", [(True, 0), (True, 60), (False, 0)]
)
def test_monitor_matches_the_loop(spark, tmp, reset, cooldown):
    rows = scores(3)
    cfg = mon.MonitorConfig(n=40, threshold=0.6, frac=0.5, reset=reset, cooldown=cooldown)
    pieces = [spark.createDataFrame(rows[i : i + 300], SCORED) for i in range(0, 900, 300)]
    in_order(f"{tmp}/in", pieces)
    stream = spark.readStream.schema(pieces[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    out, query = play(mon.monitor_stream(stream, cfg), spark, tmp)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 900
    got = {r.event_id: r for r in out.collect()}
    # the last row is of second 899, so the minute it is in has not passed
    assert sorted(got) == list(range(840))
    accepted = 0
    for model in ("m1", "m2"):
        mine = [r for r in rows if r[0] == model]
        want = monitor(
            [(r[3], r[4]) for r in mine], 40, 0.6, 0.5, [r[5] for r in mine], cooldown, reset
        )
        for r, (auc, size, alert, ok) in zip(mine, want):
            if r[2] not in got:
                continue
            g = got[r[2]]
            assert (g.in_window, g.alert, g.accepted) == (size, alert, ok)
            assert g.rolling_auc == pytest.approx(auc, abs=1e-12)
            accepted += ok
    assert accepted > 2


def test_acceptance_comes_from_the_runs(spark):
    events = spark.createDataFrame([("busy",), ("idle",), ("new",)], "pipeline string")
    table = spark.createDataFrame([("busy", "Running"), ("idle", "Failed")], "pipeline string, status string")
    got = {r.pipeline: r.accepts for r in mon.mark_accepting(events, table, "pipeline").collect()}
    assert got == {"busy": False, "idle": True, "new": False}


def test_alerts_start_one_run_per_pipeline(spark, tmp):
    alerts = spark.createDataFrame(
        [(1, "idle", True), (2, "idle", True), (3, "busy", True), (4, "idle", False)],
        "id int, pipeline string, accepted boolean",
    )
    alerts.write.parquet(f"{tmp}/alerts")
    table = spark.createDataFrame([("busy", "Running"), ("idle", "Failed")], "pipeline string, status string")
    started = []
    mon.act_on_alerts(
        spark.readStream.schema(alerts.schema).parquet(f"{tmp}/alerts"),
        lambda: table, f"{tmp}/stored", f"{tmp}/ckpt", started.append,
    ).awaitTermination()
    assert started == ["idle"]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/stored").collect()) == [1, 2]


class Clock:
    def __init__(self):
        self.at = START

    def __call__(self):
        return self.at


def test_request_log_needs_rows_and_time(spark, tmp):
    clock = Clock()
    log = RequestLog(spark, f"{tmp}/log", 320, timedelta(seconds=60), clock)

    def arrive(batch, n):
        log.batch(spark.range(batch * 1000, batch * 1000 + n), batch)
        flushed = log.flushes()
        return flushed[-1][0] if flushed else None

    def names():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp}/log/log")
        return sorted({r.path.split("/")[-2] for r in files.select("path").collect()})

    assert arrive(0, 319) is None
    assert arrive(1, 1) == 1  # enough rows, and nothing written before
    clock.at += timedelta(seconds=59)
    assert arrive(2, 400) == 1  # too soon
    clock.at += timedelta(seconds=1)
    assert arrive(3, 1) == 3
    clock.at += timedelta(seconds=100)
    assert arrive(4, 10) == 3  # too few
    assert log.read().count() == 721
    log.batch(spark.range(4000, 4010), 4)  # a batch that is played again
    assert log.read().count() == 721
    assert names() == ["01_01_2024-00-00-00.parquet", "01_01_2024-00-01-00.parquet"]
    assert log.close(spark.range(1).schema) and not log.close(spark.range(1).schema)
    assert log.read().count() == 731 == log.read().distinct().count()
    left = os.listdir(f"{tmp[len('file:'):]}/log/pending")
    assert sorted(left) == ["batch_id=4"]


def test_a_flush_that_was_cut_short_is_done_over(spark, tmp):
    clock = Clock()
    log = RequestLog(spark, f"{tmp}/log", 5, timedelta(0), clock)
    log.batch(spark.range(10), 0)
    # as if the record of the flush had not been written before the failure
    from ctrflow.scratch import delete_path

    delete_path(spark, f"{tmp}/log/state")
    clock.at += timedelta(seconds=3)
    log.batch(spark.range(10), 0)
    assert sorted(r.id for r in log.read().collect()) == list(range(10))


def test_request_log_on_a_stream(spark, tmp):
    df = spark.range(1000, numPartitions=5)
    df.write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    query, log = log_requests(stream, f"{tmp}/log", f"{tmp}/ckpt", 300, timedelta(0), availableNow=True)
    query.awaitTermination()
    log.close(df.schema)
    assert sorted(r.id for r in log.read().collect()) == list(range(1000))


def test_drain_copies_each_row_once(spark, tmp):
    df = spark.range(90, numPartitions=3)
    df.write.parquet(f"{tmp}/src")
    ev.drain(spark, f"{tmp}/src", f"{tmp}/dst", f"{tmp}/ckpt", df.schema, max_files=1).awaitTermination()
    assert sorted(r.id for r in ev.read_drained(spark, f"{tmp}/dst", df.schema).collect()) == list(range(90))
    assert not [f for f in os.listdir(tmp[len("file:"):] + "/src") if f.endswith(".parquet")]


def test_drain_moves_files_without_rows_and_with_odd_names(spark, tmp):
    df = spark.range(40, numPartitions=2)
    df.write.parquet(f"{tmp}/src")
    df.where("id < 0").write.mode("append").parquet(f"{tmp}/src")  # one file without rows
    local = tmp[len("file:"):] + "/src"
    first = sorted(f for f in os.listdir(local) if f.endswith(".parquet"))[0]
    os.replace(f"{local}/{first}", f"{local}/odd [a] 100%25 {{b}}.parquet")
    assert len([f for f in os.listdir(local) if f.endswith(".parquet")]) == 3
    ev.drain(spark, f"{tmp}/src", f"{tmp}/dst", f"{tmp}/ckpt", df.schema, max_files=1).awaitTermination()
    assert sorted(r.id for r in ev.read_drained(spark, f"{tmp}/dst", df.schema).collect()) == list(range(40))
    assert not [f for f in os.listdir(local) if f.endswith(".parquet")]


@pytest.mark.parametrize("fails_at", [1, 2, 4])
def test_drain_goes_on_after_a_failure_between_copy_and_delete(spark, tmp, fails_at):
    from ctrflow.scratch import delete_path

    df = spark.range(120, numPartitions=6)
    df.write.parquet(f"{tmp}/src with blank")
    calls = []

    def failing(spark, path):
        calls.append(path)
        if len(calls) == fails_at:
            raise OSError("the store does not answer")
        delete_path(spark, path)

    def go(delete):
        return ev.drain(spark, f"{tmp}/src with blank", f"{tmp}/dst", f"{tmp}/ckpt", df.schema, max_files=3, delete=delete)

    with pytest.raises(Exception, match="does not answer"):
        go(failing).awaitTermination()
    go(delete_path).awaitTermination()
    assert sorted(r.id for r in ev.read_drained(spark, f"{tmp}/dst", df.schema).collect()) == list(range(120))
    assert not [f for f in os.listdir(tmp[len("file:"):] + "/src with blank") if f.endswith(".parquet")]


def test_listening_ends_after_its_time(spark, tmp):
    spark.range(5).write.parquet(f"{tmp}/src")
    query = ev.drain(spark, f"{tmp}/src", f"{tmp}/dst", f"{tmp}/ckpt", spark.range(1).schema, interval="1 second")
    assert ev.listen(query, 4) is False and not query.isActive


def test_intake_is_bounded(spark, tmp):
    rows = spark.createDataFrame([(i, "m", START, '{"predval":0.5}') for i in range(40)], ev.MESSAGE).repartition(4)
    rows.write.json(f"{tmp}/in")
    stream = ev.read_events(spark, f"{tmp}/in", max_files=1)
    out, query = play(stream.select("event_id", "predval"), spark, tmp)
    assert out.where("predval = 0.5").count() == 40
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) >= 2 and max(batches) < 40


def test_published_events_can_be_read_back(spark, tmp):
    rows = spark.createDataFrame([(i, "m", START, '{"trueval":1}') for i in range(6)], ev.MESSAGE)
    rows.write.json(f"{tmp}/in")
    ev.publish(ev.read_messages(spark, f"{tmp}/in"), f"{tmp}/topic", f"{tmp}/ckpt").awaitTermination()
    out, _ = play(ev.read_events(spark, f"{tmp}/topic").select("event_id", "trueval"), spark, tmp)
    assert sorted(out.collect()) == [(i, 1.0) for i in range(6)]


@pytest.mark.parametrize("column_bytes", [1 << 20, 0])
def test_stream_transform_equals_batch(spark, tmp, column_bytes):
    df = spark.createDataFrame([(i, f"c{i % 7}", float(i)) for i in range(200)], "id int, c string, x double").repartition(4)
    fitted = Workflow((["c"] >> Categorify()) + (["x"] >> FillMissing() >> Normalize())).fit(df.where("id < 100"))
    fitted.limits = type(fitted.limits)(column_bytes=column_bytes)
    df.write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp}/in")
    ev.transform_stream(stream, fitted, f"{tmp}/out", f"{tmp}/ckpt", ["id"]).awaitTermination()
    assert sorted(ev.read_transformed(spark, f"{tmp}/out").collect()) == sorted(fitted.transform(df, ["id"]).collect())


def test_live_windows_equal_batch_windows(spark, tmp):
    rng = random.Random(1)
    rows, t, v = [], 0, 0
    for _ in range(600):
        t += rng.choice([1, 5, 10])
        v += rng.randrange(9)
        rows.append((rng.choice("ab"), START + timedelta(seconds=t), v))
    pieces = [spark.createDataFrame(rows[i : i + 200], "pod string, ts timestamp, value bigint") for i in (0, 200, 400)]
    in_order(f"{tmp}/in", pieces)
    stream = spark.readStream.schema(pieces[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    live, query = play(window_deltas(stream, ["pod"]), spark, tmp)
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 0
    whole = window_deltas(pieces[0].union(pieces[1]).union(pieces[2]), ["pod"])
    closed = whole.where(F.col("end") <= F.lit(rows[-1][1]) - F.expr("INTERVAL 1 MINUTE"))
    assert sorted(live.collect(), key=str) == sorted(closed.collect(), key=str) and live.count() > 300


def test_live_auc_equals_pair_counts():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 700).astype(float)
    p = rng.integers(0, 12, 700) / 10
    y[rng.integers(0, 700, 5)] = np.nan
    p[300] = np.nan
    for n in (1, 2, 30, 1000):
        want, size = rolling_auc(y, p, n)
        live = WindowAuc(n)
        for i in range(700):
            live.push(y[i], p[i])
            assert len(live) == size[i]
            assert (live.value is None) if np.isnan(want[i]) else live.value == want[i]
            if i % 50 == 7:  # taken down and up again
                live = WindowAuc(n, list(live.rows), live.twice)
    live.clear()
    assert live.value is None and len(live) == 0


def test_live_auc_costs_little_per_row():
    import time

    rng = np.random.default_rng(0)
    live = WindowAuc(20_000)
    began = time.perf_counter()
    for y, p in zip(rng.integers(0, 2, 60_000).tolist(), rng.random(60_000).tolist()):
        live.push(y, p)
    assert time.perf_counter() - began < 5 and 0.4 < live.value < 0.6


def shuffled_within(rows, seconds, seed):
    """Rows in the order of their arrival, each up to ``seconds`` after its time."""
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: (r[1] + timedelta(seconds=rng.uniform(0, seconds)), r[2]))


def test_monitor_puts_events_in_order(spark, tmp):
    rows = scores(8)
    late = ("m1", START, 5000, 1.0, 0.1, True)
    arriving = [*shuffled_within(rows, 59, 1), late]
    assert arriving[:900] != rows
    pieces = [spark.createDataFrame(arriving[i : i + 180], SCORED).coalesce(1) for i in range(0, 901, 180)]
    in_order(f"{tmp}/in", pieces)
    stream = spark.readStream.schema(pieces[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    cfg = mon.MonitorConfig(n=40, threshold=0.6, frac=0.5, reset=True, cooldown=10)
    out, query = play(mon.monitor_stream(stream, cfg, delay="1 minute", step="20 seconds"), spark, tmp)
    got = {r.event_id: r for r in out.collect()}
    # the watermark ends at second 839
    assert sorted(got) == list(range(820))
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    accepted = 0
    for model in ("m1", "m2"):
        mine = [r for r in rows if r[0] == model]
        want = monitor([(r[3], r[4]) for r in mine], 40, 0.6, 0.5, [r[5] for r in mine], 10, True)
        for r, (auc, size, alert, ok) in zip(mine, want):
            if r[2] in got:
                g = got[r[2]]
                assert (g.ts.replace(tzinfo=timezone.utc), g.in_window, g.alert, g.accepted) == (r[1], size, alert, ok)
                assert g.rolling_auc == pytest.approx(auc, abs=1e-12)
                accepted += ok
    assert accepted > 2


def test_windows_of_many_pieces(spark, tmp, monkeypatch):
    """A window that spans several entries of the state, over several batches."""
    rows = scores(4, 2400)
    pieces = [spark.createDataFrame(rows[i : i + 600], SCORED) for i in range(0, 2400, 600)]
    in_order(f"{tmp}/in", pieces)
    stream = spark.readStream.schema(pieces[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    cfg = mon.MonitorConfig(n=700, threshold=0.55, frac=0.5, reset=True)
    out, _ = play(mon.monitor_stream(stream, cfg), spark, tmp)
    got = {r.event_id: r for r in out.collect()}
    assert sorted(got) == list(range(2340))
    for model in ("m1", "m2"):
        mine = [r for r in rows if r[0] == model]
        want = monitor([(r[3], r[4]) for r in mine], 700, 0.55, 0.5, [r[5] for r in mine], 0, True)
        for r, (auc, size, alert, ok) in zip(mine, want):
            if r[2] in got:
                g = got[r[2]]
                assert (g.in_window, g.alert, g.accepted) == (size, alert, ok) and g.rolling_auc == pytest.approx(auc, abs=1e-12)


def test_rolling_stream_in_blocks(spark, tmp):
    rows = scores(6)
    rows = [r if r[2] < 600 or r[0] == "m1" else ("m3", *r[1:]) for r in rows]  # m2 falls silent, m3 begins
    pieces = [spark.createDataFrame(rows[i : i + 300], SCORED) for i in range(0, 900, 300)]
    in_order(f"{tmp}/in", pieces)

    def go(checkpoint):
        stream = spark.readStream.schema(pieces[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
        mon.rolling_auc_stream(stream, f"{tmp}/out", f"{tmp}/{checkpoint}", n=40, block=64).awaitTermination()
        return {r.event_id: r for r in mon.read_rolling(spark, f"{tmp}/out").collect()}

    got = go("ckpt")
    assert sorted(got) == list(range(900))
    for model in ("m1", "m2", "m3"):
        mine = [r for r in rows if r[0] == model]
        for r, (auc, size, _, _) in zip(mine, monitor([(r[3], r[4]) for r in mine], 40, 0.0, 0.5, reset=False)):
            assert got[r[2]].in_window == size and got[r[2]].rolling_auc == pytest.approx(auc, abs=1e-12)
    # all batches played again
    assert {k: tuple(v) for k, v in go("again").items()} == {k: tuple(v) for k, v in got.items()}


COUNTER = "pod string, ts timestamp, value bigint"


def test_live_increase_equals_the_table(spark, tmp):
    """Out of order, with resets, and with a series that falls silent before the others."""
    rng = random.Random(2)
    rows, at, value = [], dict.fromkeys("abc", 0), dict.fromkeys("abc", 5)
    for i in range(900):
        pod = rng.choice("ab" if i > 300 else "abc")
        at[pod] = max(at[pod], i) + 1
        value[pod] = 0 if rng.random() < 0.02 else value[pod] + rng.randrange(9)
        rows.append((pod, START + timedelta(seconds=at[pod], microseconds=rng.randrange(1000)), value[pod]))
    arriving = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.uniform(0, 19)))
    arriving.insert(500, ("a", START + timedelta(seconds=490, microseconds=999_999), None))
    pieces = [spark.createDataFrame(arriving[i : i + 226], COUNTER) for i in range(0, 901, 226)]
    in_order(f"{tmp}/in", pieces)
    stream = spark.readStream.schema(pieces[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    live, query = play(live_increase(stream, ["pod"], "60 seconds", "15 seconds", "20 seconds", "10 seconds"), spark, tmp)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 0
    whole = spark.createDataFrame(rows, COUNTER)
    passed = max(r[1] for r in rows) - timedelta(seconds=20)
    end = int(passed.timestamp()) // 10 * 10
    want = {
        (r.pod, r["at"]): r.increase
        for r in series.increase(whole, ["pod"], 60, ["pod"], 15).collect() if r["at"] // 10 * 10 + 10 <= end
    }
    got = {(r.pod, r.s): r for r in live.select("*", F.unix_seconds("at").alias("s")).collect()}
    assert {k: r.increase for k, r in got.items()} == want and len(want) > 120
    assert sum(k[0] == "c" for k in got) > 20
    for (pod, s), r in got.items():
        inside = [v for q, t, v in sorted(rows, key=lambda x: x[1]) if q == pod and s - 60 <= t.timestamp() <= s]
        assert r.samples == len(inside) and r.rate == pytest.approx(r.increase / 60)
        assert r.delta == (inside[-1] - inside[0] if len(inside) > 1 else None)


def test_a_batch_played_again_keeps_its_decision(spark, tmp):
    """The second time the started run is already listed as running."""
    schema = "id int, pipeline string, accepted boolean"
    spark.createDataFrame([(1, "idle", True)], schema).write.parquet(f"{tmp}/alerts")
    status, started = ["Failed"], []

    def runs():
        rows = [("idle", s) for s in status]
        return spark.createDataFrame(rows, "pipeline string, status string")

    def start(name):
        started.append(name)
        status.append("Running")

    def play(checkpoint):
        mon.act_on_alerts(
            spark.readStream.schema(schema).parquet(f"{tmp}/alerts"), runs, f"{tmp}/stored", f"{tmp}/{checkpoint}", start
        ).awaitTermination()

    play("first")
    play("second")  # a new checkpoint plays batch 0 once more
    assert started == ["idle"]
    assert [r.id for r in spark.read.parquet(f"{tmp}/stored").collect()] == [1]


def test_a_run_that_is_not_listed_yet_is_not_started_twice(spark, tmp):
    schema = "id int, pipeline string, accepted boolean"
    for i in range(2):
        spark.createDataFrame([(i, "idle", True)], schema).coalesce(1).write.mode("append").parquet(f"{tmp}/alerts")
    table = spark.createDataFrame([("idle", "Failed")], "pipeline string, status string")
    started = []
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/alerts")
    mon.act_on_alerts(stream, lambda: table, f"{tmp}/stored", f"{tmp}/ckpt", started.append).awaitTermination()
    assert started == ["idle"]


ALERT = "id int, pipeline string, accepted boolean"


@pytest.mark.parametrize("listed_before_failure", [False, True])
def test_a_failure_around_a_start_starts_each_pipeline_once(spark, tmp, listed_before_failure):
    """The job service fails before it has taken the request, or answers with a failure after it has listed the run."""
    spark.createDataFrame([(1, "p", True), (2, "q", True)], ALERT).coalesce(1).write.parquet(f"{tmp}/alerts")
    listed, requests = {"p": ["Failed"], "q": ["Failed"]}, []

    def runs():
        return spark.createDataFrame([(k, v) for k, some in listed.items() for v in some], "pipeline string, status string")

    def start(name, request):
        failing = not requests
        requests.append((name, request))
        if not failing or listed_before_failure:
            listed[name].append("Running")
        if failing:
            raise OSError("no answer")

    def play():
        stream = spark.readStream.schema(ALERT).parquet(f"{tmp}/alerts")
        mon.act_on_alerts(stream, runs, f"{tmp}/stored", f"{tmp}/ckpt", start).awaitTermination()

    with pytest.raises(Exception, match="no answer"):
        play()
    play()
    assert listed == {"p": ["Failed", "Running"], "q": ["Failed", "Running"]}
    # a request that is made again has the same id
    assert len(requests) == (2 if listed_before_failure else 3) and len(set(requests)) == 2
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/stored").collect()) == [1, 2]


def test_a_pipeline_may_start_again_once_its_run_is_listed(spark, tmp):
    for i in range(4):
        spark.createDataFrame([(i, "p", True)], ALERT).coalesce(1).write.mode("append").parquet(f"{tmp}/alerts")
    listed, started = ["Failed"], []

    def start(name):
        started.append(name)

    def runs():
        # the run of the first start is listed, and over, from the third batch on
        asked.append(1)
        some = listed + (["Succeeded"] if started and len(seen()) >= 2 else [])
        return spark.createDataFrame([("p", s) for s in some], "pipeline string, status string")

    asked = []

    def seen():
        folder = f"{tmp[len('file:'):]}/stored_open"
        return os.listdir(folder) if os.path.isdir(folder) else []

    stream = spark.readStream.schema(ALERT).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/alerts")
    mon.act_on_alerts(stream, runs, f"{tmp}/stored", f"{tmp}/ckpt", start).awaitTermination()
    assert started == ["p", "p"] and asked


def test_batches_of_a_feed_do_not_follow_the_partitions(spark):
    from ctrflow.plans.streams import feed

    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        stream = feed(spark, spark.range(5000), ["id"], 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    sizes = []
    query = stream.writeStream.foreachBatch(lambda df, n: sizes.append(df.agg(F.count("id"), F.max("id")).first()))
    query.trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 8 and sum(n for n, _ in sizes) == 5000
    assert [top for _, top in sizes] == sorted(top for _, top in sizes)


def test_every_window_of_the_live_series_is_closed(spark):
    from ctrflow.plans.fixtures import series as live_series
    from ctrflow.plans.streams import stream_metric_window

    sf = "/root/testdata/sf0.001"
    rows = live_series(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    want = window_deltas(rows, ["metric", "instance"], "6 hours", "2 hours", "1 day").count()
    assert stream_metric_window(spark, sf).count() == want
