import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from naive import counter
from pyspark.sql import functions as F

from ctrflow.operators import series as s

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
FRAME = 600


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(12)
    out = {}
    for name, steps in (("a", 400), ("b", 60), ("lonely", 1)):
        t, v, rows = 0, 0, []
        for _ in range(steps):
            # bursts, and gaps of more than one slab
            t += rng.choice([10, 30, 600, 601, 4000])
            v = rng.randrange(5) if rng.random() < 0.1 else v + rng.randrange(20)
            rows.append((t, v))
        out[name] = rows
    return out


@pytest.fixture(scope="module")
def frame(spark, samples):
    rows = [
        ("m", name, START + timedelta(seconds=t), v) for name, ts in samples.items() for t, v in ts
    ]
    return spark.createDataFrame(rows, "metric string, instance string, ts timestamp, value bigint").repartition(5)


@pytest.mark.parametrize("slab", [FRAME, 1000, 86_400])
def test_windows_do_not_depend_on_slabs(frame, samples, slab):
    key = ["metric", "instance"]
    stepped = {(r.instance, r.ts): r.step for r in s.steps(frame, key, slab).collect()}
    grown = {(r.instance, r.ts): r.increase for r in s.increase_at(frame, key, FRAME, slab).collect()}
    moved = {(r.instance, r.ts): r.delta for r in s.delta_at(frame, key, FRAME, slab).collect()}
    assert len(stepped) == len(grown) == len(moved) == sum(map(len, samples.values()))
    zone = next(iter(stepped))[1].tzinfo
    for name, rows in samples.items():
        for t, step, increase, delta in counter(rows, FRAME):
            at = (START + timedelta(seconds=t)).replace(tzinfo=None) if zone is None else START + timedelta(seconds=t)
            k = (name, _local(at))
            assert stepped[k] == step and grown[k] == increase and moved[k] == delta


def _local(at):
    # collected timestamps are naive local times
    return at.replace(tzinfo=timezone.utc).astimezone().replace(tzinfo=None)


def test_full_slabs_are_made_shorter(frame, samples, monkeypatch):
    monkeypatch.setattr(s, "SLAB_ROWS", 10)
    assert s._slab_us(frame, ["instance"], FRAME, None) < 86_400 * s.SECOND
    got = {r.instance: r.total for r in s.increase_at(frame, ["metric", "instance"], FRAME).groupBy("instance").agg({"increase": "sum"}).withColumnRenamed("sum(increase)", "total").collect()}
    assert got == {name: sum(x[2] for x in counter(rows, FRAME)) for name, rows in samples.items()}


def test_a_frame_longer_than_a_slab_is_refused(frame):
    with pytest.raises(ValueError):
        s.increase_at(frame, ["instance"], FRAME, FRAME - 1)


def test_increase_on_a_grid(frame, samples):
    got = {(r.instance, r.at): r.increase for r in s.increase(frame, ["metric", "instance"], FRAME, ["instance"], 300).collect()}
    base = int(START.timestamp())
    want = {}
    for name, rows in samples.items():
        for t, step, _, _ in counter(rows, FRAME):
            first = -(-(base + t) // 300) * 300
            for at in range(first, base + t + FRAME + 1, 300):
                want[name, at] = want.get((name, at), 0) + step
    assert got == want


def test_rate_and_latest(frame, samples):
    rate = s.rate_at(frame, ["metric", "instance"], FRAME).where("instance = 'lonely'").first().rate
    assert rate == 0
    got = {r.instance: r.value for r in s.counter_latest(frame, ["instance"]).collect()}
    assert got == {k: rows[-1][1] for k, rows in samples.items()}


def test_cost_per_request(spark):
    def at(sec):
        return START + timedelta(seconds=sec)

    rows = [
        ("queue", "x", at(0), 0.0), ("queue", "x", at(10), 4000.0),
        ("done", "x", at(0), 0.0), ("done", "x", at(10), 1.0),
        ("queue", "y", at(10), 5.0), ("done", "y", at(10), 5.0),
    ]
    df = spark.createDataFrame(rows, "metric string, pod string, ts timestamp, value double")
    out = s.delta_ratio(df, ["pod"], 30, ["pod"], over="queue", per="done")
    assert [(r.pod, r.value) for r in out.collect()] == [("x", 2.0)]
    assert s.over_target(out, 0.2).count() == 1 and s.over_target(out, 2.0).count() == 0


def plain_extrapolated(rows, at, frame, counter):
    """The rule for one series and frame, in seconds."""
    inside = [(t, v) for t, v in rows if at - frame <= t <= at]
    if len(inside) < 2:
        return None
    (t0, v0), (t1, v1) = inside[0], inside[-1]
    change = v1 - v0
    if counter:
        change += sum(a for (_, a), (_, b) in zip(inside, inside[1:]) if b < a)
    covered = t1 - t0
    distance = covered / (len(inside) - 1)
    head, tail = t0 - (at - frame), at - t1
    head = distance / 2 if head >= 1.1 * distance else head
    if counter and change > 0 and v0 >= 0:
        head = min(head, covered * v0 / change)
    tail = distance / 2 if tail >= 1.1 * distance else tail
    return change * (covered + head + tail) / covered


@pytest.mark.parametrize("kind", ["increase", "rate", "delta"])
def test_extrapolated_changes(frame, samples, kind):
    got = {(r.instance, r["at"]): r.value for r in s.extrapolated(frame, ["metric", "instance"], FRAME, kind, 300, 1000).collect()}
    began = int(START.timestamp())
    want = {}
    for name, rows in samples.items():
        for at in range(began // 300 * 300, began + rows[-1][0] + FRAME + 1, 300):
            value = plain_extrapolated(rows, at - began, FRAME, kind != "delta")
            if value is not None:
                want[name, at] = value / FRAME if kind == "rate" else value
    assert got.keys() == want.keys() and len(want) > 200
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())
    total = s.increase(frame, ["metric", "instance"], FRAME, ["metric"], 300, extrapolate=True)
    if kind == "increase":
        sums = {r["at"]: r.increase for r in total.collect()}
        assert sum(sums.values()) == pytest.approx(sum(want.values()))


def test_unknown_kinds_of_change(frame):
    with pytest.raises(ValueError):
        s.extrapolated(frame, ["instance"], FRAME, "idelta")


def test_work_does_not_grow_with_the_samples_in_a_frame(spark):
    # every frame holds half of all samples: 40,000 x 20,000 of them one by one
    n, frame = 40_000, 20_000
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    df = spark.range(n).select(F.lit("m").alias("metric"), at.alias("ts"), (F.col("id") * 2).alias("value"))
    out = s.increase_at(df, ["metric"], frame)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"RangeFrame, -\d+, currentrow", plan), plan
    both = out.join(s.delta_at(df, ["metric"], frame).select("ts", "delta"), "ts")
    i = F.unix_seconds("ts") - 1_700_000_000
    want = F.when(i == 0, 0).otherwise(2 * F.least(i, F.lit(frame) + 1))
    moved = F.when(i > 0, 2 * F.least(i, F.lit(frame)))
    assert both.count() == n
    assert both.where(~F.col("increase").eqNullSafe(want) | ~F.col("delta").eqNullSafe(moved)).count() == 0


def test_a_frame_of_fractions_is_not_blurred_by_what_has_left_it(spark):
    # a counter that falls from a huge value, and one that is not a number for a while
    rows = [(0, 0.0), (10, 1e17), (1000, 0.25), (1010, 0.5), (2000, float("nan")), (3000, 1.0), (4000, 1.5)]
    rows = [("m", START + timedelta(seconds=t), v) for t, v in rows]
    df = spark.createDataFrame(rows, "metric string, ts timestamp, value double")
    got = [r.increase for r in s.increase_at(df, ["metric"], 300).orderBy("ts").collect()]
    assert got[:4] == [0.0, 1e17, 0.25, 0.5] and got[6] == 0.5
