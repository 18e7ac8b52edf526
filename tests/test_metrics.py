import math
import random

import numpy as np
import pytest
from naive import auc as naive_auc
from naive import monitor
from pyspark.sql import functions as F

from ctrflow.functions.auc import rolling_auc as rolling
from ctrflow.operators import metrics


def sample(n, seed, ties=True):
    rng = random.Random(seed)
    return [
        (i, float(rng.random() < 0.3), round(rng.random(), 1 if ties else 9)) for i in range(n)
    ]


def one(df):
    return df.first().auc


@pytest.mark.parametrize("ties", [True, False])
def test_roc_auc(spark, ties):
    rows = sample(500, 3, ties)
    df = spark.createDataFrame(rows, "id int, y double, p double").repartition(5)
    want = naive_auc([r[1] for r in rows], [r[2] for r in rows])
    assert one(metrics.roc_auc(df, "y", "p")) == pytest.approx(want, abs=1e-12)
    # unchanged by an increasing map of the scores, mirrored by a decreasing one
    moved = df.withColumn("p", F.exp(F.col("p") * 3))
    assert one(metrics.roc_auc(moved, "y", "p")) == pytest.approx(want, abs=1e-12)
    turned = df.withColumn("p", 1 - F.col("p"))
    assert one(metrics.roc_auc(turned, "y", "p")) == pytest.approx(1 - want, abs=1e-12)


def test_roc_auc_with_one_class_or_no_rows(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "y double, p double")
    assert metrics.roc_auc(df, "y", "p").first() == (None, 2, 0)
    assert metrics.roc_auc(df.where("p > 1"), "y", "p").first() == (None, 0, 0)


def test_roc_auc_of_zero_scores_of_either_sign(spark):
    df = spark.createDataFrame([(1.0, -0.0), (0.0, 0.0)], "y double, p double")
    assert one(metrics.roc_auc(df, "y", "p")) == 0.5


@pytest.mark.parametrize("n", [1, 2, 7, 50, 400])
def test_rolling_in_numpy(n):
    rows = sample(200, n)
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    segment = np.repeat([0, 1, 2], [90, 1, 109])
    got, size = rolling(y, p, n, segment)
    for i in range(len(rows)):
        first = max(i - n + 1, int(np.flatnonzero(segment == segment[i])[0]))
        want = naive_auc(y[first : i + 1], p[first : i + 1])
        assert size[i] == i - first + 1
        assert math.isnan(got[i]) if want is None else got[i] == pytest.approx(want, abs=1e-12)


def test_rolling_is_undefined_while_a_missing_score_is_in_the_window():
    got, _ = rolling([1, 0, 1, 0, 1, 0], [0.9, 0.1, float("nan"), 0.2, 0.8, 0.3], 3)
    assert [math.isnan(x) for x in got] == [True, False, True, True, True, False]


@pytest.mark.parametrize("block", [60, 1000])
@pytest.mark.parametrize("key", [[], ["k"]])
def test_rolling_auc_over_blocks(spark, block, key):
    rng = random.Random(5)
    rows = [(i, rng.choice("aaaab"), y, p) for i, y, p in sample(700, 9)]
    df = spark.createDataFrame(rows, "id int, k string, y double, p double").repartition(6)
    got = metrics.rolling_auc(df, ["id"], "y", "p", 40, key, block=block, unique=True)
    groups = {}
    for r in rows:
        groups.setdefault(r[1] if key else "", []).append(r)
    want = {}
    for members in groups.values():
        for i, r in enumerate(members):
            window = members[max(0, i - 39) : i + 1]
            want[r[0]] = (naive_auc([w[2] for w in window], [w[3] for w in window]), len(window))
    seen = {r.id: (r.rolling_auc, r.in_window) for r in got.collect()}
    assert len(seen) == len(rows)
    for i, (a, size) in want.items():
        assert seen[i][1] == size
        assert seen[i][0] is None if a is None else seen[i][0] == pytest.approx(a, abs=1e-12)


def test_alerts_without_reset_match_the_loop(spark):
    rows = sample(600, 21)
    df = spark.createDataFrame(rows, "id int, y double, p double").repartition(4)
    held = metrics.carry_last_valid(
        metrics.rolling_auc(df, ["id"], "y", "p", 50, unique=True), ["id"], unique=True
    )
    alerts = metrics.threshold_alerts(held, 50, 0.5, 0.5)
    want = monitor([(y, p) for _, y, p in rows], 50, 0.5, 0.5, reset=False)
    assert {r.id for r in alerts.collect()} == {i for i, w in enumerate(want) if w[2]}
    got = {r.id: r.rolling_auc for r in held.collect()}
    assert all(got[i] == pytest.approx(w[0], abs=1e-12) for i, w in enumerate(want))


@pytest.mark.parametrize("key", [[], ["k"], ["k", "m"]])
def test_held_in_blocks_equals_carried(spark, key):
    """Keys that end inside a block, span several, have no AUC at first or none at all, and a null key."""
    rng = random.Random(4)
    rows = []
    for i in range(700):
        k = rng.choice(["a", "a", "a", "b", None, "c"])
        y = {"c": 1.0, "b": float(i > 400 and rng.random() < 0.3)}.get(k, float(rng.random() < 0.05))
        rows.append((i, k, i % 2 if k == "a" else 0, y, rng.random(), None))
    df = spark.createDataFrame(rows, "id int, k string, m int, y double, p double, known double").repartition(4)
    raw = metrics.rolling_auc(df, ["id"], "y", "p", 9, key, block=16, unique=True)
    want = metrics.carry_last_valid(raw, ["id"], key, unique=True)
    got = metrics.rolling_auc_held(df, ["id"], "y", "p", 9, key, block=16, unique=True)
    assert sorted((r.id, r.rolling_auc, r.in_window) for r in got.collect()) == sorted(
        (r.id, r.rolling_auc, r.in_window) for r in want.collect()
    )
    known = df.withColumn("known", F.when(F.col("id") % 97 == 0, 0.25))
    got = metrics.rolling_auc_held(known, ["id"], "y", "p", 9, key, block=16, unique=True, known="known")
    assert {r.rolling_auc for r in got.where("id % 97 = 0").collect()} == {0.25}


def test_a_missing_label_is_no_class(spark):
    rows = [(1.0, 0.9), (0.0, 0.1), (float("nan"), 0.5), (None, 0.4)]
    got = metrics.roc_auc(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert (got.auc, got.n_pos, got.n_neg) == (1.0, 1, 1)


def test_carried_columns_come_back_as_they_are(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(i, i % 2, i / 10, big if i else None) for i in range(6)], "t int, y int, p double, id bigint")
    got = metrics.rolling_auc(df, ["t"], "y", "p", n=3)
    assert sorted(r.id for r in got.collect() if r.id) == [big] * 5
