"""Rows that are dear to derive are derived once, and by narrow joins first."""

import numpy as np
import pyarrow as pa
import pytest

from ctrflow.operators import statistics as st
from ctrflow.operators import workflow as wf
from ctrflow.plans import catalog, fixtures
from ctrflow.streaming.requestlog import RequestLog

SF = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


@pytest.mark.parametrize(
    "name, owner, attr, at",
    [
        ("feature_stats", st, "feature_stats", 0),
        ("load_stats", "ctrflow.plans.files", "feature_stats", 0),
        ("sink_stats", "ctrflow.plans.files", "feature_stats", 0),
        ("drift_js_saved", st, "feature_stats", 0),
        ("stats_numeric", st, "stats_numeric", 0),
        ("stats_quantile_histogram", st, "quantiles", 0),
        ("stats_merge_days", "ctrflow.operators.dailystats", "daily_records", 0),
        ("split_features_label", "ctrflow.operators.columns", "split_features_label", 0),
        ("join_vocab", wf.FittedWorkflow, "transform", 1),
        ("workflow_transform_new", wf.FittedWorkflow, "transform", 1),
        ("categorify_transform", wf.FittedWorkflow, "transform", 1),
        ("sink_features", wf.FittedWorkflow, "transform", 1),
    ],
)
def test_rows_read_several_times_are_written_down(spark, monkeypatch, name, owner, attr, at):
    seen = []

    def look(*args, **kwargs):
        seen.extend(args[at].inputFiles())
        raise Seen

    monkeypatch.setattr(f"{owner}.{attr}" if isinstance(owner, str) else owner, *([] if isinstance(owner, str) else [attr]), look)
    with pytest.raises(Seen):
        catalog.QUERIES[name](spark, SF)
    assert seen and not [f for f in seen if "lineitem" in f or "day=" in f]


def test_stream_transform_fits_on_the_rows_that_arrive(spark, monkeypatch):
    seen = []

    def look(self, train):
        seen.extend(train.inputFiles())
        raise Seen

    monkeypatch.setattr(wf.Workflow, "fit", look)
    with pytest.raises(Seen):
        catalog.QUERIES["stream_transform"](spark, SF)
    assert seen and all("arriving" in f for f in seen)


def test_orders_meet_customers_before_the_line_items(spark, capsys):
    fixtures.clicks(spark, SF).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    depth = {
        key: min(line.index("Join") for line in plan.splitlines() if "Join" in line and key in line)
        for key in ("o_custkey", "l_orderkey")
    }
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_numbers_are_counted_by_bin_and_region(spark):
    values = [None, float("nan"), float("-inf"), float("inf"), -0.0, 0.0, 1.0, 1.5, 2.0, 2.0, 9.0, 10.0, 11.0, -3.0]
    sides = ["a", "b"] * 7
    df = spark.createDataFrame(pa.table({"side": sides, "x": pa.array(values, pa.float64())}))
    spans = [(float("-inf"), -3.0), (0.0, 0.0), (1.0, 2.0), (11.0, float("inf"))]
    limits = {("a", "x"): (0.0, 10.0, spans), ("b", "x"): (1.0, 1.0, spans)}
    got = {}
    for r in st._number_cells(df, limits, 10, "side").collect():
        got[r.side, r.bin, r.region, r.value] = got.get((r.side, r.bin, r.region, r.value), 0) + r["count"]
    want = {}
    for side, v in zip(sides, values):
        if v is None or np.isnan(v):
            continue
        low, high, _ = limits[side, "x"]
        b = 0 if high <= low or v <= low else 9 if v >= high else int(v - low)
        region = sum(int(v >= a) + int(v > e) for a, e in spans)
        for key in ((side, b, None, None), (side, None, region, v + 0.0 if region % 2 else None)):
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_a_batch_that_is_enough_is_written_once(spark, tmp):
    from datetime import timedelta

    from ctrflow.scratch import exists

    log = RequestLog(spark, f"{tmp}/log", 5, timedelta(0))
    log.batch(spark.range(10), 0)
    assert not exists(spark, f"{tmp}/log/pending/batch_id=0")
    log.batch(spark.range(10, 13), 1)
    assert exists(spark, f"{tmp}/log/pending/batch_id=1")
    log.batch(spark.range(20, 30), 2)
    # as if a flush of the next batch had been cut short, and the clock then set back
    spark.range(90, 99).write.parquet(f"{tmp}/log/log/batch_id=3/old.parquet")
    log.min_gap = timedelta(days=1)
    log.batch(spark.range(30, 40), 3)
    assert sorted(r.id for r in log.read().collect()) == [*range(13), *range(20, 30)]
    assert log.close(spark.range(1).schema)
    assert sorted(r.id for r in log.read().collect()) == [*range(13), *range(20, 40)]
