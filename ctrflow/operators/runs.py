"""Retrain runs: which alerts may start one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUNNING = "Running"


def filter_runs(runs: DataFrame, pipeline: str) -> DataFrame:
    """Runs of one pipeline."""
    return runs.where(F.col("pipeline") == pipeline)


def latest_run(runs: DataFrame) -> DataFrame:
    """The run of each pipeline that was listed last: its ids are reused by a retrain."""
    cols = ["listed_at", "run_id", "experiment", "status"]
    return (
        runs.groupBy("pipeline")
        .agg(F.max(F.struct(*cols)).alias("r"))
        .select("pipeline", *[F.col("r." + c) for c in cols])
    )


def run_state(runs: DataFrame) -> DataFrame:
    """One row per pipeline that ever ran, and whether a run is going on.

    Runs are reduced per pipeline before any join, so a pipeline with very many runs
    does not weigh on one join task.
    """
    return runs.groupBy("pipeline").agg(
        F.max(F.when(F.col("status") == RUNNING, 1).otherwise(0)).alias("running")
    )


def suppress_while_running(alerts: DataFrame, runs: DataFrame) -> DataFrame:
    """Alerts of pipelines that have run before and are not running now."""
    state = run_state(runs)
    idle = state.where("running = 0").select("pipeline")
    return alerts.join(idle, "pipeline", "left_semi")


def alerts_of_known(alerts: DataFrame, runs: DataFrame) -> DataFrame:
    """Semi join: alerts whose pipeline has ever run."""
    return alerts.join(run_state(runs).select("pipeline"), "pipeline", "left_semi")


def alerts_not_running(alerts: DataFrame, runs: DataFrame) -> DataFrame:
    """Anti join: alerts whose pipeline is not running now."""
    busy = run_state(runs).where("running = 1").select("pipeline")
    return alerts.join(busy, "pipeline", "left_anti")
