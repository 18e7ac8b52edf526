"""Frequent values by mergeable summaries, in memory and shuffle that do not grow with the distinct values.

A summary holds at most ``size`` values of a column with a lower bound of their counts, and what it has taken off:
when it is over full, the count of the (size + 1)-th value is taken off all of them, and those without any
left go (Misra and Gries). No count is more than what was taken off too low, also after summaries are
merged, and at most one in ``size + 1`` of the rows is ever taken off.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.scratch import materialize

SUMMARY = "feature string, value string, count bigint"
#: Values per column that a summary holds.
SIZE = 10_000
#: Candidates that are broadcast; more are joined by shuffle.
CANDIDATES = 500_000


def _counted(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    found = pc.value_counts(values)
    return found.field("values"), found.field("counts").to_numpy()


class _Summary:
    def __init__(self, size: int):
        self.size, self.off = size, 0
        self.values, self.counts = pa.array([], pa.string()), np.zeros(0, np.int64)

    def add(self, values: pa.Array, counts: np.ndarray) -> None:
        table = pa.table({
            "v": pa.chunked_array([self.values, values]), "n": np.concatenate([self.counts, counts])
        }).group_by("v").aggregate([("n", "sum")])
        self.values, self.counts = table["v"].combine_chunks(), table["n_sum"].to_numpy()
        if len(self.counts) > self.size:
            cut = np.partition(self.counts, -self.size - 1)[-self.size - 1]
            left = self.counts > cut
            self.values, self.counts = self.values.filter(pa.array(left)), self.counts[left] - cut
            self.off += int(cut)


def _summarise(columns: list[str], size: int, by: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Summary] = {}
        for batch in batches:
            parts = [(None, batch)]
            if by:
                parts = [(v, batch.filter(pc.equal(batch.column(by), v))) for v in pc.unique(batch.column(by)).drop_null()]
            for part, rows in parts:
                for c in columns:
                    values = rows.column(c).drop_null()
                    key = (None if part is None else part.as_py(), c)
                    held.setdefault(key, _Summary(size)).add(*_counted(values))
        yield from _rows(held, by)

    return run


def _rows(held: dict[tuple, _Summary], by: str | None) -> Iterator[pa.RecordBatch]:
    for (part, c), s in held.items():
        n = len(s.counts)
        # what was taken off is the count of no value
        out = {
            "feature": pa.array([c] * (n + 1), pa.string()),
            "value": pa.concat_arrays([s.values, pa.array([None], pa.string())]),
            "count": pa.array(np.append(s.counts, s.off).astype(np.int64)),
        }
        if by:
            out = {by: pa.array([part] * (n + 1), pa.int64()), **out}
        yield pa.RecordBatch.from_pydict(out)


def summaries(df: DataFrame, columns: Sequence[str], size: int = SIZE, by: str | None = None) -> DataFrame:
    """``(feature, value, count)``: lower bounds of counts, and under the null value how much they may be too low.

    One row per task and held value leaves a task; sums of summaries are a summary. With ``by``, a whole number of few
    values such as a day, one summary for each of them, and that column in front. Rows without it take no part.
    """
    columns = list(columns)
    text = df.select(
        *([F.col(by).cast("bigint").alias(by)] if by else []), *[F.col(c).cast("string").alias(c) for c in columns]
    )
    out = text.mapInArrow(_summarise(columns, size, by), (f"{by} bigint, " if by else "") + SUMMARY)
    return merge(out, *([by] if by else []))


def merge(parts: DataFrame, *by: str) -> DataFrame:
    """Summaries of several parts of the rows as one, per ``by`` if given."""
    return parts.groupBy(*by, "feature", "value").agg(F.sum("count").alias("count"))


def frequent_values(df: DataFrame, columns: Sequence[str], share: float, size: int = SIZE) -> DataFrame:
    """``(feature, value, count)`` of all values with at least ``share`` of the rows, and perhaps a few with less.

    ``count`` is a lower bound. One scan; ``share`` must be above one in ``size``, and the result has at most
    ``2 / share`` values per column.
    """
    if share * size < 2:
        raise ValueError("a summary of this size cannot tell values of this share")
    found = materialize(summaries(df, columns, size), "summaries")
    off = found.where("value is null").select("feature", F.col("count").alias("__off"))
    rows = df.count()
    return found.where("value is not null").join(F.broadcast(off), "feature").where(
        F.col("count") + F.col("__off") >= share * rows
    ).drop("__off")


def top_values_in_two_scans(df: DataFrame, columns: Sequence[str], k: int = 20, size: int = SIZE) -> tuple[DataFrame, list[str]]:
    """The ``k`` most frequent values per column with exact counts and rank, ties by value; and columns left undecided.

    The first scan summarises, the second counts only values that may be among the first ``k``. Undecided
    is a column whose k-th lower bound does not exceed what a value without an entry may have.
    """
    found = materialize(summaries(df, columns, size), "summaries")
    off = {r.feature: r["count"] for r in found.where("value is null").collect()}
    held = found.where("value is not null")
    by_count = Window.partitionBy("feature").orderBy(F.desc("count"))
    kth = {
        r.feature: (r.n, r.low)
        for r in held.withColumn("at", F.row_number().over(by_count)).where(F.col("at") <= k)
        .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("low")).collect()
    }
    # a summary that never took off knows every value
    least = {c: (kth[c][1] if kth[c][0] == k else 0) - off[c] for c in kth}
    undecided = [c for c, taken in sorted(off.items()) if taken and least.get(c, 0) <= 0]
    able = [c for c in kth if c not in undecided]
    if not able:
        return df.sparkSession.createDataFrame([], SUMMARY + ", rank int"), undecided
    limits = F.create_map(*[x for c in able for x in (F.lit(c), F.lit(least[c]))])
    candidates = materialize(
        held.where(F.col("feature").isin(able) & (F.col("count") >= limits[F.col("feature")])).select("feature", "value"),
        "candidates",
    )
    few = F.broadcast(candidates) if candidates.count() <= CANDIDATES else candidates
    long = df.select(*[F.col(c).cast("string").alias(c) for c in able]).unpivot([], able, "feature", "value")
    exact = long.join(few, ["feature", "value"]).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc("value"))
    return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), undecided
