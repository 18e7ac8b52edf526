"""Counter windows on a live series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.streaming.ordered import TIME, InOrder, in_event_order, milliseconds


def window_deltas(
    series: DataFrame,
    labels: Sequence[str],
    length: str = "30 seconds",
    slide: str = "10 seconds",
    watermark: str = "1 minute",
) -> DataFrame:
    """Last minus first value per window and series; null below two samples.

    Works on streams, where closed windows are emitted once (append mode), and on tables.
    State is a pair of samples per open window and series.
    """
    return (
        series.withWatermark("ts", watermark)
        .groupBy(F.window("ts", length, slide), *labels)
        .agg(
            F.min_by("value", "ts").alias("__first"),
            F.max_by("value", "ts").alias("__last"),
            F.count(F.lit(1)).alias("samples"),
        )
        .select(
            F.col("window.start").alias("start"),
            F.col("window.end").alias("end"),
            *labels,
            F.when(F.col("samples") >= 2, F.col("__last") - F.col("__first")).alias("delta"),
            "samples",
        )
    )


class _Counter(InOrder):
    """A counter's last value, and per instant to come what its frame holds so far."""

    def __init__(self, value: T.StructField, key: list[T.StructField], frame_ms: int, every_ms: int, step: int):
        super().__init__([value], [value.name], step)
        self.value, self.key, self.frame_ms, self.every_ms = value, key, frame_ms, every_ms

    def init(self, handle) -> None:
        super().init(handle)
        kind = self.value.dataType
        names = [("increase", kind), ("samples", T.LongType()), ("first", kind), ("last", kind)]
        self._frames = handle.getMapState("frames", "at bigint", T.StructType([T.StructField(n, t) for n, t in names]))
        self._last = handle.getValueState("last", T.StructType([T.StructField("value", kind)]))

    def take(self, key, rows, end_ms) -> Iterable[pd.DataFrame]:
        if rows is not None:
            self._add(rows[TIME].to_numpy(np.int64), rows[self.value.name].to_numpy())
        every = self.every_ms
        out = []
        # frames are closed at both ends, so an instant is full when the step that holds it has passed
        for k in range(-(-(end_ms - self.step_ms) // every), -(-end_ms // every)):
            found = self._frames.getValue((k,))
            if found is not None:
                self._frames.removeKey((k,))
                total, n, first, last = found
                out.append((k * every * 1000, n, total, total * 1000.0 / self.frame_ms, last - first if n > 1 else None))
        if out:
            frame = pd.DataFrame(out, columns=[TIME, "samples", "increase", "rate", "delta"])
            for field, value in zip(self.key, key):
                frame[field.name] = value
            yield frame[[*[f.name for f in self.key], TIME, "samples", "increase", "rate", "delta"]]

    def _instants(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last instant whose frame holds each time."""
        every = self.every_ms * 1000
        return -(-times // every), (times + self.frame_ms * 1000) // every

    def arrived(self, times: np.ndarray) -> None:
        first, last = self._instants(times)
        deep = np.arange(int((last - first).max()) + 1)
        reached = first[:, None] + deep
        for k in np.unique(reached[deep <= (last - first)[:, None]]).tolist():
            self.wake_after(k * self.every_ms)

    def _add(self, times: np.ndarray, values: np.ndarray) -> None:
        before = self._last.get()
        previous = np.r_[values[0] if before is None else before[0], values[:-1]]
        change = values - previous
        steps = np.where(change < 0, values, change)
        first, last = self._instants(times)
        for k in range(int(first.min()), int(last.max()) + 1):
            inside = (first <= k) & (k <= last)
            if not inside.any():
                continue
            held = values[inside]
            new = (steps[inside].sum(), len(held), held[0], held[-1])
            found = self._frames.getValue((k,))
            if found is not None:
                new = (found[0] + new[0], found[1] + new[1], found[2], new[3])
            self._frames.updateValue((k,), tuple(v.item() if isinstance(v, np.generic) else v for v in new))
        self._last.update((values[-1].item(),))


def live_increase(
    series: DataFrame,
    key: Sequence[str],
    frame: str = "1 minute",
    every: str = "10 seconds",
    delay: str = "1 minute",
    step: str = "10 seconds",
) -> DataFrame:
    """Increase, rate and delta of live counters at instants ``every`` apart.

    Returns ``key..., at, samples, increase, rate, delta`` for each instant whose frame ``[at - frame, at]`` holds a sample,
    with the meaning of ``operators.series``: a fall of a counter is a reset and counts as its new value, the first
    sample of a series adds nothing, ``delta`` is null below two samples. Samples may arrive in any order up to
    ``delay`` behind the latest one of all series; an instant comes out when the watermark has passed it and the rest of its
    step, also for a series that has fallen silent. Null values are no samples.
    """
    fields = {f.name: f for f in series.schema.fields}
    keys, value = [fields[k] for k in key], fields["value"]
    whole = isinstance(value.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    kind = T.LongType() if whole else T.DoubleType()
    value = T.StructField("value", kind)
    output = T.StructType(
        [
            *keys, T.StructField(TIME, T.LongType()), T.StructField("samples", T.LongType()),
            T.StructField("increase", kind), T.StructField("rate", T.DoubleType()), T.StructField("delta", kind),
        ]
    )
    processor = _Counter(value, keys, milliseconds(frame), milliseconds(every), milliseconds(step))
    samples = series.where(F.col("value").isNotNull()).withColumn("value", F.col("value").cast(kind))
    out = in_event_order(samples, "ts", key, processor, output, delay)
    return out.withColumnRenamed("ts", "at")
