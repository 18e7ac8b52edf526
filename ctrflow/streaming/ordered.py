"""Event-time order on streams: rows of a key wait in state until the watermark has passed them.

Time is cut into steps. A step's rows are kept in map state, in pieces as they arrive, and a timer stands at the
end of the step. When the watermark gets there nothing of the step can come any more; its rows are sorted
and handed on. So rows may arrive in any order within the watermark's delay, one step of a key is in memory
at a time, and a key that falls silent is served by the watermark that the other keys move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_timers(spark: SparkSession) -> None:
    """Timers and typed state need the RocksDB state store; a store the session names itself is left alone."""
    if spark.conf.get(_STORE, "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(_STORE, ""):
        spark.conf.set(_STORE, _ROCKS)


#: The event time in microseconds since 1970, as the processors see it, whatever the session's time zone. Names that
#: begin with an underscore do not reach a processor.
TIME = "event_time_us"


class InOrder(StatefulProcessor):
    """Keeps rows until their step has passed, then gives them to ``take`` in order.

    ``columns`` are the fields of the rows besides key and time, ``order`` names those that break ties of the
    time. ``step_ms`` is the length of a step.
    """

    def __init__(self, columns: list[T.StructField], order: Sequence[str], step_ms: int):
        self.columns = [T.StructField(TIME, T.LongType()), *columns]
        self.order, self.step_ms = [TIME, *order], step_ms

    def take(self, key: tuple, rows: pd.DataFrame | None, end_ms: int) -> Iterable[pd.DataFrame]:
        """What the sorted rows of the step that ends at ``end_ms`` give; None if it has no rows."""
        raise NotImplementedError

    def arrived(self, times: np.ndarray) -> None:
        """Called with the times of rows when they come. A timer that ``take`` needs is set here: one that
        ``take`` itself sets, and that the watermark has passed already, waits for the next batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        piece = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in self.columns])
        place = T.StructType([T.StructField("step", T.LongType()), T.StructField("piece", T.LongType())])
        self._waiting = handle.getMapState("waiting", place, piece)
        self._pieces = handle.getMapState("pieces", "step bigint", "n bigint")

    def wake_after(self, ms: int) -> None:
        """A timer at the end of the step that holds a time."""
        self.handle.registerTimer((ms // self.step_ms + 1) * self.step_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            times = frame[TIME].to_numpy()
            self.arrived(times)
            steps = times // 1000 // self.step_ms
            for step in np.unique(steps):
                part, step = frame[steps == step], int(step)
                found = self._pieces.getValue((step,))
                n = 0 if found is None else found[0]
                self._waiting.updateValue((step, n), tuple(_values(part[f.name]) for f in self.columns))
                self._pieces.updateValue((step,), (n + 1,))
                if n == 0:
                    self.handle.registerTimer((step + 1) * self.step_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end_ms = expiredTimerInfo.getExpiryTimeInMs()
        step = end_ms // self.step_ms - 1
        found = self._pieces.getValue((step,))
        rows = None
        if found is not None:
            pieces = []
            for n in range(found[0]):
                values = self._waiting.getValue((step, n))
                pieces.append(pd.DataFrame({f.name: list(v) for f, v in zip(self.columns, values)}))
                self._waiting.removeKey((step, n))
            self._pieces.removeKey((step,))
            rows = pd.concat(pieces, ignore_index=True).sort_values(self.order, ignore_index=True)
        yield from self.take(key, rows, end_ms)


def _values(column: pd.Series) -> list:
    return [None if v is None or v is pd.NA else v for v in column.tolist()]


def in_event_order(
    rows: DataFrame, ts: str, key: Sequence[str], processor: InOrder, output: T.StructType, delay: str
) -> DataFrame:
    """Run a stream through ``processor`` per key, with a watermark ``delay`` behind the latest row.

    ``output`` has the time as ``TIME``; it comes back under its own name. Rows that arrive behind the watermark are
    dropped; the stream's progress counts them (``numRowsDroppedByWatermark``). What the watermark has not
    passed when the stream ends stays in its state.
    """
    with_timers(rows.sparkSession)
    names = [f.name for f in processor.columns if f.name != TIME]
    marked = rows.select(*key, ts, F.unix_micros(ts).alias(TIME), *names).withWatermark(ts, delay)
    out = marked.groupBy(*key).transformWithStateInPandas(processor, output, "Append", "EventTime")
    return out.select(*[F.timestamp_micros(TIME).alias(ts) if c == TIME else c for c in out.columns])


def milliseconds(length: str) -> int:
    """A duration such as ``10 seconds``."""
    return int(pd.Timedelta(length) // pd.Timedelta(milliseconds=1))
