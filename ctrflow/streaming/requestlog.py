"""Request log: arriving rows, written out once there are enough and enough time has passed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ctrflow.scratch import delete_path, local_table

#: Fixed format: the name of a request log file.
LOG_TIME = "%d_%m_%Y-%H-%M-%S"


class RequestLog:
    """Rows wait in ``pending/batch_id=N``, one folder per micro-batch. When at least
    ``min_rows`` wait and ``min_gap`` has passed since the last flush, all that wait become
    one table ``log/batch_id=N/<time>.parquet``, of as many files as its size asks for. A batch
    that is enough by itself, with no others waiting, goes there at once and is written a single time.

    ``state/batch_id=N`` records the flush that batch N caused and is written last. A batch
    that is played again overwrites its own folders, so no row is logged twice. Pending
    and state folders that a later flush has made useless are deleted.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        min_rows: int = 320,
        min_gap: timedelta = timedelta(seconds=60),
        now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.min_rows, self.min_gap, self.now = min_rows, min_gap, now

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/batch_id={batch_id}"

    def flushes(self) -> list[tuple[int, float]]:
        """``(batch_id, seconds since 1970)`` of the last flushes, oldest first; a few rows."""
        try:
            state = self.spark.read.parquet(f"{self.path}/state")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        return sorted((r.batch_id, r.at) for r in state.select("batch_id", "at").collect())

    def batch(self, df: DataFrame, batch_id: int) -> None:
        """One micro-batch: store it, and flush when both conditions hold."""
        done = self.flushes()
        if any(b >= batch_id for b, _ in done):
            return
        # a flush that was cut short may have left rows there
        delete_path(self.spark, self._folder("log", batch_id))
        after, at = done[-1][0] if done else -1, self.now()
        if after == batch_id - 1 and self._due(done, at) and df.limit(self.min_rows).count() >= self.min_rows:
            self._log(df, batch_id, at)
            self._record(done, batch_id, at, self.spark.read.schema(df.schema).parquet(self._file(batch_id, at)).count())
            return
        df.write.mode("overwrite").parquet(self._folder("pending", batch_id))
        self._flush(df.schema, batch_id, force=False)

    def close(self, schema: T.StructType) -> bool:
        """Write what still waits. Call it when the query has stopped: without arriving rows
        no batch runs, so nothing else would write the last ones."""
        try:
            pending = self.spark.read.schema(schema).parquet(f"{self.path}/pending")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return False
        last = pending.select(
            F.max(F.regexp_extract(F.col("_metadata.file_path"), "batch_id=([0-9]+)", 1).cast("bigint"))
        ).first()[0]
        return last is not None and self._flush(schema, last, force=True)

    def _due(self, done: list[tuple[int, float]], at: datetime) -> bool:
        return not done or at.timestamp() - done[-1][1] >= self.min_gap.total_seconds()

    def _file(self, batch_id: int, at: datetime) -> str:
        return f"{self._folder('log', batch_id)}/{at.strftime(LOG_TIME)}.parquet"

    def _log(self, rows: DataFrame, batch_id: int, at: datetime) -> None:
        # the folder goes first: a flush that was cut short may have left another time there
        delete_path(self.spark, self._folder("log", batch_id))
        rows.write.parquet(self._file(batch_id, at))

    def _record(self, done: list[tuple[int, float]], batch_id: int, at: datetime, rows: int) -> None:
        record = local_table(self.spark, "at double, rows bigint", [(at.timestamp(), rows)])
        record.write.mode("overwrite").parquet(self._folder("state", batch_id))
        # what the flush before this one has covered cannot be played again
        for old, _ in done[:-1]:
            delete_path(self.spark, self._folder("state", old))
        first, after = done[-2][0] if len(done) > 1 else -1, done[-1][0] if done else -1
        for old in range(first + 1, after + 1):
            delete_path(self.spark, self._folder("pending", old))

    def _flush(self, schema: T.StructType, batch_id: int, force: bool) -> bool:
        done = self.flushes()
        if any(b >= batch_id for b, _ in done):
            return False
        after = done[-1][0] if done else -1
        folders = [self._folder("pending", b) for b in range(after + 1, batch_id + 1)]
        waiting = self.spark.read.schema(schema).parquet(*folders)
        rows, at = waiting.count(), self.now()
        if rows == 0 or not (force or (rows >= self.min_rows and self._due(done, at))):
            return False
        self._log(waiting, batch_id, at)
        self._record(done, batch_id, at, rows)
        return True

    def read(self) -> DataFrame:
        """Everything logged so far."""
        return self.spark.read.option("recursiveFileLookup", True).parquet(f"{self.path}/log")


def log_requests(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    min_rows: int = 320,
    min_gap: timedelta = timedelta(seconds=60),
    now: Callable[[], datetime] | None = None,
    **trigger,
) -> tuple[StreamingQuery, RequestLog]:
    """Start the log of a stream of unpacked requests."""
    log = RequestLog(requests.sparkSession, path, min_rows, min_gap, *([now] if now else []))
    query = (
        requests.writeStream.foreachBatch(log.batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )
    return query, log
