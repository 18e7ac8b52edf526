"""Intermediate tables in the cluster's shared folder.

Operators that need two passes over one exact arrangement of rows write that
arrangement down instead of caching it: a lost executor then costs a re-read and
never a second, differently cut, computation.

The folder is the session's ``spark.checkpoint.dir``. Only a ``local`` session,
where driver and executors are one process on one machine, gets a folder of its
own when the setting is missing.
"""

from __future__ import annotations

import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file:" + tempfile.mkdtemp(prefix="ctrflow-")
    return _LOCAL[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


#: Deletes what a write has shuffled when it has ended, not when the driver next collects its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table; what was shuffled for it goes at once."""
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    written = spark.read.schema(df.schema).parquet(path)
    written._written = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once all that is made of them is written itself."""
    for written in tables:
        delete_path(written.sparkSession, written._written)


def local_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few driver-side rows (one per column or feature, say) as a frame."""
    fields = T.StructType.fromDDL(schema).fields
    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64(),
             T.IntegerType(): pa.int32()}
    arrays = {
        f.name: pa.array([r[i] for r in rows], kinds[f.dataType]) for i, f in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(arrays))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any file system Spark can read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def set_times(spark: SparkSession, path: str, step_ms: int = 10) -> None:
    """Give the data files of a folder, in the order of their names, increasing times in the recent past."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in system.listStatus(folder)), key=lambda p: p.getName())
    files = [p for p in files if p.getName().startswith("part-")]
    first = int(time.time() * 1000) - step_ms * len(files)
    for i, p in enumerate(files):
        system.setTimes(p, first + i * step_ms, -1)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark can write to, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder."""
    delete_path(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
