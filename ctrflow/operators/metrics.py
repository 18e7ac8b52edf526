"""Model quality: ROC AUC over a table, over the last N rows, and alerts on it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.functions.auc import rolling_auc as _rolling
from ctrflow.operators.order import carry_last, dense_seq
from ctrflow.scratch import materialize


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def _slice_areas(batches):
    """Per range slice of ascending scores: its first score, classes and pair area.

    Keeps running totals over the Arrow batches, so memory is one batch.
    """
    low, pos, neg, area = None, 0, 0, 0.0
    for pdf in batches:
        if pdf.empty:
            continue
        if low is None:
            low = float(pdf["score"].iloc[0])
        p, n = pdf["pos"].to_numpy(), pdf["neg"].to_numpy()
        below = neg + np.cumsum(n) - n
        area += float(np.sum(p * (below + n / 2.0)))
        pos, neg = pos + int(p.sum()), neg + int(n.sum())
    if low is not None:
        yield pd.DataFrame({"low": [low], "pos": [pos], "neg": [neg], "area": [area]})


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """Exact ROC AUC with ties counting half, as one row ``(auc, n_pos, n_neg)``.

    Rows are first counted per distinct score (a hot score collapses in the map stage),
    then distinct scores are sliced by range. Each slice yields one row; only
    those, one per shuffle partition, meet in the last step. Null with a single
    class. Rows without label or score take no part.
    """
    score, label = F.col(p).cast("double"), F.col(y).cast("double")
    # -0.0 and 0.0 are the same score
    per_score = (
        df.where(label.isNotNull() & ~F.isnan(label) & score.isNotNull() & ~F.isnan(score))
        .select((score + F.lit(0.0)).alias("score"), label.alias("y"))
        .groupBy("score")
        .agg(
            F.count(F.when(F.col("y") > 0, 1)).alias("pos"),
            F.count(F.when(F.col("y") <= 0, 1)).alias("neg"),
        )
    )
    slices = (
        per_score.repartitionByRange("score")
        .sortWithinPartitions("score")
        .mapInPandas(_slice_areas, "low double, pos bigint, neg bigint, area double")
    )
    lower = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    total = slices.withColumn("below", F.coalesce(F.sum("neg").over(lower), F.lit(0))).agg(
        F.sum(F.col("area") + F.col("pos") * F.col("below").cast("double")).alias("area"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return total.select(F.when(pairs > 0, F.col("area") / pairs).alias("auc"), "n_pos", "n_neg")


def rolling_auc(
    df: DataFrame,
    order: Sequence[str],
    y: str,
    p: str,
    n: int = 500,
    key: Sequence[str] = (),
    block: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """AUC of the last ``n`` rows at each row, per ``key``.

    Adds ``rolling_auc`` (null with one class, or with a label or score missing in the
    window) and ``in_window``. All keys share one row numbering in (key, order) and are
    cut into blocks of ``block`` consecutive rows, so a key of any size spreads
    over many tasks and small keys share one. Each block also gets copies of
    the ``n - 1`` rows before it.
    """
    out = _in_blocks(df, order, y, p, n, key, block, unique, None)
    names = [*df.columns, "rolling_auc", "in_window"]
    return out.select(*names).withColumn("rolling_auc", F.nanvl("rolling_auc", F.lit(None).cast("double")))


def _in_blocks(
    df: DataFrame, order: Sequence[str], y: str, p: str, n: int, key: Sequence[str], block: int | None,
    unique: bool, known: str | None,
) -> DataFrame:
    """``rolling_auc`` with its ``__block`` and ``__seq``, and ``__held``: the last AUC of the key so far in the block.

    ``known`` names a column whose value, where there is one, is held instead of a row's own.
    """
    block = block or max(20 * n, 20_000)
    numbered = dense_seq(df, [*key, *order], "__seq", start=0, unique=unique)
    seq = F.col("__seq")
    home = F.floor(seq / block)
    last = F.floor((seq + (n - 1)) / block)  # the last block that needs this row before it
    blocks = numbered.withColumn("__home", home).withColumn(
        "__block", F.explode(F.sequence(home, last))
    )
    names, keys = [*df.columns, "__block", "__seq"], list(key)
    fields = {f.name: f for f in blocks.schema.fields}
    double = T.DoubleType()
    schema = T.StructType(
        [
            *[fields[c] for c in names],
            T.StructField("rolling_auc", double),
            T.StructField("in_window", T.LongType()),
            T.StructField("__held", double),
        ]
    )

    def one_block(part: pa.Table) -> pa.Table:
        # as Arrow, so that carried columns come back as they are
        part = part.take(pc.sort_indices(part.column("__seq")))
        segment = None
        if keys:
            pdf = part.select(keys).to_pandas(types_mapper=pd.ArrowDtype)
            segment = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()

        def numbers(c):
            return pc.fill_null(part.column(c).cast(pa.float64()), float("nan")).to_numpy()

        auc, size = _rolling(numbers(y), numbers(p), n, segment)
        mine = pc.equal(part.column("__home"), part.column("__block")).to_numpy()
        held = auc[mine]
        if known:
            given = numbers(known)[mine]
            held = np.where(np.isnan(given), held, given)
        row = np.arange(len(held))
        at = np.maximum.accumulate(np.where(np.isnan(held), -1, row)) if len(held) else row
        if segment is not None:
            # not beyond where the key's rows begin
            ours = segment[mine]
            begin = np.maximum.accumulate(np.where(np.r_[True, ours[1:] != ours[:-1]], row, 0)) if len(ours) else row
            at = np.where(at < begin, -1, at)
        held = np.where(at >= 0, held[np.maximum(at, 0)], np.nan)
        out = part.select(names).filter(pa.array(mine))
        for name, values in (("rolling_auc", auc[mine]), ("in_window", size[mine]), ("__held", held)):
            out = out.append_column(name, pa.array(values))
        return out

    return blocks.groupBy("__block").applyInArrow(one_block, schema)


def rolling_auc_held(
    df: DataFrame,
    order: Sequence[str],
    y: str,
    p: str,
    n: int = 500,
    key: Sequence[str] = (),
    block: int | None = None,
    unique: bool = False,
    init: float = 1.0,
    known: str | None = None,
) -> DataFrame:
    """``rolling_auc`` where each row has the last AUC there was; ``init`` before any.

    The rows are put in order once. Each block carries its own values; what goes from block to block is one row per
    block, the last key there and the last value it has had.
    """
    blocks = materialize(_in_blocks(df, order, y, p, n, key, block, unique, known), "blocks")
    none = F.lit(None).cast("double")
    held = F.nanvl("__held", none)
    last = F.max_by(F.struct(*[F.col(k) for k in key], held.alias("held")), F.col("__seq")).alias("last")
    ends = blocks.groupBy("__block").agg(last).select(
        F.col("__block").alias("__after"), *[F.col("last")[k].alias(f"__k{i}") for i, k in enumerate(key)], "last.held"
    )
    names = [f"__k{i}" for i in range(len(key))]
    # a block that starts with a key follows blocks that end with it, if there are earlier rows of the key
    begins = (
        blocks.groupBy("__block").agg(F.min_by(F.struct(F.lit(0), *key), F.col("__seq")).alias("first")).select(
            "__block", *[F.col("first")[k].alias(f"__k{i}") for i, k in enumerate(key)]
        ).withColumn("held", none).select(F.col("__block").alias("__after"), *names, "held", F.lit(True).alias("asks"))
        .unionAll(ends.select("__after", *names, "held", F.lit(False)))
    )
    earlier = Window.partitionBy(*names).orderBy("__after", F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    asked = begins.withColumn("__carried", F.last("held", ignorenulls=True).over(earlier)).where("asks").where(
        "__carried is not null"
    )
    same = F.col("__block") == F.col("__after")
    for k, name in zip(key, names):
        same = same & F.col(k).eqNullSafe(F.col(name))
    out = blocks.join(asked, same, "left")
    return out.select(
        *df.columns, F.coalesce(held, "__carried", F.lit(init)).alias("rolling_auc"), "in_window"
    )


def carry_last_valid(
    rolled: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    init: float = 1.0,
    col: str = "rolling_auc",
    unique: bool = False,
) -> DataFrame:
    """Where there is no AUC, the last one before it; ``init`` before any."""
    carried = carry_last(rolled, col, order, key, init, "__carried", unique)
    return carried.withColumn(col, F.col("__carried")).drop("__carried")


def long_enough(n: int, frac: float):
    """More than ``frac * n`` rows in the window."""
    return F.col("in_window") > F.lit(frac * n)


def threshold_alerts(
    monitored: DataFrame, n: int = 500, threshold: float = 0.5, frac: float = 0.5
) -> DataFrame:
    """Rows whose rolling AUC is below the threshold with enough rows in the window.

    Nothing is reset by an alert; the streaming monitor does that.
    """
    return monitored.where((F.col("rolling_auc") < threshold) & long_enough(n, frac))


def join_label_score(
    labels: DataFrame, scores: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Pair labels with scores by row key."""
    return labels.join(scores, list(key))


