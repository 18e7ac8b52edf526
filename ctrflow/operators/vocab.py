"""Vocabularies: building category codes and looking them up.

A vocabulary is one long table ``(column, value_int, value, code, freq)``. Integer
categories keep their integers (a long-keyed hash lookup is much cheaper than a string
one); all others are strings.

Sizes known from the fit decide how a column is looked up:

* small: broadcast, behind a limit on bytes per column and on all columns together;
* large: the few frequent values are broadcast - a value holding at least one row in
  ``HOT_SHARE`` can occur ``HOT_SHARE`` times at most, which bounds that table - and the
  others go through a shuffle join in which no known value is frequent. Rows that need no
  lookup any more are spread by a hash instead of meeting on one null key.

All large columns of a table are looked up together (``lookup_all``): what is joined are narrow rows
``(row, column, value)``, so the wide rows are exchanged once however many columns there are. Values that are frequent in the
rows at hand, whether the fit saw them or not, are found by a summary of those rows and broadcast too. Only
streams that are not taken batch by batch look up one column after the other, and leave such values to chance.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.operators.heavy import frequent_values
from ctrflow.operators.order import dense_seq
from ctrflow.scratch import materialize, new_path

VOCAB = "column string, value_int bigint, value string, code bigint, freq bigint"
HOT_SHARE = 10_000
#: Share of the rows at hand from which a value counts as frequent there.
AT_HAND = 1 / 2_000
SPREAD = "__spread"
ROW = "__row"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class VocabSize:
    """What the fit learned about one column's vocabulary."""

    n: int
    total: int
    key_bytes: int
    integral: bool

    @property
    def table_bytes(self) -> int:
        # key plus code plus the hash relation's own overhead per row
        return self.key_bytes + 48 * self.n

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class LookupLimits:
    """Most that may be broadcast: per column, and over all columns of one transform."""

    column_bytes: int = 64 << 20
    total_bytes: int = 512 << 20


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value_int, value, freq)`` of non-null values.

    Columns of one kind are unpivoted and pre-aggregated in one stage, so a hot value leaves
    each task as one row.
    """
    kinds = {f.name: isinstance(f.dataType, _INTEGRAL) for f in df.schema}
    tables = []
    for integral, key, other, kind in (
        (True, "value_int", "value", "bigint"), (False, "value", "value_int", "string"),
    ):
        names = [c for c in columns if kinds[c] is integral]
        if not names:
            continue
        counted = (
            df.select(*[F.col(c).cast(kind).alias(c) for c in names])
            .unpivot([], names, "column", key)
            .where(F.col(key).isNotNull())
            .groupBy("column", key)
            .agg(F.count(F.lit(1)).alias("freq"))
        )
        empty = F.lit(None).cast("string" if integral else "bigint").alias(other)
        tables.append(
            counted.withColumn(other, empty).select("column", "value_int", "value", "freq")
        )
    return reduce(DataFrame.unionByName, tables)


def build(df: DataFrame, columns: list[str], order: str) -> tuple[DataFrame, dict[str, VocabSize]]:
    """Fit the vocabularies of all ``columns`` together."""
    by = [F.desc("freq")] if order == "freq" else []
    numbered = dense_seq(
        value_counts(df, columns), ["column", *by, "value_int", "value"], unique=True
    )
    rows = (
        numbered.groupBy("column")
        .agg(
            F.min("seq").alias("first"),
            F.count(F.lit(1)).alias("n"),
            F.sum("freq").alias("total"),
            F.sum(F.coalesce(F.octet_length("value"), F.lit(8))).alias("key_bytes"),
            F.first("value_int", ignorenulls=True).isNotNull().alias("integral"),
        )
        .collect()  # one row per column
    )
    sizes = {r.column: VocabSize(r.n, r.total, r.key_bytes, r.integral) for r in rows}
    for name in columns:
        sizes.setdefault(name, VocabSize(0, 0, 0, False))
    path = new_path(df.sparkSession, "vocab")
    coded = numbered.withColumn("code", F.col("seq"))
    if rows:
        first = F.create_map(*[x for r in rows for x in (F.lit(r.column), F.lit(r.first))])
        coded = numbered.withColumn("code", F.col("seq") - first[F.col("column")] + 1)
    write(coded, path)
    return read(df.sparkSession, path), sizes


def write(vocab: DataFrame, path: str) -> None:
    (
        vocab.select("column", "value_int", "value", "code", "freq")
        .write.partitionBy("column")
        .mode("overwrite")
        .parquet(path)
    )


def read(spark, path: str) -> DataFrame:
    return spark.read.schema(VOCAB).parquet(path)


def broadcastable(sizes: dict[str, VocabSize], limits: LookupLimits) -> set[str]:
    """Columns whose whole vocabulary is broadcast: the smallest first, within the limits."""
    chosen, used = set(), 0
    for name, size in sorted(sizes.items(), key=lambda kv: kv[1].table_bytes):
        if size.table_bytes > limits.column_bytes or used + size.table_bytes > limits.total_bytes:
            break
        used += size.table_bytes
        chosen.add(name)
    return chosen


def with_spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add a number that spreads rows evenly: a hash of the given columns (those that are read anyway) and, so that copies spread
    too, of the input partition. It depends on nothing that a second run of a task changes.
    """
    part = [] if df.isStreaming else [F.spark_partition_id()]
    return df.withColumn(SPREAD, F.xxhash64(*columns, *part))


def lookup(
    df: DataFrame, col: Column, name: str, vocab: DataFrame, size: VocabSize, small: bool
) -> tuple[DataFrame, Column]:
    """Join the codes of one column; returns the wider frame and the code column."""
    part = vocab.where(F.col("column") == name)
    key = "value_int" if size.integral else "value"
    value = col.try_cast("bigint" if size.integral else "string")
    code = f"__code_{name}"
    if small:
        table = part.select(F.col(key).alias("__k"), F.col("code").alias(code))
        df = df.join(F.broadcast(table), value == F.col("__k"), "left").drop("__k")
        return df, F.coalesce(F.col(code), F.lit(0).cast("bigint"))

    is_hot = F.col("freq") * HOT_SHARE >= size.total
    hot = part.where(is_hot).select(F.col(key).alias("__k"), F.col("code").alias(code + "_hot"))
    df = df.join(F.broadcast(hot), value == F.col("__k"), "left").drop("__k")
    open_ = F.col(code + "_hot").isNull() & value.isNotNull()
    df = df.withColumns(
        {"__v": F.when(open_, value), "__s": F.when(open_, F.lit(-1)).otherwise(F.col(SPREAD))}
    )
    cold = part.where(~is_hot).select(
        F.col(key).alias("__k"), F.lit(-1).cast("bigint").alias("__ks"), F.col("code").alias(code)
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size.table_bytes / partitions < 64 << 20:
        cold = cold.hint("shuffle_hash")  # spares sorting the wide side
    df = df.join(
        cold, (F.col("__v") == F.col("__k")) & (F.col("__s") == F.col("__ks")), "left"
    ).drop("__k", "__ks", "__v", "__s")
    return df, F.coalesce(F.col(code + "_hot"), F.col(code), F.lit(0).cast("bigint"))


def lookup_all(
    df: DataFrame, wanted: dict[str, tuple[Column, str]], vocab: DataFrame, sizes: dict[str, VocabSize]
) -> DataFrame:
    """Add the codes of several columns with large vocabularies; the wide rows are exchanged once.

    ``wanted`` maps a new column to the value and the column whose vocabulary it is looked up in. The rows are written
    down with a number each, so that the narrow rows made of them and the rows themselves agree.
    """
    values = {f"__v{i}": (out, name) for i, (out, (_, name)) in enumerate(wanted.items())}
    texts = []
    for v, (out, name) in values.items():
        value = wanted[out][0]
        texts.append((value.try_cast("bigint") if sizes[name].integral else value).cast("string").alias(v))
    base = materialize(df.select("*", F.monotonically_increasing_id().alias(ROW), *texts), "rows")
    key = F.coalesce("value", F.col("value_int").cast("string")).alias("__k")
    names = sorted({name for _, name in values.values()})
    total = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(sizes[n].total))])
    words = vocab.where(F.col("column").isin(names))
    known = words.where(F.col("freq") * HOT_SHARE >= total[F.col("column")]).select("column", key, "code")
    # frequent in these rows: at most 2 / AT_HAND values a column
    here = frequent_values(base.select(*values), list(values), AT_HAND)
    of = F.create_map(*[x for v, (_, name) in values.items() for x in (F.lit(v), F.lit(name))])
    here = here.select(of[F.col("feature")].alias("column"), F.col("value").alias("__k")).distinct()
    keyed = words.select("column", key, "code")
    here = here.join(keyed.join(F.broadcast(here), ["column", "__k"], "left_semi"), ["column", "__k"], "left")
    hot = materialize(
        known.unionByName(here).groupBy("column", "__k").agg(F.coalesce(F.max("code"), F.lit(0)).alias("__hot")), "hot"
    )
    cells = F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(name).alias("column"), F.col(v).alias("value"))
        for i, (v, (_, name)) in enumerate(values.items())
    ])
    narrow = base.select(ROW, F.explode(cells).alias("c")).where("c.value is not null").select(ROW, "c.*")
    narrow = narrow.join(
        F.broadcast(hot.withColumnRenamed("column", "__hc")),
        (F.col("column") == F.col("__hc")) & (F.col("value") == F.col("__k")), "left",
    ).drop("__hc", "__k")
    open_ = F.col("__hot").isNull()
    narrow = narrow.withColumns(
        {"__v": F.when(open_, F.col("value")), "__s": F.when(open_, F.lit(-1)).otherwise(F.col(ROW))}
    )
    cold = keyed.join(F.broadcast(hot), ["column", "__k"], "left_anti").select(
        F.col("column").alias("__cc"), "__k", F.lit(-1).cast("bigint").alias("__ks"), "code"
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if sum(sizes[n].table_bytes for n in names) / partitions < 64 << 20:
        cold = cold.hint("shuffle_hash")  # spares sorting the narrow rows
    found = narrow.join(
        cold,
        (F.col("column") == F.col("__cc")) & (F.col("__v") == F.col("__k")) & (F.col("__s") == F.col("__ks")), "left",
    ).select(ROW, "at", F.coalesce("__hot", "code").alias("code"))
    codes = found.groupBy(ROW).agg(
        *[F.max(F.when(F.col("at") == i, F.col("code"))).alias(f"__c{i}") for i in range(len(values))]
    )
    out = base.join(codes, ROW, "left")
    return out.select(
        *df.columns,
        *[F.coalesce(F.col(f"__c{i}"), F.lit(0).cast("bigint")).alias(o) for i, (o, _) in enumerate(values.values())],
    )
