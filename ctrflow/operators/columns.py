"""Projections: column groups, types, events, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.functions.scalars import nan_to_null
from ctrflow.operators.order import dense_seq
from ctrflow.schema import EVENT, CtrSchema


def select_group(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns; the scan reads no others."""
    return df.select(*names)


def concat_groups(df: DataFrame, *groups: Sequence[str]) -> DataFrame:
    """Several column groups side by side, as one projection."""
    return df.select(*[name for group in groups for name in group])


def split_features_label(df: DataFrame, schema: CtrSchema) -> tuple[DataFrame, DataFrame]:
    """Features and label as two frames. Both keep the row key, which is what aligns them."""
    features = df.select(*schema.key, *schema.cats, *schema.conts)
    return features, df.select(*schema.key, schema.label)


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes null."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def pack_event(
    conts: Sequence[str], cats: Sequence[str], label: str, score: str
) -> Column:
    """One prediction event as a struct: two number arrays and two numbers."""

    def numbers(names):
        return F.array(*[F.col(n).cast("double") for n in names])

    return F.struct(
        numbers(conts).alias("input0"),
        numbers(cats).alias("input1"),
        F.col(label).cast("double").alias("trueval"),
        F.col(score).cast("double").alias("predval"),
    )


def parse_events(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Decode the JSON payload; NaN becomes null and an unreadable payload is kept in
    ``corrupt``."""
    corrupt = "_corrupt"
    event = F.from_json(
        F.col(payload),
        T.StructType([*EVENT.fields, T.StructField(corrupt, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    others = [c for c in df.columns if c != payload]
    df = df.select(*others, F.col(payload), event.alias("__e"))
    return df.select(
        *others,
        F.transform("__e.input0", nan_to_null).alias("input0"),
        F.transform("__e.input1", nan_to_null).alias("input1"),
        nan_to_null(F.col("__e.trueval")).alias("trueval"),
        nan_to_null(F.col("__e.predval")).alias("predval"),
        F.when(F.col("__e").isNull() | F.col(f"__e.{corrupt}").isNotNull(), F.col(payload)).alias(
            "corrupt"
        ),
    )


def unpack_event(df: DataFrame, schema: CtrSchema, keep: Sequence[str] = ()) -> DataFrame:
    """Event arrays as named columns in request-log order; null where an array is short."""

    def cells(array, names):
        return [F.try_element_at(array, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]

    return df.select(
        *keep,
        F.col("trueval").alias(schema.label),
        *cells(F.col("input0"), schema.conts),
        *cells(F.col("input1"), schema.cats),
    )


def with_batch(
    df: DataFrame, size: int, order: Sequence[str], name: str = "batch"
) -> DataFrame:
    """Number rows in order from 0 and cut them into batches of ``size``."""
    return dense_seq(df, order, "seq", start=0).withColumn(
        name, F.floor(F.col("seq") / size).cast("bigint")
    )
