"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used.

    An alias would be copied into every place that uses it, also into the lambdas of
    higher-order functions, where it would be computed once per element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def prefix_sums(lengths: Column) -> Column:
    """Sums of the elements before each element of an array of long, the total last.

    In two levels, so that n elements take n * sqrt(n) additions.
    """
    zero = F.lit(0).cast("bigint")

    def total(array, start, n):
        return F.aggregate(F.slice(array, start, n), zero, lambda a, x: a + x)

    def from_blocks(xs):
        width = F.greatest(F.ceil(F.sqrt(F.size(xs).cast("double"))).cast("int"), F.lit(1))
        n_blocks = F.floor(F.size(xs) / width).cast("int") + 1

        def per_block(b):
            sums = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda j: total(xs, j * b + 1, b))
            return let(
                sums,
                lambda s: let(
                    F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: total(s, F.lit(1), j)),
                    lambda before: F.transform(
                        F.sequence(F.lit(0), F.size(xs)),
                        lambda i: F.get(before, F.floor(i / b).cast("int"))
                        + total(xs, F.floor(i / b).cast("int") * b + 1, i % b),
                    ),
                ),
            )

        return let(width, per_block)

    return let(lengths, from_blocks)


def shielded(docs: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, list[str], list[Column]]:
    """``docs`` with its kept columns under names that clash with nothing, the text as ``__t``.

    Also those names, and the columns under which they get their own names back.
    """
    names = [f"__k{i}" for i in range(len(keep))]
    frame = docs.select(
        *[docs[f"`{c}`"].alias(n) for c, n in zip(keep, names)], docs[f"`{text}`"].alias("__t")
    )
    return frame, names, [F.col(n).alias(c) for c, n in zip(keep, names)]


#: Rows of a few numbers or hashes that are broadcast; larger tables are joined by shuffle.
BROADCAST_ROWS = 200_000


def small_or_not(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it has no more than ``rows`` of them."""
    return F.broadcast(written) if written.count() <= rows else written


def keyed(rows: DataFrame, side: DataFrame, on: list[str], limit: int = BROADCAST_ROWS, salts: int = 64) -> DataFrame:
    """``rows`` joined with a written table that has one row per key, however many rows a key has.

    The table is broadcast if it has no more than ``limit`` rows. Otherwise each of its rows goes to ``salts``
    places, over which the rows of a hot key are dealt. Null keys meet nothing.
    """
    if side.count() <= limit:
        return rows.join(F.broadcast(side), on)
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return dealt.join(copies, [*on, "__salt"]).drop("__salt")


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """The remainder of the CRC-32 of an id written as text; null ids count as empty text."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % n
