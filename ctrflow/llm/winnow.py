"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the least is a fingerprint. A span of words that a text
shares with a benchmark item holds the same hashes in both, so at least one
fingerprint in common if it is long enough. Texts are joined with the benchmark on fingerprints; only around
hits are windows of words compared word by word, and the hit spans united.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.llm.frames import let, shielded, small_or_not
from ctrflow.scratch import materialize

#: Consecutive words that count as contamination, and words of a hashed k-gram at most.
WINDOW, GRAM = 13, 5
#: Lower bits of a fingerprint that hold its position; hashes keep the others.
PLACE_BITS = 28

#: What stands between words, whatever the case of the letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text; letters as they are."""
    return F.filter(F.split(text, _BETWEEN, -1), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _grams(found: Column, gram: int) -> Column:
    """For every run of ``gram`` words its hash, above the bits of its position (from 1)."""
    clear = ~((1 << PLACE_BITS) - 1)
    return F.when(
        F.size(found) >= gram,
        F.transform(
            F.sequence(F.lit(1), F.size(found) - gram + 1),
            lambda i: F.xxhash64(F.slice(found, i, gram)).bitwiseAND(F.lit(clear)).bitwiseOR(i.cast("bigint")),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def fingerprints(found: Column, span: int, gram: int) -> Column:
    """The least of each window of k-grams over ``span`` words, as ``(h, at)``: hash and position."""
    width = span - gram + 1

    def least(grams: Column) -> Column:
        if width == 1:
            return grams
        return F.when(
            F.size(grams) >= width,
            F.transform(
                F.sequence(F.lit(1), F.size(grams) - width + 1), lambda i: F.array_min(F.slice(grams, i, width))
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    chosen = let(found, lambda w: let(_grams(w, gram), lambda g: F.array_distinct(least(g))))
    return F.transform(
        chosen,
        lambda v: F.struct(
            F.shiftright(v, PLACE_BITS).alias("h"), v.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int").alias("at")
        ),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    keep: list[str] | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated`` to every row.

    ``items`` are the ids, as sorted text, of the items of which a window occurs; ``n_hit`` the words inside any
    occurrence. A window is ``window`` words of an item, or a whole item of fewer. Contaminated means at
    least one hit word in twenty. Null and empty texts have no words, items without words no
    windows, null ids count as the empty text; an empty benchmark hits nothing. Equal texts are examined
    once. ``keep`` names the columns that stay (default: all); a column of an added name is replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items", "contaminated"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    docs, names, own = shielded(docs, keep, text)
    source = F.coalesce("__t", F.lit(""))
    items = materialize(
        benchmark.select(
            F.coalesce(benchmark[f"`{item}`"].cast("string"), F.lit("")).alias("item"),
            words(ascii_lower(benchmark[f"`{text}`"])).alias("w"),
            words(F.upper(benchmark[f"`{text}`"])).alias("u"),
        ).where(F.size("w") > 0),
        "items",
    )
    base = docs.select(
        *names,
        F.sha2(source, 256).alias("__text"),
        F.size(words(source)).cast("bigint").alias("n_words"),
    )
    shortest, longest = items.agg(F.min(F.size("w")), F.max(F.size("w"))).first()
    none = F.array().cast("array<string>")
    if shortest is None:
        return base.select(
            *own, "n_words", F.lit(0).cast("bigint").alias("n_hit"), F.lit(0).cast("bigint").alias("n_items"),
            none.alias("items"), F.lit(False).alias("contaminated"),
        )
    span = min(window, shortest)
    gram = min(GRAM, span)
    prints = materialize(
        items.select(F.explode(fingerprints(F.col("u"), span, gram)).alias("f")).select("f.h").distinct(), "prints"
    )

    def with_words(w: Column) -> Column:
        # what stands around a fingerprint goes with it, so that hits need not fetch their texts again
        around = lambda f: F.greatest(F.lit(1), f["at"] - (window - gram))
        return F.transform(
            fingerprints(words(F.upper(source)), span, gram),
            lambda f: F.struct(
                f["h"].alias("h"), f["at"].alias("at"), around(f).alias("first"),
                F.array_join(F.slice(w, around(f), f["at"] - around(f) + window), " ").alias("words"),
            ),
        )

    hits = (
        docs.select(F.sha2(source, 256).alias("__text"), F.explode(let(words(source), with_words)).alias("f"))
        .select("__text", "f.h", "f.at", "f.first", "f.words")
        .join(small_or_not(prints), "h")
        .dropDuplicates(["__text", "at"])
    )
    lengths = [window] if shortest >= window else [
        r[0] for r in items.select(F.least(F.size("w"), F.lit(window))).distinct().collect()
    ]
    found = _windows_of_items(items, window).join(_windows_at_hits(hits, lengths, gram), "words").select(
        "__text", "start", "n", "item"
    )
    found = materialize(found.distinct(), "found")
    before = (
        Window.partitionBy("__text").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("start") + F.col("n")
    covered = (
        found.select("__text", "start", "n").distinct()
        .withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
        .groupBy("__text")
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reach"))).cast("bigint").alias("hit"))
    )
    named = found.groupBy("__text").agg(F.sort_array(F.collect_set("item")).alias("named"))
    result = materialize(covered.join(named, "__text").withColumnRenamed("__text", "__found"), "result")
    out = base.join(small_or_not(result), F.col("__text") == F.col("__found"), "left")
    n_hit = F.coalesce("hit", F.lit(0).cast("bigint"))
    return out.select(
        *own, "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("named"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("named", none).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def _windows_of_items(items: DataFrame, window: int) -> DataFrame:
    n = F.least(F.size("w"), F.lit(window))
    some = F.transform(
        F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")
    )
    return items.select("item", F.explode(F.array_distinct(some)).alias("words"))


def _windows_at_hits(hits: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """All windows of the given lengths that hold a hit k-gram."""

    def windows(n: int) -> Column:
        starts = F.sequence(F.greatest(F.col("first"), F.col("at") - (n - gram)), F.col("at"))
        inside = F.filter(starts, lambda s: s - F.col("first") + n <= F.size("w"))
        return F.transform(
            inside,
            lambda s: F.struct(
                s.alias("start"), F.lit(n).alias("n"),
                F.array_join(F.slice("w", s - F.col("first") + 1, n), " ").alias("words"),
            ),
        )

    split = hits.select("__text", "at", "first", F.split(ascii_lower(F.col("words")), " ").alias("w"))
    every = F.flatten(F.array(*[windows(n) for n in lengths]))
    return split.select("__text", F.explode(every).alias("p")).select("__text", "p.*").distinct()
