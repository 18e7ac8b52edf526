"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words. A document's expected number of copies is its source's target over its
source's size; the fraction of it is rounded. A document is paired with the pool of those after it: mass, in
words, goes from one to the other in a randomly chosen direction until one of the two is whole. The expected
copies of each document stay what they were, and so does the sum of the words. Documents are numbered in
a fixed order and rounded in groups of ``FAN``, the longest first; each group leaves at most one document
unsettled, and these go, again in groups of ``FAN``, up a tree until one is left per source, which a last
draw settles. Pairing with a pool, where pairs of single documents would do for the sums, makes
what is left in the end one of the shortest documents: a long one finds no partner of its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.frames import keyed, let, shielded, table
from ctrflow.llm.registry import query
from ctrflow.operators.order import dense_seq, running_sums
from ctrflow.scratch import materialize

#: Weights of the sources in the order of their names, repeating; and copies of a document at most.
WEIGHTS, MOST = (5, 2, 1), 3
#: Documents that are rounded in one group.
FAN = 128
#: Masses below this part of a copy are nothing.
_DUST = 1e-9

_BLANK, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
_OPEN = "struct<size: bigint, seq: bigint, x: double>"
_STATE = (
    f"struct<done: array<struct<seq: bigint, up: boolean>>, left: {_OPEN}, "
    "size: double, mass: double, shift: double, scale: double>"
)


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    # words become single letters, together with what surrounds them, so that no array of words is built
    short = F.regexp_replace(text, f"{_BLANK}*{_WORD}{_BLANK}*", "w")
    return F.when(F.rlike(text, F.lit(_WORD)), F.length(short)).otherwise(0).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``number`` and ``target`` to a written table of sources ``(name, words)``.

    Targets share all words by weight. None is above ``most`` times its source's words: what is left over goes to
    the others by weight, until none is above. That is a common level of words per weight, and each
    target the less of its cap and the level; the level follows from running sums over the sources in
    the order in which they reach their caps.
    """
    spark = sizes.sparkSession
    numbered = dense_seq(
        sizes.withColumn("nameless", F.col("name").isNull()), ["nameless", "name"], name="number", start=0, unique=True
    ).drop("nameless")
    each = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    numbered = materialize(
        numbered.withColumns({"weight": each, "cap": (F.col("words") * most).cast("decimal(38,0)")}), "sources"
    )
    total, weight = numbered.agg(F.sum("words"), F.sum("weight")).first()
    # words per weight at the cap, times a common multiple of all weights
    at_cap = F.col("cap") * (F.lit(math.lcm(*weights)) / F.col("weight")).cast("bigint")
    sums = running_sums(
        numbered.withColumn("at_cap", at_cap), ["at_cap", "number"],
        {"caps": F.col("cap"), "weights": F.col("weight")}, unique=True,
    )
    words_left = F.lit(total).cast("decimal(38,0)") - (F.col("caps") - F.col("cap"))
    weight_left = F.lit(weight).cast("decimal(38,0)") - (F.col("weights") - F.col("weight"))
    level = sums.where(words_left * F.col("weight") <= F.col("cap") * weight_left).agg(
        F.min_by(F.struct(words_left.alias("n"), weight_left.alias("d")), F.struct("at_cap", "number")).alias("level")
    ).first()["level"]
    words_at = F.lit(int(level["n"]))
    share = (words_at.cast("double") * F.col("weight") / F.lit(int(level["d"])).cast("double")).cast("double")
    reached = F.col("cap") * int(level["d"]) <= words_at.cast("decimal(38,0)") * F.col("weight")
    return numbered.select(
        "name", "words", "number", F.when(reached, F.col("cap").cast("double")).otherwise(share).alias("target")
    )


def _settle(state: Column, item: Column, seed: int) -> Column:
    """One step of the rounding: the next document meets the pool of those after it.

    ``size`` and ``mass`` are the pool's words and expected words, the next document still among them. Its
    expected copies have been moved by earlier steps from ``x`` to ``shift + scale * x``.
    """

    def part(moved: Column, movable: Column) -> Column:
        return F.when(movable > 0, moved / movable).otherwise(0.0)

    def pair(x: Column) -> Column:
        return let(
            F.struct(
                x.alias("x"),
                (state["size"] - item["size"]).alias("size"),
                F.greatest(state["mass"] - item["size"] * x, F.lit(0.0)).alias("mass"),
            ),
            lambda p: let(
                F.struct(
                    # words that may go from the pool to the document, and the other way, until one of them is whole
                    F.least(item["size"] * (1 - p["x"]), p["mass"]).alias("forth"),
                    F.least(item["size"] * p["x"], p["size"] - p["mass"]).alias("back"),
                    p["x"].alias("x"), p["size"].alias("size"), p["mass"].alias("mass"),
                ),
                move,
            ),
        )

    def move(p: Column) -> Column:
        up = _draw(F.lit(seed), item["seq"]) * (p["forth"] + p["back"]) < p["back"]
        stuck = p["forth"] + p["back"] <= 0
        return let(
            F.struct(
                (p["x"] + F.when(stuck, 0.0).when(up, p["forth"]).otherwise(-p["back"]) / item["size"]).alias("x"),
                p["size"].alias("size"),
                (p["mass"] - F.when(stuck, 0.0).when(up, p["forth"]).otherwise(-p["back"])).alias("mass"),
                # all of the pool move by the same part of what they may move
                F.when(up, part(p["forth"], p["mass"])).otherwise(part(p["back"], p["size"] - p["mass"])).alias("part"),
                F.when(up, 0.0).otherwise(1.0).alias("to"),
            ),
            decide,
        )

    def decide(n: Column) -> Column:
        whole = (n["x"] < _DUST) | (n["x"] > 1 - _DUST)
        one = F.array(F.struct(item["seq"].alias("seq"), (n["x"] > 0.5).alias("up")))
        still = F.struct(item["size"].alias("size"), item["seq"].alias("seq"), n["x"].alias("x"))
        keep = 1 - n["part"]
        return F.struct(
            F.when(whole, F.concat(state["done"], one)).otherwise(state["done"]).alias("done"),
            F.when(whole, state["left"]).otherwise(still).alias("left"),
            n["size"].alias("size"), n["mass"].alias("mass"),
            (state["shift"] * keep + n["to"] * n["part"]).alias("shift"), (state["scale"] * keep).alias("scale"),
        ).cast(_STATE)

    return let(F.least(F.greatest(state["shift"] + state["scale"] * item["x"], F.lit(0.0)), F.lit(1.0)), pair)


def _draw(*of: Column) -> Column:
    """A number from 0 to below 1 that depends on ``of`` only."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / float(1 << 53)


def _rounded(rows: DataFrame, last: int, seed: int, fan: int) -> list[DataFrame]:
    """Tables ``(seq, up)`` of all ``rows(number, place, size, seq, x)``, with places from 0 to ``last`` in a source's order."""
    out, level = [], 0

    def total(group: str, of) -> Column:
        return F.aggregate(group, F.lit(0.0), lambda t, e: t + of(e))

    start = F.struct(
        F.array().cast("array<struct<seq: bigint, up: boolean>>").alias("done"), F.lit(None).cast(_OPEN).alias("left"),
        total("group", lambda e: e["size"].cast("double")).alias("size"),
        total("group", lambda e: e["size"] * e["x"]).alias("mass"),
        F.lit(0.0).alias("shift"), F.lit(1.0).alias("scale"),
    ).cast(_STATE)
    while True:
        level += 1
        # the largest first: what is left of a group, and in the end of a source, tends to be small
        group = F.sort_array(F.collect_list(F.struct("size", "seq", "x")), asc=False)
        folded = materialize(
            rows.groupBy("number", F.floor(F.col("place") / fan).cast("bigint").alias("place"))
            .agg(group.alias("group"))
            .select(
                "number", "place",
                F.aggregate("group", start, lambda s, e: _settle(s, e, seed + level)).alias("s"),
            )
            .select("number", "place", "s.done", "s.left"),
            "rounded",
        )
        out.append(folded.select(F.explode("done").alias("d")).select("d.seq", "d.up"))
        rows, last = folded.where("left is not null").select("number", "place", "left.*"), last // fan
        if last == 0:
            out.append(rows.select("seq", (_draw(F.lit(seed), F.col("seq")) < F.col("x")).alias("up")))
            return out


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    seed: int = 12,
    fan: int = FAN,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` to every row.

    ``size`` is the number of words of the text, ``source_size`` the sum over its source, ``target`` the words
    its source should give, ``copies`` how often the whole text is taken (0 to ``most``) and ``taken``
    the words that makes. Null and empty texts have no words and no copies; null is a source, after all named ones;
    repeated rows are rows of their own. What a source gives differs from its target by less than the size of
    one document. The result depends on the rows only, not on how they are stored. ``keep`` names the columns that
    stay (default: all); a column of an added name is replaced.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    named = docs.withColumn("__name", docs[f"`{source}`"])
    rows, names, own = shielded(named, [*keep, "__name"], text)
    name = names[-1]
    key = F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))
    rows = materialize(
        rows.select(
            *names, key.alias("__key"), n_words(F.col("__t")).alias("__size"),
            F.xxhash64(F.lit(seed), *names, "__t").alias("__order"),
        ),
        "sized",
    )
    sizes = materialize(rows.groupBy("__key", F.col(name).alias("name")).agg(F.sum("__size").alias("words")), "sizes")
    out = [F.col("__size").alias("size"), F.col("words").alias("source_size"), F.col("target")]
    if sizes.isEmpty():
        none = F.lit(0).cast("bigint")
        return rows.select(
            *own[:-1], F.col("__size").alias("size"), none.alias("source_size"), F.lit(0.0).alias("target"),
            none.alias("copies"), none.alias("taken"),
        )
    goal = materialize(
        targets(sizes.select("name", "words"), weights, most)
        .withColumn("__key", F.coalesce(F.concat(F.lit("="), F.col("name")), F.lit("")))
        .withColumn("ratio", F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)),
        "targets",
    )
    placed = materialize(
        dense_seq(
            keyed(rows, goal.drop("name"), ["__key"]), ["number", "__order"], name="__seq", start=0
        ),
        "placed",
    )
    whole = F.when(F.col("ratio") >= most, F.lit(most)).otherwise(F.floor("ratio")).cast("bigint")
    part = F.col("ratio") - whole
    open_rows = placed.where((F.col("__size") > 0) & (part > _DUST)).select(
        "number", F.col("__seq").alias("place"), F.col("__size").alias("size"), F.col("__seq").alias("seq"), part.alias("x")
    )
    last = placed.agg(F.max("__seq")).first()[0]
    ups = None
    for settled in _rounded(open_rows, last, seed, fan):
        chosen = settled.where("up").select(F.col("seq").alias("__seq"), F.lit(1).alias("__up"))
        ups = chosen if ups is None else ups.unionAll(chosen)
    copies = F.when(F.col("__size") > 0, whole + F.coalesce("__up", F.lit(0))).otherwise(0).cast("bigint")
    return placed.join(ups, "__seq", "left").select(
        *own[:-1], *out, copies.alias("copies"), (F.col("__size") * copies).alias("taken")
    )


@query("op12_mixture")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"), keep=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )
