"""Similarity join on sets of word n-grams by prefixes of adaptive length.

Two sets of Jaccard similarity at least t share l elements among the first |x| - ceil(t |x|) + l of
each, in any common order. Rare elements come first here: they are hashed into an array of counters of a fixed size, which
all tasks fill and sum, and ordered by their counter. A document may take a longer
prefix (a larger l) and then leave out its l - 1 most frequent elements when it looks for partners, for at least one of the
l shared ones remains. l is the one of least estimated cost. A pair meets only in elements that stand so early in both
sets that as many are left as the two sizes ask for, and only if a bitmap of the prefixes allows for it: the bits in which the
parities of two prefixes differ are elements that one of them lacks, and what two sets share is in both prefixes or stands behind one.

Documents of equal sets are one class. Before the join, classes are compared with one class per prefix
element, in a few rounds with another one each, and what is linked so becomes one group: members of a group need not find each other again.
The first is the class with the fewest elements of its own. Elements that only one group holds are then left out, and a
class that has lost too many to be similar to any other is not looked for.
The pairs that are left are verified in rounds, too: a class with the one that it may have most in common with; what a round has linked
is united, and pairs inside one group are dropped. A large group of near copies so costs few pairs within it.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.llm.arrays import U, blocks, lists, mix, sets, shingles, utf8, words
from ctrflow.llm.components import components
from ctrflow.llm.frames import small_or_not
from ctrflow.scratch import discard, materialize

#: Longest prefix that is considered: l of the above, at most.
MATCHES = 4
#: Counters of elements, and how many of them travel together.
SLOTS, CHUNK = 1 << 21, 1 << 16
#: Rounds of comparing with one class per element before pairs are looked for.
ROUNDS = 3
#: Classes whose sets are fetched by broadcasting their keys; more of them are fetched by shuffle.
BROADCAST_ROWS = 1_000_000


def _sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    return sets(*shingles(*words(*utf8(column)), n))


def _slot(value: np.ndarray) -> np.ndarray:
    return (value >> U(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _summed(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_buffer(), np.uint32) for v in group.column("counts"))
    return pa.table({"chunk": group.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _counters(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """How many elements of all sets fall on each of ``SLOTS`` counters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        for block in blocks(batches, "t"):
            found, times = np.unique(_slot(_sets(block.column("t"), n)[0]), return_counts=True)
            total[found] += times.astype(np.uint32)
        for i in range(0, SLOTS, CHUNK):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // CHUNK], pa.int64()), pa.array([total[i : i + CHUNK].tobytes()], pa.binary())],
                ["chunk", "counts"],
            )

    rows = "chunk bigint, counts binary"
    counted = docs.select(docs[f"`{text}`"].alias("t")).mapInArrow(count, rows)
    # first among the tasks of each residue, so that no task gets the counters of all
    part = F.pmod(F.spark_partition_id(), F.lit(64))
    some = counted.withColumn("part", part).groupBy("part", "chunk").applyInArrow(_summed, rows)
    whole = some.groupBy("chunk").applyInArrow(_summed, rows).toArrow()
    out = np.zeros(SLOTS, np.uint32)
    for chunk, counts in zip(whole.column("chunk").to_pylist(), whole.column("counts").to_pylist()):
        out[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(counts, np.uint32)
    return out


def signatures(
    docs: DataFrame, text: str, keep: list[str], n: int, threshold: Fraction
) -> DataFrame:
    """``keep``, ``size`` of the set, ``id`` (a hash of the set), ``key`` (of the text) and ``prefix``."""
    counters = docs.sparkSession.sparkContext.broadcast(_counters(docs, text, n))
    p, q = threshold.numerator, threshold.denominator

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = counters.value
        for block in blocks(batches, "__t"):
            value, ends = _sets(block.column("__t"), n)
            size = np.diff(ends)
            row = np.repeat(np.arange(len(size)), size)
            sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(value ^ U(0x5851F42D4C957F2D)), dtype=U)))
            ids = mix(sums[ends[1:]] - sums[ends[:-1]] + size.astype(U))
            value = value[np.lexsort((value, times[_slot(value)], row))]
            length = np.minimum(size, size - -(-size * p // q) + MATCHES)
            cut = np.concatenate(([0], np.cumsum(length)))
            flat = np.arange(cut[-1]) - np.repeat(cut[:-1], length) + np.repeat(ends[:-1], length)
            arrays = [block.column(i) for i in range(len(keep))]
            arrays += [
                block.column("__key"), pa.array(size.astype(np.int64)), pa.array(ids.view(np.int64)),
                lists(value[flat], cut),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "key", "size", "id", "prefix"])

    frame = docs.select(
        *[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__t"), F.xxhash64(docs[f"`{text}`"]).alias("__key")
    )
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return materialize(
        frame.mapInArrow(sign, f"{kinds}, key bigint, size bigint, id bigint, prefix array<bigint>"), "signatures"
    )


def _fetched(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, n: int) -> DataFrame:
    """``(id, s)``: the whole sets of the classes in ``pairs(a, b)``."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = materialize(wanted.join(classes, "id").select("id", F.col("key").alias("__key")), "wanted")
    keys = small_or_not(wanted, BROADCAST_ROWS)
    texts = docs.select(F.xxhash64(docs[f"`{text}`"]).alias("__key"), docs[f"`{text}`"].alias("__t")).join(keys, "__key")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "__t"):
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), lists(*_sets(block.column("__t"), n))], ["id", "s"]
            )

    known = materialize(
        texts.select("id", "__t").mapInArrow(read, "id bigint, s array<bigint>").dropDuplicates(["id"]), "sets"
    )
    discard(wanted)
    return known


def _verified(pairs: DataFrame, known: DataFrame, threshold: Fraction) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets are similar enough."""
    p, q = threshold.numerator, threshold.denominator
    both = pairs.join(known.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(
        known.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"
    )
    shared = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    compared = both.select("a", "b", (F.size("sa") + F.size("sb")).cast("bigint").alias("n"), shared.alias("m"))
    return materialize(compared.where(F.col("m") * q >= (F.col("n") - F.col("m")) * p).select("a", "b"), "links")


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, n: int, threshold: Fraction) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets are similar enough, by the whole sets."""
    pairs = materialize(pairs, "pairs")
    known = _fetched(pairs, classes, docs, text, n)
    links = _verified(pairs, known, threshold)
    discard(pairs, known)
    return links


def _groups(links: DataFrame) -> DataFrame:
    return materialize(components(links).select(F.col("node").alias("id"), F.col("component").alias("grp")), "groups")


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those of ``pairs`` that are not inside one group."""
    def of(c: str) -> DataFrame:
        return groups.select(F.col("id").alias(c), F.col("grp").alias(f"grp_{c}"))

    named = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return named.where(F.coalesce("grp_a", "a") != F.coalesce("grp_b", "b")).select(*pairs.columns)


def _linked_in_rounds(
    candidates: DataFrame, links: DataFrame, classes: DataFrame, docs: DataFrame, text: str, n: int, threshold: Fraction
) -> DataFrame:
    """``links`` and enough of the similar ones among ``candidates(a, b, common)`` to tie all that they tie.

    Per round each class is compared with one other, the one it may have most in common with. Rounds go on while a tenth of what they
    compare is linked, so that groups grow and hold more of the pairs; what is left then is verified in one go.
    """
    open_ = materialize(candidates, "candidates")
    left, turn = open_.count(), 0
    if not left:
        return links
    known = _fetched(open_, classes, docs, text, n)
    while left:
        best = F.struct(F.col("common"), F.xxhash64("a", F.lit(turn)))
        chosen = materialize(open_.groupBy("b").agg(F.max_by("a", best).alias("a")).select("a", "b"), "pairs")
        found = _verified(chosen, known, threshold)
        links = links.union(found)
        rest = materialize(_across(open_.join(chosen, ["a", "b"], "left_anti"), _groups(links)), "candidates")
        fruitful = 10 * found.count() >= chosen.count()
        discard(open_, chosen)
        open_, left, turn = rest, rest.count(), turn + 1
        if not fruitful:
            links = links.union(_verified(open_.select("a", "b"), known, threshold))
            break
    discard(open_, known)
    return links


def _across_groups(held: DataFrame, p: int, q: int, last: bool = False) -> DataFrame:
    """``(e, id, at, size, grp, df, before, lost)`` of what can still tie a class to another group.

    What two sets share before a shared prefix element is in both prefixes; so of the ``at`` elements before it only those count
    that stand in prefixes of several groups, ``before``. Where so many others are lost that the rest is no longer
    similar enough to the whole, an element leads to no link. The last time, ``held`` elements
    of a class are left, and ``bits`` are the parities of the numbers of those with each remainder by 64.
    """
    shared = held.groupBy("e").agg(
        F.count(F.lit(1)).alias("df"), F.min("grp").alias("g0"), F.max("grp").alias("g1")
    ).where("g0 <> g1").select("e", "df")
    by = Window.partitionBy("id")
    ranked = held.select("e", "id", "at", "size", "grp").join(shared, "e").withColumn(
        "before", (F.row_number().over(by.orderBy("at")) - 1).cast("bigint")
    )
    useful = ranked.where((F.col("size") - (F.col("at") - F.col("before"))) * q >= F.col("size") * p)
    useful = useful.withColumn("lost", F.max(F.col("at") - F.col("before")).over(by))
    if last:
        parity = F.bit_xor(F.expr("shiftleft(1L, cast(pmod(e, 64) as int))"))
        useful = useful.withColumns({"held": F.count(F.lit(1)).over(by), "bits": parity.over(by)})
    return materialize(useful, "elements")


def _elements(signed: DataFrame, p: int, q: int) -> DataFrame:
    """Prefix elements that at least two classes share, each class a group of its own."""
    rows = signed.where("size > 0").select("id", "size", F.posexplode("prefix").alias("at", "e"))
    again = rows.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("e")
    # copies of a class are one row from here on
    own = rows.join(again, "e").groupBy("e", "id").agg(F.min("at").alias("at"), F.min("size").alias("size"))
    own = materialize(own.withColumn("grp", F.col("id")), "elements")
    some = _across_groups(own, p, q)
    # where elements were of no use, others are in one class only now
    elements = _across_groups(some, p, q)
    discard(own, some)
    return elements


def _near(x: str, y: str, p: int, q: int) -> Column:
    return (F.col(x) * q >= F.col(y) * p) & (F.col(y) * q >= F.col(x) * p)


def _meetings(elements: DataFrame, p: int, q: int) -> DataFrame:
    """``(a, b, common)``: pairs of classes across groups per element that leads to them; ``common`` is what both prefixes hold at most."""

    def slack(c: str) -> Column:
        return F.col(c) - F.expr(f"({c} * {p} + {q - 1}) div {q}")

    def due(x: str, y: str) -> Column:
        # elements that two sets of these sizes have to share
        return F.expr(f"(({x} + {y}) * {p} + {p + q - 1}) div {p + q}")

    def behind(c: str) -> Column:
        return F.greatest(F.col(c) - (slack(c) + MATCHES), F.lit(0))

    listed = elements.withColumn("base", slack("size") + 1).groupBy("id", "size", "grp", "base", "held", "bits").agg(
        F.sort_array(F.collect_list(F.struct("df", "at", "e", "before")), asc=False).alias("l")
    )

    def plan(matches: int):
        inside = F.filter("l", lambda s: s["at"] < F.col("base") + (matches - 1))
        used = F.slice(inside, matches, F.greatest(F.size(inside), F.lit(1)))
        cost = F.aggregate(used, F.lit(0).cast("bigint"), lambda c, s: c + s["df"])
        # a set has to share so many elements with any other that is linked with it
        fits = F.lit(matches) <= F.greatest(F.expr(f"(size * {p} + {q - 1}) div {q}"), F.lit(1))
        return F.when(fits, F.struct(cost.alias("cost"), F.lit(matches).alias("matches"), used.alias("used")))

    probes = listed.select(
        "id", "size", "grp", "held", "bits", F.array_min(F.array(*[plan(m) for m in range(1, MATCHES + 1)])).alias("p")
    ).select(
        F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("grp").alias("grp_b"), F.col("held").alias("held_b"),
        F.col("bits").alias("bits_b"), F.col("p.matches").alias("l"), F.explode("p.used").alias("u"),
    ).select(
        "b", "size_b", "grp_b", "held_b", "bits_b", "l", F.col("u.e").alias("e"), F.col("u.at").alias("at_b"),
        F.col("u.before").alias("before_b"),
    )
    # the other set is as large or larger, so that the first shared elements of this one stand the earlier
    index = elements.where(F.col("at") < F.col("size") - due("size", "size") + MATCHES).select(
        "e", *[F.col(c).alias("a" if c == "id" else f"{c}_a") for c in ("id", "size", "grp", "at", "before", "held", "bits")]
    )
    enough = due("size_a", "size_b")
    # behind each of the first l shared elements stand so many others that are shared
    early = (F.col("at_a") < F.col("size_a") - enough + F.col("l")) & (F.col("at_b") < F.col("size_b") - enough + F.col("l"))
    # at most so many stand before, at and behind a shared one
    placed = F.least("before_a", "before_b") + F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    apart = F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b")))
    common = F.expr("held_a + held_b") - apart
    return (
        index.join(probes, "e")
        .where("grp_a <> grp_b and (size_a < size_b or (size_a = size_b and a < b))")
        .where(_near("size_a", "size_b", p, q) & early & (placed >= enough))
        .where(common >= 2 * (enough - F.greatest(behind("size_a"), behind("size_b"))))
        .select("a", "b", common.alias("common"))
    )


def link_groups(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, n: int = 5,
    threshold: Fraction = Fraction(4, 5), name: str = "doc_id",
) -> DataFrame:
    """Add ``n_shingles``, ``component_id``, ``grp`` (a number of the component) and ``key`` (a hash of the text).

    Words are whatever stands between blanks, A-Z as a-z; a set holds the distinct runs of ``n`` words,
    or the whole sequence if it is shorter. Rows are linked if shared / united >= ``threshold``; a
    component is named by the least ``name`` that links lead to (null if there is none but null). Null and
    empty texts, and texts without words, have empty sets and are linked with nothing. Equal texts
    and repeated rows are linked. Sets are told apart by 64-bit hashes. ``keep`` names the columns that
    stay besides ``name`` (default: all). A row with an empty set has a null ``grp``.
    """
    added = ["n_shingles", "component_id", "grp", "key"]
    keep = [c for c in dict.fromkeys([name, *(docs.columns if keep is None else keep)]) if c not in added]
    inner = {c: f"c{i}" for i, c in enumerate(keep)}
    renamed = docs.select(
        *[docs[f"`{c}`"].alias(i) for c, i in inner.items()], docs[f"`{text}`"].alias("__text")
    )
    signed = signatures(renamed, "__text", list(inner.values()), n, threshold)
    label = inner[name]
    classes = materialize(
        signed.where("size > 0").groupBy("id").agg(
            F.min("key").alias("key"), F.min("size").alias("size"), F.min(label).alias("least")
        ),
        "classes",
    )
    p, q = threshold.numerator, threshold.denominator
    elements = _elements(signed, p, q)

    # first, some rounds of each class with one class per element, where they share most of them; another one each
    # round, and only where elements are still shared across groups
    links = None
    for turn in range(ROUNDS):
        # the first is the one that has least of its own: near copies with changes in different places are nearest to it
        order = F.struct(F.lit(0) if turn else F.col("lost"), F.xxhash64("id", F.lit(turn)))
        firsts = elements.groupBy("e").agg(F.min_by("id", order).alias("a"))
        held = elements.groupBy("id").agg(F.count(F.lit(1)).alias("held"))
        known = classes.select(F.col("id").alias("a"), F.col("size").alias("other"))
        if links is None:
            known = known.withColumn("other_grp", F.col("a"))
        else:
            known = known.join(groups.withColumnsRenamed({"id": "a", "grp": "other_grp"}), "a", "left")
        stars = (
            elements.select("e", "id", "size", "grp").join(firsts, "e").where("a <> id").groupBy("a", "id").agg(
                F.count(F.lit(1)).alias("m"), F.min("size").alias("size"), F.min("grp").alias("grp")
            )
            .join(held, "id").where("2 * m >= held")
            .join(known, "a")
            .where(_near("size", "other", p, q) & (F.col("grp") != F.coalesce("other_grp", "a")))
            .select("a", F.col("id").alias("b"))
        )
        found = _linked(stars, classes, renamed, "__text", n, threshold)
        links = found if links is None else links.union(found)
        groups = _groups(links)
        grouped = elements.drop("grp").join(groups, "id", "left").withColumn("grp", F.coalesce("grp", "id"))
        before, elements = elements, _across_groups(grouped, p, q, turn + 1 == ROUNDS)
        discard(before)

    # then all pairs across groups
    candidates = _meetings(elements, p, q).groupBy("a", "b").agg(F.max("common").alias("common"))
    links = _linked_in_rounds(candidates, links, classes, renamed, "__text", n, threshold)
    discard(elements)
    united = components(links)
    tied = classes.join(united.withColumnRenamed("node", "id"), "id")
    least = tied.groupBy("component").agg(F.min("least").alias("named"))
    named = tied.select("id", "component").join(least, "component").select("id", "named", "component")
    result = classes.join(named, "id", "left").select(
        F.col("id").alias("__id"), F.coalesce("named", "least").alias("named"), F.coalesce("component", "id").alias("grp")
    )
    columns = [F.col(i).alias(c) for c, i in inner.items()]
    counted = F.col("size").alias("n_shingles")
    alone = signed.where("size = 0").select(
        *columns, counted, F.col(label).alias("component_id"), F.lit(None).cast("bigint").alias("grp"), "key"
    )
    return signed.where("size > 0").join(result, F.col("id") == F.col("__id")).select(
        *columns, counted, F.col("named").alias("component_id"), "grp", "key"
    ).unionByName(alone)


def one_of_each(docs: DataFrame, text: str = "text", name: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the least ``name``.

    Null names come last, ties go by a hash of the text, and of repeated rows one stays. Rows with empty sets all
    stay. ``how`` is passed on to ``link_groups``.
    """
    blank = docs[f"`{text}`"].isNull() | ~F.rlike(docs[f"`{text}`"], F.lit(r"[^\x20\x09-\x0D]"))
    some = docs.where(~blank)
    found = link_groups(docs, text, [name], name=name, **how).where("n_shingles > 0")
    first = F.min(F.struct(F.col(name).isNull().alias("no"), F.col(name).alias("name"), "key"))
    found = materialize(found, "grouped")
    firsts = found.groupBy("grp").agg(first.alias("s"))
    rows = found.groupBy(F.col(name).alias("__name"), F.col("key").alias("__key"), "grp").agg(F.count(F.lit(1)).alias("n"))
    judged = rows.join(firsts, "grp").withColumn(
        "stays", F.col("__name").eqNullSafe(F.col("s.name")) & (F.col("__key") == F.col("s.key"))
    )
    # a row goes unless it is the first of its group; repeated first rows are looked at by themselves
    going = materialize(judged.where("not stays or n > 1").select("__name", "__key", "stays"), "going")
    keyed = some.withColumn("__own", F.xxhash64(some[f"`{text}`"]))
    same = F.col(name).eqNullSafe(F.col("__name")) & (F.col("__own") == F.col("__key"))
    once = keyed.join(small_or_not(going), same, "left_anti")
    again = keyed.join(small_or_not(going.where("stays")), same, "left_semi").dropDuplicates([name, "__own"])
    return once.unionByName(again).drop("__own").unionByName(docs.where(blank))


