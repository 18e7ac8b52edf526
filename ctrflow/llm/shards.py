"""Shards of even size that keep linked documents together, by balanced label propagation.

Each round, every linked document wants the shard that holds most of its neighbours. How
much weight wants to go from shard to shard, by gain, is summed; a plan on the driver (shards x shards x
gain classes numbers) grants moves by gain while the target has room. Documents without links are ballast: they
fill what is left. At the end the documents are numbered by label, linked ones in the middle of each label's
stretch, and the numbers are cut evenly, so that what the cut shifts is ballast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.frames import shielded
from ctrflow.operators.order import dense_seq
from ctrflow.scratch import local_table, materialize

#: Gains are put into classes by powers of two.
CLASSES = 40


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)


def propagate(links: DataFrame, total: int, shards: int, rounds: int = 5) -> DataFrame:
    """A shard for each linked node: ``(node, first, label)``, first being its least hub.

    ``links`` has rows ``(node, hub)``: nodes of a hub are each other's neighbours. ``total`` is the number of
    nodes, linked or not; a shard takes total / shards linked nodes at most. Hubs may be of any size: what is
    joined is one row per hub with its count per shard.
    """
    spark = links.sparkSession
    room = max(1, total // shards)
    start = links.groupBy("node").agg(F.min("hub").alias("first"))
    labels = materialize(
        start.withColumn("label", F.floor(_unit(F.col("node"), F.lit(1)) * shards).cast("int")),
        "labels",
    )
    for turn in range(rounds):
        load = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
        # a full shard takes nobody, so what is left of a group looks for the next best
        taking = F.col("to").isin([s for s in range(shards) if load.get(s, 0) < room] or [-1])
        placed = links.join(labels, "node")
        cells = placed.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))
        per_hub = cells.groupBy("hub").agg(F.collect_list(F.struct("label", "n")).alias("cells"))
        votes = (
            links.join(per_hub, "hub")
            .select("node", F.inline("cells"))
            .groupBy("node", "label")
            .agg(F.sum("n").alias("votes"))
        )
        # of equally good shards, the one a hash of the first hub prefers, so that its nodes agree
        ranked = votes.withColumnRenamed("label", "to").join(labels, "node").where(
            taking | (F.col("to") == F.col("label"))
        ).groupBy("node", "first", "label").agg(
            F.max(F.struct("votes", _unit(F.col("first"), F.col("to")).alias("tie"), "to")).alias("best"),
            F.max(F.when(F.col("to") == F.col("label"), F.col("votes"))).alias("here"),
        )
        wish = materialize(
            ranked.select(
                "node", "first", "label", F.col("best.to").alias("to"),
                F.when(
                    F.col("best.to") != F.col("label"),
                    F.floor(F.log2(F.col("best.votes") - F.coalesce("here", F.lit(0)) + 2)),
                ).cast("int").alias("gain"),
                (F.col("best.votes") > room / 8).alias("large"),
            ),
            "wishes",
        )
        asked = wish.where("gain is not null").groupBy("label", "to", "gain").count().collect()
        granted = _grant(asked, load, room, shards)
        plan = local_table(spark, "__l int, __t int, __g int, share double", granted)
        moved = wish.join(
            F.broadcast(plan),
            (F.col("label") == F.col("__l")) & (F.col("to") == F.col("__t")) & (F.col("gain") == F.col("__g")),
            "left",
        )
        # the nodes of a small hub move together or not at all
        draw = F.when(F.col("large"), _unit(F.col("node"), F.lit(turn))).otherwise(_unit(F.col("first"), F.lit(turn)))
        labels = materialize(
            moved.select(
                "node", "first",
                F.when(draw < F.coalesce("share", F.lit(0.0)), F.col("to")).otherwise(F.col("label")).alias("label"),
            ),
            "labels",
        )
        if not asked:
            break
    return labels


def _grant(asked: list, load: dict[int, int], room: int, shards: int) -> list[tuple[int, int, int, float]]:
    """Shares of the wished moves that may happen, highest gains first, under each target's room."""
    free = {t: room - load.get(t, 0) for t in range(shards)}
    # what leaves a shard makes room there, as far as its target takes it: count half of it
    for s, _, _, n in asked:
        free[s] += n // 2
    out = []
    for s, t, g, n in sorted(asked, key=lambda r: (-r[2], r[0], r[1])):
        share = min(1.0, max(0, free[t]) / n)
        free[t] -= int(share * n)
        out.append((s, t, g, share))
    return out


def assign(rows: DataFrame, shards: int, rounds: int = 5, node: str = "node", hub: str = "hub") -> DataFrame:
    """Add ``shard`` and ``slot`` to each row of ``rows``; shard sizes are at most one row apart.

    ``node`` is unique; rows with equal non-null ``hub`` are linked. Slots count from 0 in each shard.
    """
    spark = rows.sparkSession
    total = rows.count()
    if total == 0:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    shared = rows.where(F.col(hub).isNotNull()).groupBy(hub).count().where("count > 1").select(hub)
    links = materialize(rows.join(shared, hub).select(F.col(node).alias("node"), F.col(hub).alias("hub")), "links")
    labels = propagate(links, total, shards, rounds)
    load = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    lack = [max(0.0, total / shards - load.get(s, 0)) for s in range(shards)]
    # ballast goes where room is left, by a hash: a case for each shard but the last
    ends = [sum(lack[: s + 1]) / max(sum(lack), 1e-9) for s in range(shards - 1)]
    by = labels.select(F.col("node").alias("__labelled"), "first", "label")
    mixed = rows.join(by, F.col(node) == F.col("__labelled"), "left")
    draw, half = _unit(F.col(node), F.lit(99)), _unit(F.col(node), F.lit(5))
    ballast = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        ballast = F.when(draw < ends[s], s).otherwise(ballast)
    linked = F.col("label").isNotNull()
    spread = mixed.withColumns({
        "__label": F.when(linked, F.col("label")).otherwise(ballast),
        "__zone": F.when(linked, 1).when(half < 0.5, 0).otherwise(2),
    })
    numbered = dense_seq(
        spread.select(*rows.columns, "__label", "__zone", F.coalesce("first", F.lit("")).alias("__first")),
        ["__label", "__zone", "__first", node], name="__seq", start=0, unique=True,
    )
    shard = F.expr(f"(__seq * {shards}) div {total}")
    begin = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", shard.cast("int")).withColumn(
        "slot", F.col("__seq") - begin
    ).select(*rows.columns, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 24, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Put every row into a shard: adds ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the UTF-8 length of the text plus 8, ``text_crc32`` its unsigned CRC-32. Rows of equal text
    are linked, null texts with nothing (size 8, CRC 0). Shards hold equally many rows, at most one apart;
    repeated rows are rows of their own. ``keep`` names the columns that stay (default: all).
    """
    added = ["size", "text_crc32", "shard", "slot"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    docs, names, own = shielded(docs, keep, text)
    source = F.coalesce("__t", F.lit(""))
    rows = materialize(
        docs.select(
            *names,
            (F.octet_length(source) + 8).cast("bigint").alias("size"),
            F.crc32(source.cast("binary")).alias("text_crc32"),
            F.sha2("__t", 256).alias("__hub"),
            F.monotonically_increasing_id().alias("__node"),
        ),
        "rows",
    )
    return assign(rows, shards, node="__node", hub="__hub").select(*own, *added)
