import random

import pytest
from pyspark.sql import functions as F

from ctrflow.operators import order
from ctrflow.operators.columns import with_batch


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    # key "hot" holds most rows, "b" a few, None some
    return [
        (i, rng.choice(["hot"] * 6 + ["b", "c", None]), rng.randrange(50), rng.choice([None, rng.random()]))
        for i in range(3000)
    ]


def frame(spark, rows, parts=7):
    return spark.createDataFrame(rows, "id bigint, k string, t int, v double").repartition(parts)


def test_dense_seq_is_the_global_row_number(spark, rows):
    got = order.dense_seq(frame(spark, rows), ["t", "id"], unique=True).select("id", "seq").collect()
    want = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1)}
    assert {r.id: r.seq for r in got} == want


def test_dense_seq_spreads_copies_over_slices(spark):
    copies = spark.range(20000, numPartitions=8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    sliced = order.slice_in_order(copies, ["a"])
    assert sliced.select(order.SLICE).distinct().count() > 1
    seq = order.dense_seq(copies, ["a"])
    assert seq.agg(F.count_distinct("seq"), F.min("seq"), F.max("seq")).first() == (20000, 1, 20000)


def test_dense_seq_of_nothing(spark, rows):
    assert order.dense_seq(frame(spark, rows).where("id < 0"), ["t"]).count() == 0


def test_running_sums_within_a_skewed_key(spark, rows):
    got = order.running_sums(
        frame(spark, rows), ["t", "id"], {"n": F.lit(1), "s": F.col("t")}, key=["k"], unique=True
    )
    want, n, s = {}, {}, {}
    for i, k, t, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        n[k], s[k] = n.get(k, 0) + 1, s.get(k, 0) + t
        want[i] = (n[k], s[k])
    assert {r.id: (r.n, r.s) for r in got.collect()} == want


@pytest.mark.parametrize("key", [[], ["k"]])
def test_carry_last(spark, rows, key):
    got = order.carry_last(frame(spark, rows), "v", ["t", "id"], key, init=-1.0, unique=True)
    want, last = {}, {}
    for i, k, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        group = k if key else ""
        last[group] = last.get(group, -1.0) if v is None else v
        want[i] = last[group]
    assert {r.id: r.carried for r in got.collect()} == want


def test_carry_has_one_row_per_slice_at_most(spark, rows):
    sliced = order.slice_in_order(frame(spark, rows), ["k", "t", "id"], unique=True)
    spans = sliced.select(order.SLICE, "k").distinct().groupBy("k").count()
    continued = sum(r["count"] - 1 for r in spans.collect())
    assert continued <= sliced.select(order.SLICE).distinct().count()


def test_pick_ranks(spark, rows):
    counts = frame(spark, rows).where("k is not null").groupBy("k", "t").agg(F.count("*").alias("n"))
    sliced = order.slice_in_order(counts, ["k", "t"], unique=True)
    by_key = {}
    for _, k, t, _ in rows:
        if k is not None:
            by_key.setdefault(k, []).append(t)
    ranks = {k: {0, 5, len(ts) // 2, len(ts) - 1} for k, ts in by_key.items()}
    found = order.pick_ranks(sliced, "t", "n", "k", ranks)
    assert {(r.k, r.rank): r.value for r in found.collect()} == {
        (k, r): sorted(by_key[k])[r] for k, rs in ranks.items() for r in rs
    }


def test_batches_are_consecutive(spark, rows):
    got = with_batch(frame(spark, rows), 64, ["id"]).select("id", "batch").collect()
    assert all(r.batch == r.id // 64 for r in got)
