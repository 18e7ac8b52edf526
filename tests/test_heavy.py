"""Summaries of frequent values, daily records, and statistics in two scans."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ctrflow.operators import dailystats as daily
from ctrflow.operators import heavy
from ctrflow.operators import statistics as st


def zipf(spark, n, distinct, seed, parts=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = "hot" if rng.random() < 0.3 else f"v{int(distinct * rng.random() ** 3)}"
        rows.append((i, None if rng.random() < 0.05 else a, f"u{i}", i % 5 if rng.random() < 0.9 else None))
    return spark.createDataFrame(rows, "id int, a string, b string, day int").repartition(parts)


def counts(df, c):
    return collections.Counter({r[0]: r[1] for r in df.where(F.col(c).isNotNull()).groupBy(c).count().collect()})


def test_a_summary_is_never_too_low_by_more_than_it_took_off():
    rng = np.random.default_rng(2)
    values = [str(v) for v in np.minimum(rng.zipf(1.3, 20_000), 5000)]
    exact = collections.Counter(values)
    for size in (5, 50, 10_000):
        summary = heavy._Summary(size)
        for i in range(0, len(values), 700):
            summary.add(*heavy._counted(pa.array(values[i : i + 700])))
        held = dict(zip(summary.values.to_pylist(), summary.counts.tolist()))
        assert len(held) <= size and summary.off <= len(values) / (size + 1)
        assert all(held.get(v, 0) <= n <= held.get(v, 0) + summary.off for v, n in exact.items())


def test_frequent_values_are_all_found(spark):
    df = zipf(spark, 6000, 2000, 3)
    exact = counts(df, "a")
    found = {r.value: r["count"] for r in heavy.frequent_values(df, ["a", "b"], 0.01, size=400).collect()}
    assert {v for v, n in exact.items() if n >= 60} <= set(found) and len(found) <= 200
    assert all(found[v] <= exact[v] for v in found)
    with pytest.raises(ValueError):
        heavy.frequent_values(df, ["a"], 0.001, size=400)


@pytest.mark.parametrize("size", [30, 300, 10_000])
def test_top_values_in_two_scans(spark, size):
    df = zipf(spark, 6000, 800, 4)
    found, undecided = heavy.top_values_in_two_scans(df, ["a", "b"], 15, size)
    got = sorted(map(tuple, found.select("feature", "value", "count", "rank").collect()))
    decided = [c for c in ("a", "b") if c not in undecided]
    want = sorted(map(tuple, st.top_values(df, decided, 15).select("feature", "value", "count", "rank").collect())) if decided else []
    assert got == want
    # every value of b stands once, so only a summary of all of them decides
    assert ("b" in undecided) == (size < 10_000) and (size > 30) == ("a" not in undecided)


def test_two_scans_of_nothing(spark):
    df = zipf(spark, 10, 5, 1)
    found, undecided = heavy.top_values_in_two_scans(df.where("id < 0"), ["a"], 5)
    assert found.count() == 0 and undecided == []
    assert heavy.frequent_values(df.where("id < 0"), ["a"], 0.5).count() == 0


def numbers(spark, n=3000, seed=5):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice([None, float("nan"), rng.gauss(0, 3), 0.0, -0.0]), rng.randrange(-5, 50) if rng.random() < 0.9 else None,
         rng.choice(["x", "yy", "é", None]), rng.randrange(7))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id int, f double, i int, s string, day int").repartition(5)


def test_days_merge_to_the_same_as_one_go(spark, tmp):
    df = numbers(spark)
    daily.save_days(daily.daily_records(df.where("day < 3"), ["f", "i", "s"]), tmp + "/days")
    daily.save_days(daily.daily_records(df.where("day >= 2"), ["f", "i", "s"]), tmp + "/days")  # day 2 is replaced
    for first, last in ((None, None), (1, 4), (6, 6)):
        span = df.where(F.col("day").between(first if first is not None else 0, last if last is not None else 6))
        record = daily.merge_days(daily.load_days(spark, tmp + "/days", first, last))
        got = {r.feature: r for r in daily.describe(record).collect()}
        want = {r.feature: r for r in st.feature_stats(span, ["f", "i", "s"]).collect()}
        n = span.count()
        for c in ("f", "i"):
            g, w = got[c], want[c]
            assert (g.n_rows, g.n_present, g.min, g.max, g.zeros) == (n, w.n_present, w.num.min, w.num.max, w.num.zeros)
            assert g.mean == pytest.approx(w.num.mean) and g.std == pytest.approx(w.num["std"])
            values = sorted(v for v in (r[0] for r in span.select(c).collect()) if v is not None and v == v)
            for p, q in zip((0, 0.25, 0.5, 0.75, 1), g.quantiles):
                slack = daily.RANK_ERROR * len(values) + 1
                assert sum(v < q for v in values) <= p * len(values) + slack
                assert sum(v <= q for v in values) >= p * len(values) - slack
        assert got["s"].n_unique == 3 and got["s"].avg_len == pytest.approx(want["s"]["str"].avg_len)
        top = daily.frequent(record, 5).collect()
        exact = counts(span, "s")
        assert {r.value: (r.low, r.high) for r in top} == {v: (k, k) for v, k in exact.items()}


def test_merged_days_can_be_merged_again(spark):
    records = daily.daily_records(numbers(spark), ["f", "i", "s"])
    weeks = records.withColumn("half", F.col("day") > 3)
    twice = daily.merge_days(daily.merge_days(weeks, "half"))
    once = daily.merge_days(records)

    def told(record):
        return {r.feature: (r.n_rows, r.n_present, r.min, r.max, r.zeros, r.n_unique) for r in daily.describe(record).collect()}

    assert told(twice) == told(once)
    assert sorted(map(tuple, daily.frequent(twice).collect())) == sorted(map(tuple, daily.frequent(once).collect()))


def test_records_of_days_without_values(spark):
    df = numbers(spark).withColumns({"f": F.lit(None).cast("double"), "s": F.lit(None).cast("string")})
    got = {r.feature: r for r in daily.describe(daily.merge_days(daily.daily_records(df, ["f", "s"]))).collect()}
    assert (got["f"].n_present, got["f"].mean, got["f"].quantiles) == (0, None, None)
    assert (got["s"].n_present, got["s"].avg_len) == (0, None)
    assert daily.merge_days(daily.daily_records(df.where("id < 0"), ["f", "s"])).count() == 0



def leaves(value):
    """The single values of a nested row."""
    if isinstance(value, (list, tuple)):
        for v in value:
            yield from leaves(v)
    else:
        yield value


def test_statistics_by_side_equal_each_side_alone(spark):
    df = numbers(spark).withColumn("side", F.when(F.col("day") < 4, "ref").when(F.col("day") < 6, "new"))
    both = st.feature_stats(df, ["f", "i", "s"], by="side")
    assert both.columns[0] == "side"
    for side in ("ref", "new", None):
        mine = df.where(F.col("side").eqNullSafe(F.lit(side)))
        want = st.feature_stats(mine, ["f", "i", "s"])
        got = both.where(F.col("side").eqNullSafe(F.lit(side))).drop("side").select(*want.columns)
        for g, w in zip(*(sorted(df.collect(), key=lambda r: r.feature) for df in (got, want)), strict=True):
            flat = [list(leaves(r)) for r in (g, w)]
            assert len(flat[0]) == len(flat[1]) > 5
            assert all(a == b or a == pytest.approx(b, rel=1e-12) for a, b in zip(*flat))


def test_statistics_read_their_input_twice(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches

    base = numbers(spark, 15_000)  # so many that a bracket is wider than a rank
    df = base.mapInArrow(seen, base.schema)
    parts = df.rdd.getNumPartitions()
    st.feature_stats(df, ["f", "i", "s", "id"]).collect()
    assert reads.value == 2 * parts
    st.presence_and_values(df, ["f", "i", "s"])
    assert reads.value == 3 * parts


def test_presence_and_values_in_one_scan(spark):
    df = numbers(spark)
    common, values = st.presence_and_values(df, ["f", "i", "s"])
    want = {r.feature: (r.n_rows, r.n_present, r.n_missing, r.presence) for r in st.stats_common(df, ["f", "i", "s"]).collect()}
    assert {r.feature: (r.n_rows, r.n_present, r.n_missing, r.presence) for r in common.collect()} == want
    assert {r.feature: r.type for r in common.collect()} == {"f": "numeric", "i": "numeric", "s": "string"}
    assert sorted(map(tuple, values.collect())) == sorted(map(tuple, st.string_counts(df, ["s"]).collect()))
