import random
import statistics as pystats

import pytest
from naive import js, quantile
from pyspark.sql import functions as F

from ctrflow.operators import drift
from ctrflow.operators import statistics as st
from ctrflow.operators import validation as val


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(8)
    return [
        (i, rng.choice([None, float("nan"), 0.0, -0.0, 7.0, rng.gauss(5, 2)]), 3, rng.choice(["a", "b", "ccc", None]))
        for i in range(900)
    ]


@pytest.fixture(scope="module")
def frame(spark, numbers):
    return spark.createDataFrame(numbers, "id int, x double, same int, s string").repartition(6)


def present(numbers):
    return [r[1] for r in numbers if r[1] is not None and r[1] == r[1]]


def test_scalars(frame, numbers):
    xs = present(numbers)
    got = st.stats_numeric(frame, ["x", "same"]).where("feature = 'x'").first()
    assert (got.min, got.max, got.zeros) == (min(xs), max(xs), sum(x == 0 for x in xs))
    assert got.mean == pytest.approx(sum(xs) / len(xs))
    assert got.std == pytest.approx(pystats.pstdev(xs))
    assert got.median == pytest.approx(pystats.median(xs))
    common = st.stats_common(frame, ["x"]).first()
    assert (common.n_rows, common.n_present, common.n_missing) == (900, len(xs), 900 - len(xs))


def test_quantiles_are_exact(frame, numbers):
    xs = present(numbers)
    got = {r.q: r.value for r in st.quantiles(frame, ["x"], 10).collect()}
    assert got == {q: pytest.approx(quantile(xs, q / 10)) for q in range(11)}


def test_quantiles_by_sketch_are_close(frame, numbers):
    xs = sorted(present(numbers))
    got = {r.q: r.value for r in st.quantiles(frame, ["x"], 4, sketch=True).collect()}
    assert got[0] == xs[0] and got[4] == xs[-1] and got[2] in xs


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "v double")
    got = st.histogram(df, ["v"], 10).orderBy("bin").collect()
    assert [r["count"] for r in got] == [10] * 9 + [11]  # the last bin is closed
    assert (got[0].lo, got[0].hi, got[9].hi) == (0.0, 10.0, 100.0)


def test_quantiles_of_a_skewed_feature(spark):
    # a third of the rows is one value, the rest spread over far more values than a sketch keeps
    df = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("x")
    )
    xs = [r.x for r in df.collect()]
    got = {r.q: r.value for r in st.quantiles(df, ["x"], 20).collect()}
    assert got == {q: pytest.approx(quantile(xs, q / 20), abs=1e-12) for q in range(21)}


def test_a_missed_bracket_is_made_good(spark, numbers, frame, monkeypatch):
    xs = sorted(present(numbers))
    real = st._sketch

    def wrong(df, columns, probs):
        return {f: (n, [xs[-1] + 1.0 for _ in v]) for f, (n, v) in real(df, columns, probs).items()}

    monkeypatch.setattr(st, "_sketch", wrong)
    got = {r.q: r.value for r in st.quantiles(frame, ["x"], 4).collect()}
    assert got == {q: pytest.approx(quantile(xs, q / 4)) for q in range(5)}


def test_constant_and_empty_features(spark, frame):
    assert st.histogram(frame, ["same"]).collect() == [("same", 0, 3.0, 3.0, 900)]
    nothing = frame.withColumn("x", F.lit(None).cast("double"))
    assert st.histogram(nothing, ["x"]).count() == 0
    assert st.quantiles(nothing, ["x"], 4).count() == 0
    record = st.feature_stats(nothing, ["x", "s"])
    assert record.where("feature = 'x'").first().num.mean is None
    assert st.feature_stats(frame.where("id < 0"), ["x", "s"]).where("n_rows = 0").count() == 2


def test_strings(frame, numbers):
    values = [r[3] for r in numbers if r[3] is not None]
    got = st.string_stats(frame, ["s"]).first()
    assert got.n_unique == 3 and got.avg_len == pytest.approx(sum(map(len, values)) / len(values))
    top = st.top_values(frame, ["s"], 2).orderBy("rank").collect()
    want = sorted({v: values.count(v) for v in values}.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert [(r.value, r["count"]) for r in top] == want


def test_long_rank_histograms_are_exact(spark):
    df = spark.range(5000, numPartitions=6).select(F.pmod(F.xxhash64("id"), F.lit(700)).cast("string").alias("s"))
    counts = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:300]
    got = st.rank_histogram(df, ["s"], 300).orderBy("rank").collect()
    assert [(r.value, r["count"]) for r in got] == want


def test_record_survives_saving(spark, frame, tmp):
    record = st.feature_stats(frame, ["x", "same", "s"])
    st.save_stats(record, f"{tmp}/stats")
    again = st.load_stats(spark, f"{tmp}/stats").orderBy("feature").collect()
    assert again == record.orderBy("feature").collect()
    assert [r.feature for r in again] == ["s", "same", "x"]


# --- drift ------------------------------------------------------------------------------------


def two(spark, left, right):
    return (spark.createDataFrame([(float(v),) for v in side], "v double") for side in (left, right))


def value(df):
    return df.first().value


def test_divergence(spark):
    rng = random.Random(2)
    left, right = [rng.random() for _ in range(400)], [rng.random() ** 2 * 1.2 for _ in range(300)]
    a, b = two(spark, left, right)
    lo, hi = min(left + right), max(left + right)

    def bins(xs):
        out = [0] * 10
        for x in xs:
            out[min(9, int((x - lo) / (hi - lo) * 10))] += 1
        return out

    want = js(bins(left), bins(right))
    assert value(drift.js_divergence(a, b, ["v"])) == pytest.approx(want, abs=1e-12)
    assert value(drift.js_divergence(b, a, ["v"])) == pytest.approx(want, abs=1e-12)
    assert value(drift.js_divergence(a, a, ["v"])) == 0
    c, d = two(spark, [0] * 5, [1] * 5)
    assert value(drift.js_divergence(c, d, ["v"])) == 1


def saved(spark, rows):
    return spark.createDataFrame(rows, "feature string, lo double, hi double, count bigint")


def test_rebinning_spreads_bins_evenly(spark):
    ref = saved(spark, [("v", 0.0, 10.0, 100)])
    new = saved(spark, [("v", 5.0, 10.0, 30), ("v", 10.0, 15.0, 30)])
    got = {(r.c_lo, r.c_hi): (r.n_ref, r.n_new) for r in drift.rebin(ref, new).collect()}
    assert got == {(0, 5): (50, 0), (5, 10): (50, 30), (10, 15): (0, 30)}


@pytest.mark.parametrize(
    "left, right, want", [(5, 5, 0.0), (5, 6, 1.0), (6, 5, 1.0)]
)
def test_rebinning_of_constant_features(spark, left, right, want):
    ref, new = (saved(spark, [("v", float(x), float(x), 9)]) for x in (left, right))
    assert value(drift._divergence(drift.rebin(ref, new))) == want


def test_divergence_of_saved_statistics(spark):
    rng = random.Random(6)
    rows = [rng.random() for _ in range(500)]
    a, b = two(spark, rows, [x + 0.2 for x in rows])
    s, t = st.feature_stats(a, ["v"]), st.feature_stats(b, ["v"])
    assert value(drift.js_from_stats(s, s)) == pytest.approx(0, abs=1e-12)
    assert 0 < value(drift.js_from_stats(s, t)) < 1
    assert value(drift.js_from_stats(s, t)) == pytest.approx(value(drift.js_from_stats(t, s)))


def test_equality_with_the_threshold_is_drift(spark):
    found = spark.createDataFrame([("a", 0.06), ("b", 0.059), ("c", 0.9)], "feature string, value double")
    schema = spark.createDataFrame(
        [("a", 0.06), ("b", 0.06), ("c", None)], "feature string, jsd_threshold double"
    )
    report = {r.feature: r.drift for r in drift.drift_report(found, schema).collect()}
    assert report == {"a": True, "b": False}


# --- schema -------------------------------------------------------------------------------------


def test_schema_and_anomalies(spark, frame):
    def stats(df, cols):
        return st.feature_stats(df, cols).select("feature", "type", "presence")

    counts = st.string_counts(frame, ["s"])
    domain = val.infer_domain(counts)
    schema = val.with_threshold(val.infer_schema(stats(frame, ["x", "same", "s"])), "x", 0.06)
    rows = {r.feature: r for r in val.listed_domain(schema, domain).collect()}
    assert rows["s"].domain == ["a", "b", "ccc"] and rows["x"].domain is None
    assert rows["x"].jsd_threshold == 0.06 and rows["same"].jsd_threshold is None
    assert val.validate(stats(frame, ["x", "same", "s"]), schema, counts, domain).count() == 0

    new = frame.withColumn("s", F.when(F.col("id") == 5, "zzz").otherwise(F.col("s"))).withColumn(
        "x", F.when(F.col("id") > 100, F.col("x"))
    ).withColumn("same", F.col("same").cast("string")).withColumn("more", F.lit(1))
    found = val.validate(stats(new, ["x", "same", "s", "more"]), schema, st.string_counts(new, ["s"]), domain)
    assert {tuple(r) for r in found.collect()} >= {
        ("x", "presence_low"), ("same", "type_changed"), ("more", "new_column"), ("s", "out_of_domain"),
    }
    gone = val.validate(stats(frame, ["x"]), schema)
    assert {tuple(r) for r in gone.collect()} == {("same", "column_missing"), ("s", "column_missing")}


def test_wide_domains_are_not_listed(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("s"))
    counts = st.string_counts(df, ["s"])
    schema = val.infer_schema(st.stats_common(df, ["s"]).withColumn("type", F.lit("string")))
    domain = val.infer_domain(counts)
    assert val.listed_domain(schema, domain).first().domain is None
    # but they are checked
    new = st.string_counts(df.union(spark.createDataFrame([("odd",), ("odd",)], "s string")), ["s"])
    assert [tuple(r) for r in val.out_of_domain(new, domain).collect()] == [("s", 1, 2)]


def test_infinite_values_go_to_the_outer_bins(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("-inf"),), (None,)], "x double")
    rows = st.histogram(df, ["x"], 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 0, 0, 2]
    assert rows[0].lo == 1.0 and rows[-1].hi == 2.0
