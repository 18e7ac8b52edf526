import random

import pytest
from pyspark.sql import functions as F

from ctrflow.operators.transforms import (
    Categorify, Clip, FillMissing, HashBucket, LambdaOp, LogOp, Normalize, Rename,
)
from ctrflow.operators.vocab import LookupLimits, broadcastable
from ctrflow.operators.workflow import FittedWorkflow, Workflow
from ctrflow.scratch import materialize


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(4)
    rows = [
        (i, rng.choice([None, float("nan"), -3.0, 2.0, 9.5]),
         rng.choice(["hot"] * 10 + [None, "", "b"] + [f"v{j}" for j in range(200)]),
         rng.choice([None, 10, 9, 100]), rng.randrange(2))
        for i in range(2000)
    ]
    return spark.createDataFrame(rows, "id int, x double, c string, d int, label int").repartition(5)


def test_fill_and_clip(spark, train):
    fitted = FittedWorkflow((["x"] >> FillMissing() >> Clip(min_value=0)).branches)
    assert {r.x for r in fitted.transform(train).distinct().collect()} == {0.0, 2.0, 9.5}


def test_clip_keeps_nulls(spark, train):
    fitted = FittedWorkflow((["x"] >> Clip(0.0, 5.0)).branches)
    assert fitted.transform(train.where("x is null")).where("x is not null").count() == 0


def test_normalized_training_rows_have_mean_0_and_std_1(spark, train):
    fitted = Workflow(["x"] >> FillMissing() >> Clip(min_value=0) >> Normalize()).fit(train)
    mean, std = fitted.transform(train).agg(F.avg("x"), F.stddev_samp("x")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)


def test_a_constant_column_is_only_centred(spark, train):
    rows = train.withColumn("x", F.lit(4.0))
    fitted = Workflow(["x"] >> Normalize()).fit(rows)
    assert fitted.transform(rows).distinct().collect() == [(0.0,)]


def test_one_row_has_no_deviation(spark, train):
    rows = train.where("x = 2.0").limit(1)
    assert Workflow(["x"] >> Normalize()).fit(rows).transform(rows).first().x == 0.0


@pytest.mark.parametrize("order", ["value", "freq"])
def test_codes_are_dense_and_ordered(spark, train, order):
    fitted = Workflow(["c", "d"] >> Categorify(order)).fit(train)
    for name in ("c", "d"):
        key = "value_int" if name == "d" else "value"
        rows = fitted.vocab.where(F.col("column") == name).collect()
        ranked = sorted(rows, key=lambda r: (0 if order == "value" else -r.freq, r[key]))
        assert [r.code for r in ranked] == list(range(1, len(rows) + 1))
    assert [r.value_int for r in fitted.vocab.where("column = 'd'").orderBy("value_int").collect()] == [9, 10, 100]


def test_null_and_unseen_are_0_and_no_row_is_lost(spark, train):
    fitted = Workflow(["c", "d"] >> Categorify()).fit(train)
    new = spark.createDataFrame(
        [(1, "hot", 9), (2, None, None), (3, "never", 8), (4, "", 100)], "id int, c string, d int"
    )
    got = {r.id: (r.c, r.d) for r in fitted.transform(new, ["id"]).collect()}
    assert got[2] == (0, 0) and got[3] == (0, 0)
    assert got[4] == (1, 3) and got[1][0] > 0 and got[1][1] == 1


def test_shuffled_lookup_equals_broadcast_lookup(spark, train):
    fitted = Workflow(["c", "d"] >> Categorify()).fit(train)
    # a third of the new rows hold one unseen value
    new = train.withColumn("c", F.when(F.col("id") % 3 == 0, "unseen").otherwise(F.col("c")))
    small = fitted.transform(new, ["id"])
    fitted.limits = LookupLimits(column_bytes=0)
    large = fitted.transform(new, ["id"])
    assert large.count() == new.count()
    assert sorted(large.collect()) == sorted(small.collect())
    plan = large._jdf.queryExecution().toString()
    assert "Broadcast" in plan and "ShuffledHashJoin" in plan


def test_wide_rows_are_exchanged_once(spark, train):
    wide = train.na.fill(0.5, ["x"]).withColumns({"e": F.concat("c", F.lit("e")), "g": F.col("id") % 50})

    def exchanges(columns):
        fitted = Workflow(columns >> Categorify()).fit(wide)
        small = sorted(fitted.transform(wide, ["id", "x"]).collect(), key=str)
        fitted.limits = LookupLimits(column_bytes=0)
        large = fitted.transform(wide, ["id", "x"])
        assert sorted(large.collect(), key=str) == small
        plan = large._jdf.queryExecution().executedPlan().toString()
        return sum("Exchange hashpartitioning(__row" in line for line in plan.split("== Initial Plan ==")[0].splitlines())

    # the rows and their codes
    assert exchanges(["c"]) == exchanges(["c", "d", "e", "g"]) == 2


def test_values_frequent_in_the_rows_at_hand_are_broadcast(spark, train, monkeypatch):
    from ctrflow.operators import vocab

    written = {}

    def keep(df, label):
        written[label] = materialize(df, label)
        return written[label]

    fitted = Workflow(["c", "d"] >> Categorify()).fit(train)
    new = train.withColumn("c", F.when(F.col("id") % 2 == 0, "unseen").otherwise(F.col("c")))
    small = sorted(fitted.transform(new, ["id"]).collect())
    fitted.limits = LookupLimits(column_bytes=0)
    monkeypatch.setattr(vocab, "materialize", keep)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert sorted(fitted.transform(new, ["id"]).collect()) == small
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = {(r.column, r["__k"]): r["__hot"] for r in written["hot"].collect()}
    # codes are never 0, which marks a value that no vocabulary has
    assert hot["c", "unseen"] == 0 and hot["c", "hot"] > 0


def test_steps_around_large_lookups(spark, train):
    steps = (["c"] >> LambdaOp(lambda c: F.coalesce(c, F.lit("none"))) >> Categorify() >> Normalize()) + (["x"] >> FillMissing())
    fitted = Workflow(steps).fit(train)
    small = fitted.transform(train, ["id"]).collect()
    fitted.limits = LookupLimits(column_bytes=0)
    assert sorted(fitted.transform(train, ["id"]).collect()) == sorted(small)


def test_hot_values_are_bounded(spark, train):
    from ctrflow.operators.vocab import HOT_SHARE

    fitted = Workflow(["c"] >> Categorify()).fit(train)
    size = fitted.sizes["c"]
    hot = fitted.vocab.where(F.col("freq") * HOT_SHARE >= size.total).count()
    assert hot <= HOT_SHARE and size.total == train.where("c is not null").count()


def test_broadcast_limits(spark, train):
    sizes = Workflow(["c", "d"] >> Categorify()).fit(train).sizes
    assert broadcastable(sizes, LookupLimits()) == {"c", "d"}
    d = sizes["d"].table_bytes
    assert broadcastable(sizes, LookupLimits(total_bytes=d)) == {"d"}
    assert broadcastable(sizes, LookupLimits(column_bytes=d - 1)) == set()


def test_embedding_sizes(spark, train):
    fitted = Workflow(["c", "d"] >> Categorify()).fit(train)
    sizes = {r.column: (r.cardinality, r.dim) for r in fitted.embedding_sizes(spark).collect()}
    n = train.where("c is not null").select("c").distinct().count() + 1
    assert sizes["c"] == (n, 16) and sizes["d"] == (4, 3)


def test_save_and_load(spark, train, tmp):
    group = (["c"] >> Categorify()) + (["x"] >> FillMissing() >> Normalize()) + ["label"]
    fitted = Workflow(group).fit(train)
    fitted.save(spark, f"{tmp}/wf")
    again = FittedWorkflow.load(spark, f"{tmp}/wf")
    assert sorted(again.transform(train, ["id"]).collect()) == sorted(
        fitted.transform(train, ["id"]).collect()
    )


def test_lambda_needs_a_name_to_be_saved(spark, train, tmp):
    fitted = Workflow(["x"] >> LambdaOp(lambda c: c * 2)).fit(train)
    with pytest.raises(ValueError):
        fitted.save(spark, f"{tmp}/a")
    named = Workflow(["x"] >> LambdaOp(lambda c: c * 2, "double")).fit(train)
    named.save(spark, f"{tmp}/b")
    again = FittedWorkflow.load(spark, f"{tmp}/b", {"double": lambda c: c * 2})
    assert again.transform(train.where("x = 2.0")).first().x == 4.0


def test_steps_behind_a_fitted_step(spark, train):
    """Codes that are normalised: the second fit sees the output of the first."""
    fitted = Workflow(["d"] >> Categorify() >> Normalize() >> Rename("_z")).fit(train)
    out = fitted.transform(train)
    assert out.columns == ["d_z"]
    assert out.agg(F.avg("d_z")).first()[0] == pytest.approx(0, abs=1e-9)


def test_other_steps(spark, train):
    group = (["x"] >> FillMissing(1.0) >> Clip(min_value=0) >> LogOp()) + (["c"] >> HashBucket(8))
    out = FittedWorkflow(group.branches).transform(train)
    assert out.where("x < 0 or c < 0 or c > 8").count() == 0
    # missing values have a bucket to themselves
    assert out.where("c = 8").count() == train.where("c is null").count()


def test_an_output_name_cannot_occur_twice():
    with pytest.raises(ValueError):
        Workflow((["x"] >> LogOp()) + ["x"])


def test_an_empty_column_has_only_slot_0(spark, train):
    rows = train.withColumn("c", F.lit(None).cast("string"))
    fitted = Workflow(["c"] >> Categorify()).fit(rows)
    assert fitted.transform(train).distinct().collect() == [(0,)]


def test_the_projection_reaches_the_scan(spark, train, tmp):
    train.write.parquet(f"{tmp}/t")
    stored = spark.read.parquet(f"{tmp}/t")
    fitted = Workflow(["x"] >> FillMissing() >> Normalize()).fit(stored)
    plan = fitted.transform(stored.where("label = 1"))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<x:double,label:int>" in plan and "EqualTo(label,1)" in plan
