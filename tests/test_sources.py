import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ctrflow.functions import scalars
from ctrflow.operators import runs, sampling
from ctrflow.operators.columns import cast_all, parse_events, unpack_event
from ctrflow.schema import CtrSchema
from ctrflow.scratch import shared_dir
from ctrflow.sources import scans, sinks

SCHEMA = CtrSchema(conts=("i1", "i2"), cats=("c1",))


@pytest.fixture()
def days(spark, tmp):
    """Files day_0, day_1, day_3 and one that is no day file, as single files."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    import os

    path = tmp[len("file:"):] + "/days"
    os.makedirs(path)
    full = CtrSchema()
    for name, n in (("day_0", 3), ("day_1", 4), ("day_3", 5), ("day_x", 6)):
        cols = {"label": pa.array([1] * n, pa.int32())}
        cols.update({c: pa.array(range(n), pa.int64()) for c in full.conts})
        cols.update({c: pa.array(range(n), pa.int32()) for c in full.cats})
        pq.write_table(pa.table(cols), f"{path}/{name}.parquet")
    return path


def test_day_files(spark, days):
    df = scans.read_days(spark, days)
    assert scans.count_days(df).first().days == 3
    train, valid = scans.day_split(df, 1, 1)
    assert (train.count(), valid.count()) == (3, 4)
    assert len(df.columns) == 41
    some = scans.read_days(spark, days, [0, 3])
    assert {r.day: r["count"] for r in some.groupBy("day").count().collect()} == {0: 3, 3: 5}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scans.read_days(spark, days, [0, 2])


@pytest.mark.parametrize("n_train, n_val", [(2, 1), (20, 5), (-1, 2)])
def test_missing_or_too_many_days_are_refused(spark, days, n_train, n_val):
    with pytest.raises(ValueError):
        scans.day_split(scans.read_days(spark, days), n_train, n_val)


def test_listing(spark, days):
    files = scans.list_files(spark, days, 2).collect()
    assert [r.path.rsplit("/", 1)[1] for r in files] == ["day_0.parquet", "day_1.parquet"]
    assert "content" not in files[0].asDict()
    assert scans.scan_new(spark, days).count() == 18


def test_csv_to_parquet(spark, tmp):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    rows.write.option("header", True).csv(f"{tmp}/csv")
    sinks.csv_to_parquet(spark, f"{tmp}/csv", f"{tmp}/pq", rows.schema)
    assert sorted(scans.read_parquet_dir(spark, f"{tmp}/pq").collect()) == sorted(rows.collect())
    assert scans.read_csv_dir(spark, f"{tmp}/csv", rows.schema).count() == 2


def test_features_keep_types_roles_and_rows(spark, tmp):
    df = spark.createDataFrame([(i, float(i), None, 1) for i in range(50)], "c1 bigint, i1 double, i2 double, label int")
    sinks.write_features(df, f"{tmp}/f", SCHEMA, shuffle_seed=3)
    got = spark.read.parquet(f"{tmp}/f")
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("c1", "bigint"), ("i1", "float"), ("i2", "float"), ("label", "float"),
    ]
    assert got.schema["c1"].metadata == {"role": "categorical"}
    assert sorted(r.c1 for r in got.collect()) == list(range(50))
    files = sinks.manifest(got).collect()
    assert sum(r.rows for r in files) == 50 and files[0].file.endswith(".parquet")


def test_seeded_shuffle_is_repeatable_and_moves_no_row(spark):
    df = spark.range(1000, numPartitions=4).withColumn("part", F.spark_partition_id())
    one = sampling.shuffle_within_partition(df, ["id"], 1)
    plan = one._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    got = one.withColumn("now", F.spark_partition_id()).collect()
    assert all(r.part == r.now for r in got)
    assert [r.id for r in got] == [r.id for r in sampling.shuffle_within_partition(df, ["id"], 1).collect()]
    assert [r.id for r in got] != sorted(r.id for r in got)


def test_incremental_landing_takes_each_file_once(spark, tmp):
    spark.range(10).write.parquet(f"{tmp}/src")
    sinks.land(spark, f"{tmp}/src", f"{tmp}/dst", "incremental")
    spark.range(10, 15).write.mode("append").parquet(f"{tmp}/src")
    for _ in range(2):
        sinks.land(spark, f"{tmp}/src", f"{tmp}/dst", "incremental")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/dst").collect()) == list(range(15))
    sinks.land(spark, f"{tmp}/src", f"{tmp}/full", "full")
    assert spark.read.parquet(f"{tmp}/full").count() == 15
    with pytest.raises(ValueError):
        sinks.land(spark, f"{tmp}/src", f"{tmp}/full", "sideways")


def test_events_round_trip(spark):
    df = spark.createDataFrame(
        [(1, None, 7, 0, 0.25), (2, 3.5, None, 1, 0.5)], "i1 int, i2 double, c1 int, label int, predval double"
    )
    back = unpack_event(parse_events(sinks.to_events(df, SCHEMA)), SCHEMA)
    assert back.columns == ["label", "i1", "i2", "c1"]
    assert sorted(back.collect()) == [(0.0, 1.0, None, 7.0), (1.0, 2.0, 3.5, None)]


def test_unreadable_and_odd_payloads(spark):
    rows = [(1, "{nope"), (2, '{"input0":[NaN,2],"input1":[],"trueval":1,"predval":NaN}'), (3, None), (4, "{}")]
    got = {r.id: r for r in parse_events(spark.createDataFrame(rows, "id int, payload string")).collect()}
    assert got[1].corrupt == "{nope" and got[1].trueval is None
    assert got[2].input0 == [None, 2.0] and got[2].predval is None and got[2].corrupt is None
    short = unpack_event(parse_events(spark.createDataFrame(rows, "id int, payload string")), SCHEMA, ["id"])
    assert {r.id: r.c1 for r in short.collect()} == {1: None, 2: None, 3: None, 4: None}


def test_casts_that_do_not_fit_give_null(spark):
    df = spark.createDataFrame([("12",), ("x",)], "a string")
    assert [r.a for r in cast_all(df, {"a": "int"}).collect()] == [12, None]


def test_union_fills_absent_columns(spark):
    out = sampling.union_frames(spark.range(1), spark.createDataFrame([("a",)], "s string"))
    assert sorted(out.collect(), key=str) == [(0, None), (None, "a")]


def test_versions_sort_by_number(spark):
    paths = [(f"m/a/{v}/x.bin",) for v in (1, 2, 10, 9)] + [("m/b/v3/x.bin",)]
    log = sampling.artifact_versions(spark.createDataFrame(paths, "path string"))
    got = {r.model: (r.version, r.path, r.next_version) for r in sampling.latest_version(log).collect()}
    assert got == {"a": (10, "m/a/10/x.bin", 11), "b": (3, "m/b/v3/x.bin", 4)}


def test_one_file_of_many(spark, tmp):
    spark.range(100, numPartitions=5).write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    one = [sampling.sample_one_file(df, seed).first().file for seed in (1, 1, 2, 3, 4, 5, 6)]
    assert one[0] == one[1] and len(set(one)) > 1


def test_suppression(spark):
    alerts = spark.createDataFrame([(1, "busy"), (2, "idle"), (3, "new")], "id int, pipeline string")
    table = spark.createDataFrame(
        [("busy", "Running"), ("busy", "Succeeded"), ("idle", "Succeeded"), ("idle", "Failed")],
        "pipeline string, status string",
    )
    assert [r.id for r in runs.suppress_while_running(alerts, table).collect()] == [2]
    assert sorted(r.id for r in runs.alerts_of_known(alerts, table).collect()) == [1, 2]
    assert sorted(r.id for r in runs.alerts_not_running(alerts, table).collect()) == [2, 3]
    assert runs.filter_runs(table, "busy").count() == 2


def test_paths_and_times(spark):
    row = spark.createDataFrame([("m/dcn/3/model.bin", "2024-02-03 04:05:06")], "p string, t string").select(
        scalars.base_name(F.col("p")).alias("base"),
        scalars.path_part(F.col("p"), 2).alias("version"),
        scalars.path_part(F.col("p"), 9).alias("none"),
        scalars.with_version(F.col("p"), F.lit(4)).alias("moved"),
        scalars.log_file_time(F.col("t").cast("timestamp")).alias("name"),
        scalars.day_of_file(F.lit("day_07.parquet")).alias("day"),
        scalars.day_of_file(F.lit("day_x.parquet")).alias("no_day"),
        scalars.is_day_file(F.lit("day_1xparquet")).alias("strict"),
    ).first()
    assert tuple(row) == ("model.bin", "3", None, "m/dcn/4/model.bin", "03_02_2024-04-05-06", 7, None, False)


def test_shared_folder_of_a_local_session(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_days_of_any_number_of_digits(spark, tmp):
    schema = CtrSchema(conts=("I1",), cats=("C1",))
    folder = tmp[len("file:"):]
    for name in ("day_7", "day_100"):
        pq.write_table(pa.table({"label": pa.array([1], pa.int32()), "I1": [2], "C1": pa.array([3], pa.int32())}), f"{folder}/{name}.parquet")
    assert sorted(r.day for r in scans.read_days(spark, tmp, schema=schema).select("day").collect()) == [7, 100]
    os.rename(f"{folder}/day_7.parquet", f"{folder}/day_{10**12}.parquet")
    with pytest.raises(Exception, match="CAST"):
        scans.read_days(spark, tmp, schema=schema).select("day").collect()
