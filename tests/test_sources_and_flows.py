"""Snapshots, month scans, streaming forms, and declared pipelines."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators import bars
from tidemark.plans import declare
from tidemark.sources import store, tables
from tidemark.streaming import flows


def test_snapshots_know_their_content(spark, tmp_path):
    rows = spark.createDataFrame([(k, datetime(2024, 1 + k % 3, 5), float(k)) for k in range(30)], "k int, at timestamp_ntz, v double")
    path = f"{tmp_path}/s"
    store.write_snapshot(rows, path, "at")
    assert sorted(r.k for r in store.verify_snapshot(spark, path).collect()) == list(range(30))
    rows.limit(1).withColumn("year", F.lit(2024)).withColumn("month", F.lit(1)).write.mode("append").partitionBy("year", "month").parquet(f"{path}/data")
    with pytest.raises(ContractError):
        store.verify_snapshot(spark, path)
    store.publish_result({"a": rows, "b": rows.limit(2)}, f"{tmp_path}/r")
    assert store.read_result(spark, f"{tmp_path}/r", "b", ["k"]).count() == 2


def test_month_scans_prune_partitions(spark, tmp_path):
    rows = spark.createDataFrame([("a", datetime(2023, m, 10, 9, 31), float(m)) for m in range(1, 13)], "code string, dt timestamp_ntz, close double")
    rows.withColumn("year", F.year("dt")).withColumn("month", F.month("dt")).write.partitionBy("year", "month").parquet(f"{tmp_path}/m")
    df = tables.scan_months(spark, f"{tmp_path}/m", datetime(2023, 3, 1), datetime(2023, 9, 1), datetime(2023, 6, 15), ["code", "close"])
    assert sorted(r.close for r in df.collect()) == [3, 4, 5, 6]
    assert "PartitionFilters: [" in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ContractError):
        tables.require_wall_clock(rows.withColumn("dt", F.col("dt").cast("timestamp")), "dt")


def test_json_arrays(spark):
    rows = spark.createDataFrame([(1, '["a", "b"]', "2024-01-01"), (2, "no", "x"), (3, "[]", None), (4, None, None)], "k int, j string, d string")
    assert sorted((r.k, r.e) for r in tables.json_array_rows(rows, ["k"], "j", "e").collect()) == [(1, "a"), (1, "b")]
    assert tables.json_array_rows(rows, ["k"], "j", "e", kinds=[], dates=["d"]).collect() == []
    assert tables.json_array_rows(rows, ["k"], "j", "e", kinds=["p", "q"]).count() == 4


def stream(spark, tmp_path, rows, schema, build, parts=3):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for k in range(parts):
        spark.createDataFrame(rows[k::parts] if parts > 1 else rows, schema).coalesce(1).write.mode("append").parquet(source)
    df = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source))
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.read.schema(df.schema).parquet(out)


def at(seconds):
    return datetime(2024, 1, 1) + timedelta(seconds=seconds)


def test_windowed_bars_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    rows = [(f"c{k % 2}", at(k * 20), float(k % 7), 1.0) for k in range(60)]
    schema = "code string, ts timestamp, price double, volume double"
    got = stream(spark, tmp_path, rows, schema, lambda df: flows.windowed_bars(df, "5 minutes", "10 minutes"), parts=2)
    batch = flows.windowed_bars(spark.createDataFrame(rows, schema), "5 minutes", "10 minutes")
    a, b = sorted(map(tuple, got.collect())), sorted(map(tuple, batch.collect()))
    assert a and set(a) <= set(b) and len(b) - len(a) <= 8  # the last windows stay open
    assert {r[2] for r in b if r[3] == 0.0}


def test_events_are_taken_once(spark, tmp_path):
    rows = [(k % 10, at(k)) for k in range(30)]
    out = stream(spark, tmp_path, rows, "id int, ts timestamp", lambda df: flows.first_events(df, "id", "ts", "1 hour"))
    assert sorted(r.id for r in out.collect()) == list(range(10))


def test_streamed_features_and_labels_are_those_of_the_batch(spark, tmp_path):
    closes = [10.0, 11.0, 9.0, 12.0, 12.0, 15.0]
    rows = [("a", at(60 * k), c) for k, c in enumerate(closes)]
    schema = "code string, dt timestamp, close double"
    out = stream(spark, tmp_path, rows, schema, lambda df: flows.rolling_features(df, 3), parts=1).orderBy("dt").collect()
    batch = spark.createDataFrame(rows, schema).withColumns({"dt": F.col("dt").cast("timestamp_ntz"), "trading_date": F.lit("d"), "session_id": F.lit("s"), "volume": F.lit(1.0), "avg": F.lit(1.0)})
    want = bars.intraday_features(batch, 3, 2, 1).orderBy("dt").collect()
    assert [r.lagged_return for r in out[1:]] == pytest.approx([r.lagged_return for r in want])
    assert [r.rolling_volatility for r in out[1:]] == pytest.approx([r.rolling_volatility for r in want])
    (tmp_path / "l").mkdir()
    labels = stream(spark, tmp_path / "l", rows, schema, lambda df: flows.forward_labels(df, 2), parts=1).orderBy("dt").collect()
    assert [r.future_return for r in labels] == pytest.approx([closes[k + 2] / closes[k] - 1 for k in range(4)])


@pytest.fixture
def operators():
    held = dict(declare.OPERATORS)
    declare.operator("double", "feature")(lambda df, by=2: df.withColumn("v", F.col("v") * by))
    declare.operator("both")(lambda a, b: a.unionByName(b))
    declare.operator("ahead", "label")(lambda df: df)
    yield
    declare.OPERATORS.clear()
    declare.OPERATORS.update(held)


def test_pipelines_are_checked_and_lazy(spark, operators):
    node = declare.Node
    df = spark.createDataFrame([(1,), (2,)], "v int")
    p = declare.Pipeline((node("u", "both", ("d", "x")), node("x", "double", ("d",), {"by": 3})))
    assert sorted(r.v for r in p.run({"d": df}, "u")["u"].collect()) == [1, 2, 3, 6]
    for bad in (
        (node("a", "none", ("d",)),),
        (node("a", "double", ("q",)),),
        (node("a", "double", ("d",), {"to": 1}),),
        (node("a", "double", ("b",)), node("b", "double", ("a",))),
        (node("a", "double", ("d",)), node("a", "double", ("d",))),
        (node("l", "ahead", ("d",)), node("f", "double", ("l",))),
        (node("l", "ahead", ("d",)), node("m", "both", ("l", "d")), node("f", "double", ("m",))),
    ):
        with pytest.raises(ContractError):
            declare.Pipeline(bad).compile(["d"])
    assert [n.name for n in declare.variants(node("x", "double", ("d",)), {"by": [2, 5]})] == ["x_by2", "x_by5"]
