from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from eventloom.schemas import ORDERS, PREDICTIONS, conform
from eventloom.sources import csv_files, run_log
from eventloom.sources.guards import MissingInput, require_path, require_rows
from eventloom.sources.warehouse import Warehouse, union_days
from tests.test_scoring import DAY, decided_from
from eventloom.plans import scoring


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def orders(spark, *rows):
    full = [(t, "u", d, date(2020, 12, 1), "2020-12", r, 1, 0, "normal") for t, d, r in rows]
    return spark.createDataFrame(full, ORDERS)


def stored(warehouse, **kwargs):
    rows = warehouse.read("orders", **kwargs).collect()
    return sorted((r.event_date, r.transaction_id, r.order_revenue) for r in rows)


def test_append_twice_stores_twice(spark, warehouse):
    df = orders(spark, ("a", "20201201", 1.0))
    warehouse.append("orders", df)
    warehouse.append("orders", df)
    assert stored(warehouse) == [("20201201", "a", 1.0)] * 2
    conform(warehouse.read("orders"), ORDERS)


def test_replace_days(spark, warehouse):
    both = orders(spark, ("a", "20201201", 1.0), ("b", "20201202", 2.0))
    days = ["20201201", "20201202"]
    for _ in range(2):
        warehouse.replace_days("orders", both, days)
    assert stored(warehouse) == [("20201201", "a", 1.0), ("20201202", "b", 2.0)]
    warehouse.replace_days("orders", orders(spark, ("c", "20201202", 3.0)), ["20201202"])
    assert stored(warehouse) == [("20201201", "a", 1.0), ("20201202", "c", 3.0)]
    warehouse.replace_days("orders", orders(spark, ("d", "20201202", 4.0)), days)
    assert stored(warehouse) == [("20201202", "d", 4.0)]
    assert stored(warehouse, days=["20201201"]) == []


def test_replace_days_refuses_other_days(spark, warehouse):
    warehouse.replace_days("orders", orders(spark, ("a", "20201201", 1.0)), ["20201201"])
    mixed = orders(spark, ("x", "20201201", 9.0), ("b", "20201202", 2.0))
    with pytest.raises(Exception, match="row of day 20201201 is not among"):
        warehouse.replace_days("orders", mixed, ["20201202"])
    with pytest.raises(Exception, match="row of day NULL"):
        warehouse.replace_days("orders", orders(spark, ("b", None, 2.0)), ["20201202"])
    assert stored(warehouse) == [("20201201", "a", 1.0)]


def test_wrong_schema_is_refused(spark, warehouse):
    with pytest.raises(ValueError, match="schema mismatch"):
        warehouse.append("orders", orders(spark).drop("period_label"))


def test_reading_days_prunes_partitions(spark, warehouse):
    warehouse.append("orders", orders(spark, ("a", "20201201", 1.0), ("b", "20201202", 2.0)))
    plan = warehouse.read("orders", ["20201202"])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(event_date" in plan.toString()


def test_bound_sql(spark, warehouse):
    warehouse.append("orders", orders(spark, ("a", "20201201", 1.0), ("b", "20201202", 2.0)))
    got = warehouse.sql(
        "SELECT count(*) AS n FROM IDENTIFIER(:orders) WHERE event_date = :day",
        tables=["orders"],
        day="20201201' OR '1' = '1",
    )
    assert got.first().n == 0


def test_union_days_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2, True)], "t string, n int, extra boolean")
    rows = union_days(a, b).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, "y", True)]


def predictions(spark):
    return scoring.predictions(decided_from(spark, (0.9, 0.1), (0.5, 0.7)), DAY)


def test_csv_shards_align_by_header(spark, tmp_path):
    folder = tmp_path / "shards"
    folder.mkdir()
    (folder / "day_1.csv").write_text("user_pseudo_id,purchase_probability\nu1,0.5\n")
    (folder / "day_2.csv").write_text("purchase_probability,user_pseudo_id,other\n0.25,u2,z\n")
    (folder / "day_3.csv").write_text("user_pseudo_id,purchase_probability\nu3,bad\n")
    df = csv_files.read_csv_shards(spark, f"{folder}/day_*.csv", PREDICTIONS)
    conform(df, PREDICTIONS)
    got = sorted((r.user_pseudo_id, r.purchase_probability) for r in df.collect())
    assert got == [("u1", 0.5), ("u2", 0.25), ("u3", None)]
    with pytest.raises(MissingInput):
        csv_files.read_csv_shards(spark, f"{folder}/none_*.csv", PREDICTIONS)


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    text = 'he said "a, b"\nand \\ left'
    df = predictions(spark).withColumn("value_segment", F.lit(text))
    csv_files.write_csv(df, str(tmp_path / "out"))
    back = csv_files.read_csv_shards(
        spark, f"{tmp_path}/out/*.csv", PREDICTIONS, multi_line=True
    )
    assert {r.value_segment for r in back.collect()} == {text}


@pytest.mark.parametrize("infer", [False, True])
def test_load_csv_appends(spark, warehouse, tmp_path, infer):
    csv_files.write_csv(predictions(spark), str(tmp_path / "out"))
    for _ in range(2):
        csv_files.load_csv(warehouse, str(tmp_path / "out"), "predictions", infer=infer)
    loaded = warehouse.read("predictions", [DAY])
    assert loaded.exceptAll(predictions(spark).union(predictions(spark))).isEmpty()
    assert loaded.count() == 4


def test_inferred_csv_goes_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b,c\n1,2,x\n")
    (tmp_path / "2.csv").write_text("c,b,a\ny,0.5,7\n")
    (tmp_path / "3.csv").write_text("b,a\n3,z\n")
    df = csv_files.infer_csv(spark, f"{tmp_path}/*.csv")
    assert dict(df.dtypes) == {"a": "string", "b": "double", "c": "string"}
    assert sorted(tuple(r) for r in df.select("a", "b", "c").collect()) == [
        ("1", 2.0, "x"), ("7", 0.5, "y"), ("z", 3.0, None),
    ]


def test_scan_csv_reads_chosen_columns(spark, tmp_path):
    csv_files.write_csv(predictions(spark), str(tmp_path / "out"))
    df = csv_files.scan_csv(spark, str(tmp_path / "out"), PREDICTIONS, ["user_pseudo_id"])
    assert sorted(r[0] for r in df.collect()) == ["u0", "u1"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_pseudo_id:string>" in plan


def test_columns_in_another_order_keep_their_names(spark, tmp_path):
    rows = predictions(spark)
    csv_files.write_csv(rows.select(*sorted(rows.columns)), str(tmp_path / "out"))
    back = csv_files.scan_csv(spark, str(tmp_path / "out"), PREDICTIONS)
    assert back.exceptAll(rows).isEmpty() and back.count() == 2


def test_one_file_is_split_among_tasks(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.range(60_000).selectExpr(
        "cast(id as string) AS user_pseudo_id", "0.5 AS purchase_probability"
    ).coalesce(1).write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        whole = csv_files.scan_csv(spark, path, PREDICTIONS, multi_line=True)
        split = csv_files.scan_csv(spark, path, PREDICTIONS)
        assert whole.rdd.getNumPartitions() < split.rdd.getNumPartitions()
        assert split.count() == whole.count() == 60_000
        assert split.where("user_pseudo_id = '59999'").first().purchase_probability == 0.5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_are_found_without_reading_the_files(spark, tmp_path):
    """Two files of some ten megabytes and an empty one: a fraction of the bytes is read."""
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
    line = "x" * 200 + ",1\n"
    (tmp_path / "a.csv").write_text("name,n\n" + line * 100_000)
    (tmp_path / "b.csv").write_text("n,name\r\n" + "1,y\n" * 3_000_000)
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("name,n\n")
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    before = sum(s.getBytesRead() for s in statistics())
    found = csv_files._files_by_header(spark, f"{tmp_path}/*.csv")
    read = sum(s.getBytesRead() for s in statistics()) - before
    names = {h: [p.rsplit("/", 1)[1] for p in paths] for h, paths in found.items()}
    assert names == {"name,n": ["a.csv", "d.csv"], "n,name": ["b.csv"]}
    assert read < size / 3


def test_guards(spark, tmp_path):
    with pytest.raises(MissingInput):
        require_path(spark, str(tmp_path / "none"))
    with pytest.raises(MissingInput, match="orders is empty"):
        require_rows(orders(spark), "orders")


def test_run_log(spark, warehouse):
    trend = scoring.prediction_trend(decided_from(spark, (0.9, 0.1)), DAY)
    run_log.log_run(warehouse, trend, {"t7_path": "p"})
    metrics = {r.metric: r.value for r in warehouse.read("run_metrics").collect()}
    assert len(metrics) == 13
    assert metrics["purchase_rate"] == 1.0 and metrics["avg_c_prob"] == 0.1
    run = warehouse.read("runs").first()
    assert run.run_name == "Inference_2020-12-19"
    assert run.params == {"t7_path": "p"}
    assert run.tags["run_type"] == "inference" and len(run.tags) == 3


def test_user_features_of_bucketed_tables_need_no_exchange(spark, sf_dir, tmp_path):
    """No side of the joins is shuffled; a replaced day and another session's view work."""
    from checks.inputs import flat_table, session_table
    from eventloom.plans import marts
    from eventloom.sources.bucketed import UserTables

    flat = flat_table(spark, sf_dir)
    tables = UserTables(spark, str(tmp_path / "users"), buckets=8)
    parts = {
        "user_day_totals": marts.user_day_totals(flat),
        "user_day_facts": marts.user_day_facts(flat),
        "session_funnel": session_table(spark, sf_dir),
    }
    for name, rows in parts.items():
        tables.replace_days(name, rows)
    some = parts["user_day_totals"].where("event_date = '20201201'")
    tables.replace_days("user_day_totals", some)
    assert tables.read("user_day_totals").exceptAll(parts["user_day_totals"]).isEmpty()
    assert tables.read("user_day_totals").count() == parts["user_day_totals"].count()
    totals = marts.user_event_totals_by_user(
        tables.read("user_day_totals"), tables.read("user_day_facts")
    )
    features = marts.user_features_of(totals, tables.read("session_funnel"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan, plan
    direct = marts.user_features(flat, session_table(spark, sf_dir))
    assert sorted(map(str, features.collect())) == sorted(map(str, direct.collect()))
