"""Plans: what is pushed down, what is shuffled, and what a hot key costs."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkelt import queries as registry
from sparkelt import schemas as S
from sparkelt.fixtures import raw_feed
from sparkelt.operators.dedup import dedup_latest
from sparkelt.operators.filters import since
from sparkelt.operators.quality import run_checks
from sparkelt.plans import models as M
from sparkelt.plans import pipeline as P
from sparkelt.sources.warehouse import Warehouse

EAGER = ("inc_two", "stream_", "dq_report", "model_counts")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (hash|range|single|round|SinglePartition)", plan_of(df))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Raw tables on disk and all models built from them."""
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("plans")))
    for feed in S.FEEDS.values():
        raw = raw_feed(spark, sf_dir, feed)
        raw = raw.withColumns({"load_date": F.to_date("loaded_at"), "batch_id": F.lit(0).cast("long")})
        raw.write.partitionBy("load_date", "batch_id").parquet(wh.raw_path(feed))
    P.run_models(wh)
    return wh


def shuffled_rows(df) -> list[int]:
    """Records written by each hash shuffle while computing the frame."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df._jdf.collectToPython()
        out, todo = [], [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange":
                out.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return out
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", [n for n in registry.queries() if not n.startswith(EAGER)])
def test_no_cross_join_and_no_row_udf(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BatchEvalPython", plan)


def test_staging_pushes_filters_and_shuffles_once(stored):
    df = M.stg_taxi(stored.read_raw(S.GREEN), S.GREEN)
    plan = plan_of(df)
    for c in (*S.GREEN.id_cols, "trip_id"):
        assert f"IsNotNull({c})" in plan
    assert "store_and_fwd_flag" not in plan.split("ReadSchema")[1]
    assert "WindowGroupLimit" in plan and exchanges(df) == ["hash"]


def test_downstream_models_do_not_shuffle(stored):
    green, yellow = (stored.read(P.STAGING[f].table) for f in S.FEEDS)
    both = M.int_both_taxi(green, yellow)
    metrics = M.int_metrics_added(stored.read(P.INT_BOTH.table))
    fact = M.fact_trip(stored.read(P.INT_METRICS.table))
    assert exchanges(both) == exchanges(metrics) == exchanges(fact) == []


def test_dimensions_read_only_their_columns(stored):
    metrics = stored.read(P.INT_METRICS.table)
    df = M.dim_members(metrics, M.DIMENSIONS.values())
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(df)).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "vendor_id",
        "payment_id",
        "ratecode_id",
        "trip_type_id",
        "pu_location_id",
        "do_location_id",
        "loaded_at",
    }
    assert plan_of(df).count("FileScan") == 1 and exchanges(df) == ["hash"]


def test_watermark_reaches_the_scan(stored):
    df = since(stored.read_raw(S.GREEN), datetime(2024, 2, 1, 12))
    assert "GreaterThan(loaded_at,2024-02-01T12:00)" in plan_of(df)


def test_report_scans_each_table_for_each_kind_of_check_once(stored):
    plan = plan_of(run_checks(P.tables(stored), P.CHECKS))
    # two staging tables twice (row checks, unique), int_both, the fact, five dimensions
    assert plan.count("FileScan") == 2 * 2 + 1 + 1 + 5


# --- hot keys ---------------------------------------------------------------------------------

ROWS, TASKS = 90_000, 12


def hot(spark, copies: int = 3):
    """A third of all rows share one key; the rest are pairs."""
    third = ROWS // copies
    key = F.when(F.col("id") % copies == 0, "hot").otherwise(F.concat(F.lit("k"), F.expr(f"id % {third}")))
    return spark.range(0, ROWS, 1, TASKS).select(
        key.alias("trip_id"), F.expr("id div 7").alias("loaded_at"), F.col("id").alias("v")
    )


def test_hot_key_is_cut_before_the_dedup_shuffle(spark):
    df = hot(spark)
    got = dedup_latest(df, ["trip_id"], ["loaded_at"], ["v"])
    others = df.filter("trip_id <> 'hot'").count()
    assert sum(shuffled_rows(got)) <= others + TASKS
    want = df.groupBy("trip_id").agg(F.max("v").alias("v"))
    assert got.select("trip_id", "v").exceptAll(want).isEmpty() and got.count() == want.count()


def test_hot_values_are_combined_before_the_dimension_and_fact_checks(spark):
    ids = {c: F.expr("IF(id % 3 = 0, 7, id % 265)") for d in M.DIMENSIONS.values() for c in d.columns}
    trips = spark.range(0, ROWS, 1, TASKS).select(
        *[c.alias(n) for n, c in ids.items()], F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz").alias("loaded_at")
    )
    members = M.dim_members(trips, M.DIMENSIONS.values())
    assert max(shuffled_rows(members)) <= 5 * 265 * TASKS
    dims = {n: M.dim_from_members(members, d) for n, d in M.DIMENSIONS.items()}
    checks = [c for c in P.CHECKS if c.check == "relationships"]
    report = run_checks({"fact_trip": trips, **dims}, checks)
    assert max(shuffled_rows(report)) <= 6 * 265 * TASKS
    assert all(r.failures == 0 for r in report.collect())


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    """A rebalance splits a partition value that outgrows the advisory size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        day = F.when(F.col("v") % 3 < 2, "d1").otherwise(F.concat(F.lit("d"), F.col("v") % 9))
        df = hot(spark).withColumn("blob", F.sha2(F.col("v").cast("string"), 512)).withColumn("day", day)
        path = str(tmp_path / "out")
        df.hint("rebalance", "day").write.partitionBy("day").parquet(path)
        out = spark.read.parquet(path)
        files = {r[0] for r in out.filter("day = 'd1'").select(F.input_file_name()).distinct().collect()}
        assert len(files) > 4 and out.count() == ROWS
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_repeated_keys_in_an_increment_are_merged_once(spark, tmp_path, trip_row):
    """Many versions of one trip in the increment, over a target that holds it."""
    from datetime import timedelta

    from sparkelt.plans.incremental import run_model

    wh = Warehouse(spark, str(tmp_path / "wh"))
    start = datetime(2024, 2, 1, 8)
    rows = [trip_row(trip_id=t) for t in "abc"]
    run_model(wh, P.STAGING["green"], {"raw_green": spark.createDataFrame(rows, S.GREEN.raw_schema)})
    more = [trip_row(trip_id="a", fare_amount=float(i), loaded_at=start + timedelta(seconds=i)) for i in range(1, 300)]
    more.append(trip_row(trip_id="z", loaded_at=start + timedelta(seconds=5)))
    run_model(wh, P.STAGING["green"], {"raw_green": spark.createDataFrame(more, S.GREEN.raw_schema)})
    got = {r.trip_id: r.fare_amount for r in wh.read(P.STAGING["green"].table).collect()}
    assert got == {"a": 299.0, "b": 10.0, "c": 10.0, "z": 10.0}
