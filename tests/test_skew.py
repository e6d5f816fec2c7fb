"""One key holding a third of all rows: results stay whole, no task gets it all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderflow.operators import metrics
from orderflow.plans.rollup import margins
from orderflow.sources.views import line_transactions

LINES, PARTS, HOT = 60_000, 500, 7

SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def settings(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skewed"))

    def table(name, rows):
        rows.write.parquet(f"{path}/{name}.parquet")

    table("nation", spark.range(5).selectExpr("int(id) n_nationkey", "concat('N', id) n_name"))
    table("customer", spark.range(50).selectExpr("id c_custkey", "int(id % 5) c_nationkey"))
    table("orders", spark.range(2000).selectExpr(
        "id o_orderkey", "id % 50 o_custkey", "timestamp_ntz'2024-01-01' o_orderdate",
        "concat(id % 4, '-P') o_orderpriority"))
    table("part", spark.range(PARTS).selectExpr(
        "id p_partkey", "concat('part ', id) p_name", f"if(id = {HOT}, 'HOT', 'COLD') p_type"))
    table("lineitem", spark.range(LINES).selectExpr(
        "id % 2000 l_orderkey",
        f"if(id % 3 = 0, {HOT}L, id % {PARTS}) l_partkey",
        "int(id % 7) l_linenumber", "1.0D l_quantity", "id * 0.25D l_extendedprice", "0.0D l_discount",
        "'N' l_returnflag").repartition(8))
    return path


def test_hot_part_is_split_and_counted_in_full(spark, folder, settings):
    hot = sum(i * 0.25 for i in range(LINES) if i % 3 == 0 or i % PARTS == HOT)
    revenue = metrics.revenue_by_category(line_transactions(spark, folder))
    found = {row.category: row.revenue for row in revenue.collect()}
    assert found == {"HOT": hot, "COLD": sum(i * 0.25 for i in range(LINES)) - hot}
    executed = revenue._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in executed, executed


def test_hot_value_is_combined_before_the_shuffle(spark):
    """Each task hands on one row per value, however many rows the value has."""
    df = spark.range(50_000, numPartitions=4).selectExpr(
        "if(id % 3 = 0, 'hot', string(id % 10)) category", "'c' city", "'p' payment_method",
        "'Completed' order_status", "timestamp'2024-01-01 00:00:00' timestamp", "1.0D total_amount")
    grouped = margins(df)
    counts = {(r.dimension, r.key): r.order_count for r in grouped.collect()}
    assert counts[("category", "hot")] == 16_667 and counts[("city", "c")] == 50_000
    assert sum(n for (dimension, _), n in counts.items() if dimension == "category") == 50_000
    plan = grouped._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.index("Exchange") < text.index("partial_count")
    assert grouped.agg(F.max("order_count")).first()[0] == 50_000
