"""What no query's plan may hold, with sides too large to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks.registry import all_trades, table
from hanok.plans import marts
from hanok.sinks import lake

SF = "/root/testdata/sf0.001"
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    assert not [b for b in BANNED if b in text]


def test_unit_prices_hash_without_sorting(spark):
    text = plan(QUERIES["price_change"](spark, SF))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_an_answer_is_parsed_once(spark):
    assert plan(QUERIES["s14_xml_pages"](spark, SF)).count("from_xml(") == 1


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["avg_price_by_date"](spark, SF))
    assert "Not(EqualTo(l_returnflag,R))" in text.split("PushedFilters", 1)[1]
    assert "l_comment" not in text and "l_tax" not in text and "l_orderkey" not in text


def test_monthly_features_share_one_exchange(spark):
    monthly = spark.createDataFrame([], "sggcd STRING, deal_month_date DATE, median_ppsqm_krw DOUBLE, trades LONG")
    from hanok.operators.timeseries import price_features

    assert plan(price_features(monthly.repartition(2, "deal_month_date"))).count("Exchange hashpartitioning(sggcd") == 1


def test_month_window_skips_partitions(spark):
    lake.drop_table(spark, "by_month")
    rows = spark.range(24).select(
        F.add_months(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("deal_month_date"),
        F.lit("a").alias("sggcd"), F.lit(1.0).alias("ppsqm_krw"),
    )
    lake.replace_table(rows, "by_month", ["deal_month_date"])
    df = marts.within_months(spark.table("by_month"), 12)
    assert "PartitionFilters: [isnotnull(deal_month_date" in plan(df) and df.count() == 12
    lake.drop_table(spark, "by_month")


def test_trades_are_all_order_lines(spark):
    assert all_trades(spark, SF).count() == table(spark, SF, "lineitem").count()


def test_the_date_filter_of_raw_rows_leaves_methods_small_enough_to_compile(spark):
    # The JVM only interprets methods of more than 8,000 bytes.
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        executed = QUERIES["m1_trade_features"](spark, SF)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set(key, before)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(executed))]
    assert sizes and max(sizes) <= 8000


def test_rows_outside_their_partition_are_left_out_unless_their_date_cannot_be_read(spark):
    from hanok.schema import RAW_SCHEMA

    # year, month and the date of a row; whether it stays.
    given = [
        (2024, 3, "2024", "3", "5", True), (2024, 3, "2204", "3", "5", False), (2024, 3, "2024", "4", "5", False),
        (2024, 3, "2024", "13", "5", True), (2024, 3, "2023", "2", "30", True), (2024, 3, "x", "3", "5", True), (2024, 3, None, None, None, True),
        (None, 3, "2024", "3", "5", True), (None, 3, "2024", "4", "5", False), (2024, None, "2024", "3", "5", True),
        (2024, None, "2023", "3", "5", False), (None, None, "2024", "3", "5", True),
    ]
    cells = [{"year": y, "month": m, "dealYear": dy, "dealMonth": dm, "dealDay": dd, "buyerGbn": str(i), "dealAmount": str(i)} for i, (y, m, dy, dm, dd, _) in enumerate(given)]
    raw = spark.createDataFrame([tuple(c.get(f.name) for f in RAW_SCHEMA.fields) for c in cells], RAW_SCHEMA)
    kept = {r.deal_amount for r in marts.trades_from_raw(raw).collect()}
    assert kept == {i for i, row in enumerate(given) if row[-1]}
