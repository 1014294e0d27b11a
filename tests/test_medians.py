import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from hanok.operators.medians import grouped_median, large_group_median, small_group_median, split_median
from hanok.plans import marts


@pytest.fixture(scope="module")
def data():
    r = random.Random(7)
    rows = []
    for group, n in (("hot", 4001), ("even", 400), ("two", 2), ("one", 1), (None, 37)):
        for _ in range(n):
            rows.append((group, r.choice([r.gauss(0, 1000), float(r.randint(-3, 3)), 5.25, r.random() / 1e6])))
    rows += [("same", 4.5)] * 3000 + [("hot", None), ("nothing", None)]
    return rows


def brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: (statistics.median(v), len(v)) for g, v in groups.items()}


def test_exact_median_of_groups_of_every_size(spark, data):
    df = spark.createDataFrame(data, "g STRING, v DOUBLE")
    got = {r.g: (r.m, r.n) for r in grouped_median(df, ["g"], F.col("v"), "m", "n").collect()}
    assert got == brute(data)


def test_values_that_are_not_finite_are_ordered_like_a_sort_does(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", v) for v in (1.0, nan, inf, -inf, 2.0)] + [("b", nan)] + [("c", v) for v in (inf, 3.0)] + [(None, -inf)] + [("d", 7.0)] * 500
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    got = {r.g: (str(r.m), r.n) for r in grouped_median(df, ["g"], F.col("v"), "m", "n").collect()}
    assert got == {"a": ("2.0", 5), "b": ("nan", 1), "c": ("inf", 2), None: ("-inf", 1), "d": ("7.0", 500)}


def test_split_way_with_two_keys(spark):
    rows = [(a, b, float((a * 7 + b * 3 + i * i) % 101)) for a in range(3) for b in range(4) for i in range(50 + a + b)]
    df = spark.createDataFrame(rows, "a INT, b INT, v DOUBLE")
    got = {(r.a, r.b): (r.m, r.n) for r in split_median(df, ["a", "b"], "v", "m", "n").collect()}
    assert got == {k: v for k, v in brute([((a, b), v) for a, b, v in rows]).items()}


def test_median_of_large_groups_dealt_unevenly(spark, data):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(3, "v")
    got = {r.g: (r.m, r.n) for r in large_group_median(df, ["g"], F.col("v"), "m", "n").collect()}
    assert got == brute(data)
    # The middle ranks lie in two coarse buckets, in one, and in those of what is not finite.
    odd = [("far", 1.0), ("far", 900.0), ("near", 100.0), ("near", 100.001), ("nan", nan), ("nan", nan), ("inf", 3.0), ("inf", inf), ("low", -inf), ("low", -inf)]
    found = large_group_median(spark.createDataFrame(odd, "g STRING, v DOUBLE"), ["g"], F.col("v"), "m", "n").collect()
    assert {r.g: str(r.m) for r in found} == {"far": "450.5", "near": str((100.0 + 100.001) / 2), "nan": "nan", "inf": "inf", "low": "-inf"}


def test_region_marts_count_few_buckets_first_and_values_near_the_middle_only(spark):
    # 20,000 different prices of one region and month: a count of values would hold them all.
    trades = spark.range(20_000).selectExpr("'a' AS sggcd", "DATE'2024-01-01' AS deal_month_date", "1000 + id / 20 AS ppsqm_krw").repartition(3, "ppsqm_krw")
    for mart, median in ((marts.region_monthly_stats(trades), "median_ppsqm_krw"), (marts.region_last12m(trades), "median_ppsqm_krw_12m")):
        got = mart.collect()
        assert [r[median] for r in got] == [1000 + 19_999 / 40]
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"HashAggregate\(keys=\[[^\]]*_c#\d+L\], functions=\[partial_count\(1\)\]", plan)


def test_small_groups_are_sorted_and_those_of_crowded_slots_narrowed_down(spark, data):
    nan, inf = float("nan"), float("inf")
    rows = [("a", v) for v in (1.0, nan, inf, -inf, 2.0)] + [("b", nan)] + [("c", v) for v in (inf, 3.0)] + [("d", -0.0)]
    odd = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    df = spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(3, "v")
    for crowded in (1_000_000, 1000, 0):
        got = {r.g: (r.m, r.n) for r in small_group_median(df, ["g"], F.col("v"), "m", "n", crowded).collect()}
        assert got == brute(data)
        found = {r.g: (str(r.m), r.n) for r in small_group_median(odd, ["g"], F.col("v"), "m", "n", crowded).collect()}
        assert found == {"a": ("2.0", 5), "b": ("nan", 1), "c": ("inf", 2), "d": ("0.0", 1)}


def test_a_small_group_is_shuffled_once(spark):
    df = spark.range(1000).selectExpr("id % 300 AS g", "cast(id AS double) AS v")
    plan = small_group_median(df, ["g"], F.col("v"), "m", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_h#") == 1


def test_medians_of_a_table_are_those_of_one_count(spark):
    r = random.Random(3)
    cells = [
        (r.choice(["x", "y", None]), f"2024-{r.randint(1, 12):02d}-01" if r.random() < 0.9 else "2021-05-01", f"c{r.randint(1, 9)}", r.choice(["n", None]), r.choice([50.0, 70.0, 100.0, 200.0, None]), r.choice([None, r.randint(1, 30) / 4]))
        for _ in range(900)
    ]
    layout = "sggcd STRING, deal_month_date STRING, aptseq STRING, aptnm STRING, area DOUBLE, ppsqm_krw DOUBLE"
    trades = spark.createDataFrame(cells, layout).withColumn("deal_month_date", F.to_date("deal_month_date"))
    one, table = marts.all_medians(trades), marts.all_medians_of_table(trades)
    assert one.columns == table.columns and one.dtypes == table.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, table.collect()))
