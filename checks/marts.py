"""Marts and plain aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import all_trades, check, names, rounded, sql, table, trades
from hanok.functions import text
from hanok.functions.scoring import weighted_mean
from hanok.operators.quality import union_by_name
from hanok.plans import boards, marts
from hanok.schema import RAW_SCHEMA


def raw_rows(spark, sf):
    """Raw text rows with the noise the API shows: blanks and thousands commas."""
    t = all_trades(spark, sf)
    amount = F.regexp_replace(F.floor("deal_amount").cast("string"), r"(\d)(\d{3})$", "$1,$2")
    raw = t.select(
        F.concat(F.lit(" "), "sggcd").alias("sggCd"),
        F.concat("aptseq", F.lit(" ")).alias("aptSeq"),
        F.concat(F.lit(" "), "aptnm", F.lit(" ")).alias("aptNm"),
        F.concat(F.lit("  "), amount, F.lit(" ")).alias("dealAmount"),
        F.concat(F.lit(" "), F.col("area").cast("string")).alias("excluUseAr"),
        F.date_format("deal_date", "yyyy").alias("dealYear"),
        F.concat(F.lit(" "), F.month("deal_date").cast("string")).alias("dealMonth"),
        F.concat(F.dayofmonth("deal_date").cast("string"), F.lit(" ")).alias("dealDay"),
        F.when(F.col("flag") == "R", "O").otherwise(" ").alias("cdealType"),
        F.col("areaNo").cast("string").alias("floor"),
        F.col("orderkey").cast("string").alias("buyerGbn"),
        F.year("deal_date").alias("year"),
        F.month("deal_date").alias("month"),
    )
    typed = text.try_cast_to(raw, RAW_SCHEMA)
    # A second delivery of some pages, and rows with a mistyped year.
    again = union_by_name(typed, typed.where(F.col("floor") == "3"))
    return union_by_name(again, typed.where(F.col("floor") == "4").withColumn("dealYear", F.lit("2204")))


@check(
    "m1_trade_features",
    sql(
        """SELECT sggcd, aptseq, aptnm, deal_date, deal_month_date, CAST(price AS BIGINT) AS deal_amount, area,
               CAST(areaNo AS BIGINT) AS floor, CAST(year(deal_date) AS INTEGER) AS year, CAST(month(deal_date) AS INTEGER) AS month,
               round(price * 10000 / area, 4) AS ppsqm_krw
        FROM (SELECT DISTINCT orderkey, sggcd, aptseq, aptnm, deal_date, deal_month_date, floor(price) AS price, area, areaNo FROM trade)""",
        "trade",
    ),
)
def m1_trade_features(spark, sf):
    out = marts.trades_from_raw(raw_rows(spark, sf)).select(
        "sggcd", "aptseq", "aptnm", "deal_date", "deal_month_date", "deal_amount", "area", "floor", "year", "month", "ppsqm_krw"
    )
    return rounded(out, ppsqm_krw=4)


REGION_MONTH = sql(
    "SELECT sggcd, deal_month_date, deal_year, deal_month, round(price, 4) AS median_ppsqm_krw, trades FROM region_month",
    "region_month",
)


def monthly(spark, sf):
    return marts.region_monthly_stats(trades(spark, sf))


@check("region_monthly_stats", REGION_MONTH)
def region_monthly_stats(spark, sf):
    return rounded(monthly(spark, sf), median_ppsqm_krw=4)


@check("m2_region_monthly_hot_groups", REGION_MONTH)
def m2_region_monthly_hot_groups(spark, sf):
    """The same mart from trades that are dealt unevenly."""
    return rounded(marts.region_monthly_stats(trades(spark, sf).repartition(3, "area")), median_ppsqm_krw=4)


@check(
    "complex_monthly_median",
    sql(
        "SELECT aptseq, aptnm, sggcd, deal_month_date, round(price, 4) AS median_ppsqm_krw, trades FROM complex_month",
        "complex_month",
    ),
)
def complex_monthly_median(spark, sf):
    return rounded(marts.complex_monthly_median(trades(spark, sf)), median_ppsqm_krw=4)


def last12m(spark, sf):
    return marts.region_last12m(trades(spark, sf))


REGION_YEAR = sql("SELECT sggcd, round(price, 4) AS median_ppsqm_krw_12m, trades AS trades_12m FROM region_year", "region_year")


@check("region_last12m", REGION_YEAR)
def region_last12m(spark, sf):
    return rounded(last12m(spark, sf), median_ppsqm_krw_12m=4)


@check("m4_region_last12m_hot_groups", REGION_YEAR)
def m4_region_last12m_hot_groups(spark, sf):
    return rounded(marts.region_last12m(trades(spark, sf).repartition(3, "area")), median_ppsqm_krw_12m=4)


def buckets(spark, sf):
    return marts.complex_bucket_12m(trades(spark, sf), F.col("bucket"))


@check(
    "complex_bucket_12m",
    sql(
        """SELECT aptseq, aptnm, sggcd, bucket AS area_bucket, round(price, 4) AS median_ppsqm_krw_12m, trades AS trades_12m
        FROM bucket_year""",
        "bucket_year",
    ),
)
def complex_bucket_12m(spark, sf):
    return rounded(buckets(spark, sf), median_ppsqm_krw_12m=4)


@check(
    "mart_reconcile",
    sql(
        """SELECT deal_month_date, CAST(sum(trades) AS BIGINT) AS mart_trades,
               (SELECT count(*) FROM trade t WHERE t.deal_month_date = r.deal_month_date) AS source_trades,
               CAST(0 AS BIGINT) AS difference
        FROM region_month r GROUP BY deal_month_date""",
        "region_month",
    ),
)
def mart_reconcile(spark, sf):
    return marts.reconcile(monthly(spark, sf), trades(spark, sf), 180)


@check(
    "a1_sum_by_month",
    sql("SELECT deal_month_date, CAST(sum(trades) AS BIGINT) AS trades FROM region_month GROUP BY ALL", "region_month"),
)
def a1_sum_by_month(spark, sf):
    return boards.monthly_trades(monthly(spark, sf))


@check(
    "a2_weighted_mean",
    sql(
        "SELECT sggcd, round(sum(price * trades) / sum(trades), 4) AS weighted FROM region_month GROUP BY sggcd",
        "region_month",
    ),
)
def a2_weighted_mean(spark, sf):
    out = monthly(spark, sf).groupBy("sggcd").agg(weighted_mean(F.col("median_ppsqm_krw"), F.col("trades")).alias("weighted"))
    return rounded(out, weighted=4)


@check(
    "a5_max_scalar",
    sql("SELECT max(deal_month_date) AS newest FROM region_month", "region_month"),
)
def a5_max_scalar(spark, sf):
    return monthly(spark, sf).agg(F.max("deal_month_date").alias("newest"))


def features(spark, sf):
    """Trades with the name of the agent's region, blank or missing for some."""
    t = trades(spark, sf).withColumn("year", F.year("deal_date"))
    nation = table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("sggcd"), "n_name")
    agent = (
        F.when(F.col("areaNo") == 1, "  ")
        .when(F.col("areaNo") != 2, F.concat("n_name", F.lit(" "), F.col("areaNo").cast("string")))
    )
    return t.join(nation, "sggcd").withColumn("estateagentsggnm", agent)


REGION_NAMES = sql(
    """SELECT sggcd, max(n_name || ' ' || areaNo) AS region_ko
    FROM (SELECT *, max(deal_month_date) OVER (PARTITION BY sggcd) AS newest_month
          FROM trade JOIN nation ON CAST(sggcd AS INTEGER) = n_nationkey WHERE areaNo > 2 AND deal_date >= DATE '2000-01-01')
    WHERE deal_month_date = newest_month GROUP BY sggcd""",
    "trade",
)


@check("region_name_map", REGION_NAMES)
def region_name_map(spark, sf):
    return marts.region_names(features(spark, sf), since_year=2000)


@check(
    "a6_max_by_name",
    sql(
        """SELECT sggcd, max(n_name || ' ' || areaNo) AS region_ko
        FROM (SELECT *, max(deal_month_date) OVER (PARTITION BY sggcd) AS newest_month
              FROM trade JOIN nation ON CAST(sggcd AS INTEGER) = n_nationkey WHERE areaNo > 2)
        WHERE deal_month_date = newest_month GROUP BY sggcd""",
        "trade",
    ),
)
def a6_max_by_name(spark, sf):
    return marts.region_names(features(spark, sf), since_year=0)


@check(
    "a7_group_by_ordinals",
    sql(
        "SELECT aptseq, aptnm, sggcd, CAST(sum(trades) AS BIGINT) AS trades_12m FROM bucket_year GROUP BY 1, 2, 3",
        "bucket_year",
    ),
)
def a7_group_by_ordinals(spark, sf):
    return buckets(spark, sf).groupBy("aptseq", "aptnm", "sggcd").agg(F.sum("trades_12m").alias("trades_12m"))


@check("a14_count", sql("SELECT count(*) AS n FROM trade", "trade"))
def a14_count(spark, sf):
    return trades(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@check("a15_distinct_pairs", sql("SELECT DISTINCT complexNo, aptnm FROM trade", "trade"))
def a15_distinct_pairs(spark, sf):
    return trades(spark, sf).select("complexNo", "aptnm").distinct()


@check("a13_date_span", sql("SELECT min(deal_date) AS first_day, max(deal_date) AS last_day FROM trade", "trade"))
def a13_date_span(spark, sf):
    return trades(spark, sf).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@check(
    "a17_rows_per_folder",
    sql(
        """SELECT areaNo, CAST(year(deal_date) AS INTEGER) AS year, CAST(month(deal_date) AS INTEGER) AS month, count(*) AS n_rows
        FROM trade GROUP BY ALL""",
        "trade",
    ),
)
def a17_rows_per_folder(spark, sf):
    t = trades(spark, sf)
    return t.groupBy("areaNo", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    "m5_area_buckets",
    sql(
        """SELECT CASE WHEN area * 4 <= 60 THEN '<=60' WHEN area * 4 <= 85 THEN '<=85' WHEN area * 4 <= 135 THEN '<=135'
               ELSE '>135' END AS area_bucket, count(*) AS n FROM trade GROUP BY 1""",
        "trade",
    ),
)
def m5_area_buckets(spark, sf):
    return trades(spark, sf).groupBy(marts.area_bucket(F.col("area") * 4).alias("area_bucket")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "j2_region_name",
    sql(
        "SELECT sggcd, coalesce(region_ko, sggcd) AS region_ko, trades FROM region_year LEFT JOIN names USING (sggcd)",
        "region_year",
        "names",
    ),
)
def j2_region_name(spark, sf):
    from hanok.operators.joins import with_region_name

    return with_region_name(last12m(spark, sf), names(spark, sf)).select("sggcd", "region_ko", F.col("trades_12m").alias("trades"))


@check(
    "all_mart_medians",
    sql(
        """SELECT 'region_month' AS grain, sggcd, deal_month_date, NULL::VARCHAR AS aptseq, NULL::VARCHAR AS aptnm, NULL::VARCHAR AS area_bucket,
            round(price, 4) AS median_ppsqm_krw, trades FROM region_month
        UNION ALL SELECT 'complex_month', sggcd, deal_month_date, aptseq, aptnm, NULL, round(price, 4), trades FROM complex_month
        UNION ALL SELECT 'region_year', sggcd, NULL, NULL, NULL, NULL, round(price, 4), trades FROM region_year
        UNION ALL SELECT 'bucket_year', sggcd, NULL, aptseq, aptnm, bucket, round(price, 4), trades FROM bucket_year""",
        "region_month", "complex_month", "region_year", "bucket_year",
    ),
)
def all_mart_medians(spark, sf):
    """The medians of all marts from one histogram."""
    return rounded(marts.all_medians(trades(spark, sf), F.col("bucket")), median_ppsqm_krw=4)
