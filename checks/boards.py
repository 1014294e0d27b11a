"""The published boards."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.marts import buckets, last12m, monthly
from checks.registry import check, names, rounded, sql, trades
from hanok.functions import scoring
from hanok.operators import sketches
from hanok.operators.joins import latest_only
from hanok.plans import boards, marts
from hanok.plans.refresh import board_catalog

BOARD_SQL = """SELECT deal_month_date, deal_year, deal_month, sggcd, region_ko, round(price, 4) AS median_ppsqm_krw, trades,
    round(mom, 6) AS mom_pct, round(yoy, 6) AS yoy_pct, round(ma24, 4) AS ma24, round(std24, 4) AS std24,
    round(tma12, 4) AS trades_ma12, round(mom3, 6) AS mom3_avg, round(vol12, 6) AS mom_vol_12m,
    round(gap, 6) AS valuation_gap_pct, round(z, 6) AS valuation_z, round(liq, 6) AS liquidity_ratio,
    round(score, 6) AS signal_score, state AS valuation_state, phase AS market_phase FROM board"""
BOARD_DIGITS = {
    "median_ppsqm_krw": 4, "mom_pct": 6, "yoy_pct": 6, "ma24": 4, "std24": 4, "trades_ma12": 4, "mom3_avg": 6,
    "mom_vol_12m": 6, "valuation_gap_pct": 6, "valuation_z": 6, "liquidity_ratio": 6, "signal_score": 6,
}


def board(spark, sf):
    return boards.region_decision_monthly(monthly(spark, sf), names(spark, sf))


@check("region_decision_monthly", sql(BOARD_SQL, "board"))
def region_decision_monthly(spark, sf):
    return rounded(board(spark, sf), **BOARD_DIGITS)


@check(
    "region_decision_latest",
    sql(BOARD_SQL + " WHERE trades >= 5 AND deal_month_date = (SELECT max(deal_month_date) FROM region_month)", "board"),
)
def region_decision_latest(spark, sf):
    m = monthly(spark, sf)
    # The newest month is looked up in the trades: the mart is not written here, and would be computed once more for it.
    valued = trades(spark, sf).where("ppsqm_krw IS NOT NULL")
    out = boards.region_decision_latest(boards.region_decision_monthly(m, names(spark, sf)), valued)
    return rounded(out, **BOARD_DIGITS)


TREND_DIGITS = dict.fromkeys(
    ["signal_score_median", "signal_score_avg", "valuation_gap_avg", "liquidity_ratio_avg", "mom3_avg", "yoy_avg"], 6
)


def _trend_sql(median: str) -> str:
    return sql(
        f"""SELECT deal_month_date, round({median}, 6) AS signal_score_median, round(avg(score), 6) AS signal_score_avg,
            round(avg(gap), 6) AS valuation_gap_avg, round(avg(liq), 6) AS liquidity_ratio_avg,
            round(avg(mom3), 6) AS mom3_avg, round(avg(yoy), 6) AS yoy_avg
        FROM board WHERE trades >= 5 GROUP BY deal_month_date""",
        "board",
    )


@check("national_signal_trend", _trend_sql("median(score)"))
def national_signal_trend(spark, sf):
    return rounded(boards.national_signal_trend(board(spark, sf), exact=True), **TREND_DIGITS)


@check("a4_approx_median_trend", _trend_sql("quantile_disc(score, 0.5)"))
def a4_approx_median_trend(spark, sf):
    return rounded(boards.national_signal_trend(board(spark, sf)), **TREND_DIGITS)


@check(
    "a3_monthly_averages",
    sql(
        """SELECT deal_month_date, round(avg(price), 4) AS price_avg, round(avg(trades), 4) AS trades_avg
        FROM region_month GROUP BY deal_month_date""",
        "region_month",
    ),
)
def a3_monthly_averages(spark, sf):
    out = monthly(spark, sf).groupBy("deal_month_date").agg(
        F.avg("median_ppsqm_krw").alias("price_avg"), F.avg("trades").alias("trades_avg")
    )
    return rounded(out, price_avg=4, trades_avg=4)


NATIONAL = sql(
    """SELECT deal_month_date, round(sum(price * trades) / sum(trades), 4) AS weighted_median_ppsqm_krw,
           CAST(sum(trades) AS BIGINT) AS trades FROM region_month GROUP BY deal_month_date""",
    "region_month",
)


@check("national_monthly_price", NATIONAL)
def national_monthly_price(spark, sf):
    return rounded(boards.national_monthly_price(monthly(spark, sf)), weighted_median_ppsqm_krw=4)


@check(
    "monthly_trades",
    sql("SELECT deal_month_date, count(*) AS trades FROM trade GROUP BY deal_month_date", "trade"),
)
def monthly_trades(spark, sf):
    return boards.monthly_trades(monthly(spark, sf))


@check(
    "latest_month_trades",
    sql(
        """SELECT deal_month_date, CAST(sum(trades) AS BIGINT) AS trades FROM region_month, newest
        WHERE deal_month_date = m GROUP BY deal_month_date""",
        "region_month",
    ),
)
def latest_month_trades(spark, sf):
    return boards.latest_month_trades(monthly(spark, sf))


@check(
    "region_last12_named",
    sql(
        """SELECT sggcd, coalesce(region_ko, sggcd) AS region_ko, round(price, 4) AS median_ppsqm_krw_12m, trades AS trades_12m
        FROM region_year LEFT JOIN names USING (sggcd)""",
        "region_year",
        "names",
    ),
)
def region_last12_named(spark, sf):
    return rounded(boards.region_last12_named(last12m(spark, sf), names(spark, sf)), median_ppsqm_krw_12m=4)


def _premium_sql(min_trades: int) -> str:
    return sql(
        f"""SELECT c.deal_month_date, c.sggcd, coalesce(n.region_ko, c.sggcd) AS region_ko, aptseq, aptnm,
            round(c.price, 4) AS complex_median_ppsqm_krw, round(r.price, 4) AS region_median_ppsqm_krw,
            round(c.price / nullif(r.price, 0), 6) AS premium_ratio, round(c.price - r.price, 4) AS premium_diff_krw,
            c.trades AS complex_trades
        FROM complex_month c JOIN region_month r ON r.sggcd = c.sggcd AND r.deal_month_date = c.deal_month_date
        JOIN newest ON c.deal_month_date = newest.m LEFT JOIN names n ON n.sggcd = c.sggcd WHERE c.trades >= {min_trades}""",
        "complex_month",
        "region_month",
        "names",
    )


PREMIUM_DIGITS = {
    "complex_median_ppsqm_krw": 4, "region_median_ppsqm_krw": 4, "premium_ratio": 6, "premium_diff_krw": 4,
}


@check("complex_premium_latest", _premium_sql(3))
def complex_premium_latest(spark, sf):
    out = boards.complex_premium_from_trades(trades(spark, sf), names(spark, sf))
    return rounded(out, **PREMIUM_DIGITS)


@check("j3_premium_all_complexes", _premium_sql(1))
def j3_premium_all_complexes(spark, sf):
    t = trades(spark, sf)
    out = boards.complex_premium_latest(marts.complex_monthly_median(t), monthly(spark, sf), names(spark, sf), min_trades=1)
    return rounded(out, **PREMIUM_DIGITS)


@check(
    "complex_gap_12m",
    sql(
        """SELECT c.sggcd, coalesce(n.region_ko, c.sggcd) AS region_ko, aptseq, aptnm,
            round(p, 4) AS complex_weighted_ppsqm_12m, round(r.price, 4) AS region_weighted_ppsqm_12m,
            round(p / nullif(r.price, 0), 6) AS gap_ratio_12m, round(p - r.price, 4) AS gap_diff_krw_12m, t AS complex_trades_12m
        FROM (SELECT aptseq, aptnm, sggcd, sum(price * trades) / sum(trades) AS p, CAST(sum(trades) AS BIGINT) AS t
              FROM bucket_year GROUP BY ALL HAVING sum(trades) >= 10) c
        JOIN region_year r ON r.sggcd = c.sggcd LEFT JOIN names n ON n.sggcd = c.sggcd""",
        "bucket_year",
        "region_year",
        "names",
    ),
)
def complex_gap_12m(spark, sf):
    out = boards.complex_gap_from_trades(trades(spark, sf), names(spark, sf), bucket=F.col("bucket"))
    return rounded(
        out, complex_weighted_ppsqm_12m=4, region_weighted_ppsqm_12m=4, gap_ratio_12m=6, gap_diff_krw_12m=4
    )


@check(
    "q22_composed_boards",
    sql(
        """SELECT 'region_decision_latest' AS dataset, count(*) AS n FROM board
        WHERE trades >= 5 AND deal_month_date = (SELECT max(deal_month_date) FROM region_month)
        UNION ALL SELECT 'national_signal_trend', count(DISTINCT deal_month_date) FROM board WHERE trades >= 5
        UNION ALL SELECT 'monthly_trades', count(DISTINCT deal_month_date) FROM board""",
        "board",
    ),
)
def q22_composed_boards(spark, sf):
    """Boards built by reference to each other: rows of three of them."""
    catalog = board_catalog({"region_monthly_stats": monthly(spark, sf), "region_names": names(spark, sf)})
    out = None
    for name in ("region_decision_latest", "national_signal_trend", "monthly_trades"):
        part = catalog.get(name).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "p8_threshold",
    sql("SELECT sggcd, deal_month_date, trades FROM region_month WHERE trades >= 20", "region_month"),
)
def p8_threshold(spark, sf):
    return monthly(spark, sf).where(F.col("trades") >= 20).select("sggcd", "deal_month_date", "trades")


@check(
    "p12_latest_period",
    sql("SELECT sggcd, trades FROM region_month WHERE deal_month_date = (SELECT m FROM newest)", "region_month"),
)
def p12_latest_period(spark, sf):
    return latest_only(monthly(spark, sf), "deal_month_date").select("sggcd", "trades")


@check(
    "p9_null_rejecting_join",
    sql(
        "SELECT r.sggcd, n.region_ko, r.trades FROM region_year r JOIN names n USING (sggcd) WHERE n.region_ko IS NOT NULL",
        "region_year",
        "names",
    ),
)
def p9_null_rejecting_join(spark, sf):
    joined = last12m(spark, sf).join(names(spark, sf), "sggcd", "left").where(F.col("region_ko").isNotNull())
    return joined.select("sggcd", "region_ko", F.col("trades_12m").alias("trades"))


@check(
    "j5_newest_month_join",
    sql(
        "SELECT aptseq, trades, m AS newest_month FROM complex_month, newest WHERE deal_month_date = m",
        "complex_month",
    ),
)
def j5_newest_month_join(spark, sf):
    t = trades(spark, sf)
    m = marts.complex_monthly_median(t)
    return m.where(F.col("deal_month_date") == marts.last_month_of(t)).select(
        "aptseq", "trades", F.col("deal_month_date").alias("newest_month")
    )


@check(
    "f10_gap_to_mean",
    sql(
        """SELECT sggcd, deal_month_date, round(price / nullif(avg(price) OVER (PARTITION BY deal_month_date), 0), 6) AS ratio,
            round(price - avg(price) OVER (PARTITION BY deal_month_date), 4) AS diff FROM region_month""",
        "region_month",
    ),
)
def f10_gap_to_mean(spark, sf):
    m = monthly(spark, sf)
    means = m.groupBy("deal_month_date").agg(F.avg("median_ppsqm_krw").alias("mean"))
    price, mean = F.col("median_ppsqm_krw"), F.col("mean")
    out = m.join(means, "deal_month_date").select(
        "sggcd", "deal_month_date", scoring.ratio(price, mean).alias("ratio"), (price - mean).alias("diff")
    )
    return rounded(out, ratio=6, diff=4)


@check(
    "a4_quantiles_from_sketches",
    sql(
        """SELECT 'nation' AS grain, NULL::VARCHAR AS sggcd, CAST(year(deal_month_date) AS INTEGER) AS year, count(*) AS trades, TRUE AS within_bound FROM trade, newest
            WHERE deal_month_date > newest.m - INTERVAL 180 MONTH GROUP BY 3
        UNION ALL SELECT 'region', sggcd, NULL, count(*), TRUE FROM trade, newest WHERE deal_month_date > newest.m - INTERVAL 180 MONTH GROUP BY 2""",
        "trade", "newest",
    ),
)
def a4_quantiles_from_sketches(spark, sf):
    """Quartiles of years and of regions from one set of sketches, and whether their ranks among all trades are within the stated error."""
    t = trades(spark, sf)
    made = marts.price_sketches(t)
    kept = marts.within_months(t, 180).select("sggcd", F.year("deal_month_date").alias("year"), "ppsqm_krw")
    error = 2 * sketches.rank_error()

    def judged(key, grain):
        found = boards.price_quantiles(made.withColumn("year", F.year("deal_month_date")), key)
        ranks = kept.join(found, key).groupBy(key, "trades").agg(
            *[F.avg((F.col("ppsqm_krw") < F.col(q)).cast("int")).alias(f"{q}_below") for q in boards.QUARTERS],
            *[F.avg((F.col("ppsqm_krw") <= F.col(q)).cast("int")).alias(f"{q}_upto") for q in boards.QUARTERS],
        )
        near = [(F.col(f"{q}_below") - error <= share) & (share <= F.col(f"{q}_upto") + error) for q, share in boards.QUARTERS.items()]
        sggcd, year = (F.col(c) if c == key else F.lit(None).cast(k) for c, k in (("sggcd", "string"), ("year", "int")))
        return ranks.select(F.lit(grain).alias("grain"), sggcd.alias("sggcd"), year.alias("year"), "trades", (near[0] & near[1] & near[2]).alias("within_bound"))

    return judged("year", "nation").unionByName(judged("sggcd", "region"))
