"""Window features one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.boards import board
from checks.marts import monthly
from checks.registry import check, rounded, sql, trades
from hanok.functions import scoring
from hanok.operators.timeseries import change_from, densify_months, price_features, series


def _feature(name: str, column: str, relation_column: str, digits: int) -> None:
    @check(
        name,
        sql(f"SELECT sggcd, deal_month_date, round({relation_column}, {digits}) AS {column} FROM feature", "feature"),
    )
    def query(spark, sf):
        return rounded(price_features(monthly(spark, sf)).select("sggcd", "deal_month_date", column), **{column: digits})


for _args in (
    ("w1_month_on_month", "mom_pct", "mom", 6),
    ("w2_year_on_year", "yoy_pct", "yoy", 6),
    ("w3_avg_24", "ma24", "ma24", 4),
    ("w4_stddev_24", "std24", "std24", 4),
    ("w5_trades_avg_12", "trades_ma12", "tma12", 4),
    ("w6_mom_avg_3", "mom3_avg", "mom3", 6),
    ("w7_mom_volatility_12", "mom_vol_12m", "vol12", 6),
):
    _feature(*_args)


@check(
    "w2_year_on_year_calendar",
    sql(
        """SELECT c.aptseq, c.deal_month_date, round(c.price / nullif(p.price, 0) - 1, 6) AS yoy
        FROM complex_month c LEFT JOIN complex_month p
          ON p.aptseq = c.aptseq AND p.deal_month_date = c.deal_month_date - INTERVAL 12 MONTH""",
        "complex_month",
    ),
)
def w2_year_on_year_calendar(spark, sf):
    """Year-on-year by calendar month, for series with gaps."""
    from hanok.plans.marts import complex_monthly_median

    m = complex_monthly_median(trades(spark, sf)).select("aptseq", "deal_month_date", "median_ppsqm_krw")
    full = densify_months(m, "aptseq")
    out = full.withColumn("yoy", change_from(F.col("median_ppsqm_krw"), 12, series("aptseq")))
    return rounded(out.where(F.col("median_ppsqm_krw").isNotNull()).select("aptseq", "deal_month_date", "yoy"), yoy=6)


@check(
    "f5_clip",
    sql(
        """SELECT sggcd, deal_month_date,
            round(greatest(-0.3::DOUBLE, least(0.3::DOUBLE, coalesce(yoy, 0))) / 0.3::DOUBLE, 6) AS share FROM feature""",
        "feature",
    ),
)
def f5_clip(spark, sf):
    f = price_features(monthly(spark, sf))
    out = f.select("sggcd", "deal_month_date", scoring.clipped_share(F.col("yoy_pct"), 0.30).alias("share"))
    return rounded(out, share=6)


@check("f6_signal_score", sql("SELECT sggcd, deal_month_date, round(score, 6) AS signal_score FROM scored", "scored"))
def f6_signal_score(spark, sf):
    return rounded(board(spark, sf).select("sggcd", "deal_month_date", "signal_score"), signal_score=6)


@check("f7_valuation_state", sql("SELECT sggcd, state AS valuation_state, count(*) AS n FROM board GROUP BY ALL", "board"))
def f7_valuation_state(spark, sf):
    return board(spark, sf).groupBy("sggcd", "valuation_state").agg(F.count(F.lit(1)).alias("n"))


@check("f8_market_phase", sql("SELECT sggcd, phase AS market_phase, count(*) AS n FROM board GROUP BY ALL", "board"))
def f8_market_phase(spark, sf):
    return board(spark, sf).groupBy("sggcd", "market_phase").agg(F.count(F.lit(1)).alias("n"))


@check(
    "f9_gap_z_liquidity",
    sql(
        """SELECT sggcd, deal_month_date, round(gap, 6) AS valuation_gap_pct, round(z, 6) AS valuation_z,
            round(liq, 6) AS liquidity_ratio FROM measure""",
        "measure",
    ),
)
def f9_gap_z_liquidity(spark, sf):
    out = board(spark, sf).select("sggcd", "deal_month_date", "valuation_gap_pct", "valuation_z", "liquidity_ratio")
    return rounded(out, valuation_gap_pct=6, valuation_z=6, liquidity_ratio=6)


@check(
    "p3_star_and_computed",
    sql(
        """SELECT sggcd, deal_month_date, deal_year, deal_month, round(price, 4) AS median_ppsqm_krw, trades,
            deal_year * 100 + deal_month AS ym FROM region_month""",
        "region_month",
    ),
)
def p3_star_and_computed(spark, sf):
    m = rounded(monthly(spark, sf), median_ppsqm_krw=4)
    return m.select("*", (F.col("deal_year") * 100 + F.col("deal_month")).alias("ym"))
