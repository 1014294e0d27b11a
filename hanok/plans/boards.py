"""The published boards over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hanok.functions import scoring
from hanok.operators.joins import latest_only, with_region_name
from hanok.operators.medians import approximate_median
from hanok.operators.sketches import merged, quantiles
from hanok.operators.timeseries import price_features
from hanok.plans import marts

# The board's columns in order.
BOARD_COLUMNS = (
    "deal_month_date", "deal_year", "deal_month", "sggcd", "region_ko", "median_ppsqm_krw", "trades",
    "mom_pct", "yoy_pct", "ma24", "std24", "trades_ma12", "mom3_avg", "mom_vol_12m",
    "valuation_gap_pct", "valuation_z", "liquidity_ratio", "signal_score", "valuation_state", "market_phase",
)


def region_decision_monthly(monthly: DataFrame, names: DataFrame) -> DataFrame:
    """Per region and month: momentum, valuation, liquidity and the composite score."""
    price, mean, deviation = F.col("median_ppsqm_krw"), F.col("ma24"), F.col("std24")
    board = (
        price_features(monthly)
        .withColumns(
            {
                "valuation_gap_pct": scoring.ratio(price - mean, mean),
                "valuation_z": scoring.ratio(price - mean, deviation),
                "liquidity_ratio": scoring.ratio(F.col("trades"), F.col("trades_ma12")),
                "valuation_state": scoring.valuation_state(price, mean, deviation),
            }
        )
        .withColumn(
            "signal_score",
            scoring.signal_score(F.col("yoy_pct"), F.col("mom3_avg"), F.col("liquidity_ratio"), F.col("valuation_z")),
        )
        .withColumn("market_phase", scoring.market_phase(F.col("signal_score")))
    )
    return with_region_name(board, names).select(*BOARD_COLUMNS)


def region_decision_latest(board: DataFrame, monthly: DataFrame, min_trades: int = 5) -> DataFrame:
    """The board's newest month, regions with enough trades. The month is looked up in ``monthly``: the mart, or the trades behind it."""
    return latest_only(board, "deal_month_date", monthly).where(F.col("trades") >= min_trades)


def national_signal_trend(board: DataFrame, min_trades: int = 5, exact: bool = False) -> DataFrame:
    """Monthly averages of the regional signals; the median is approximate unless ``exact``.

    A month holds one row per region, so the exact median's buffer is bounded by the regions.
    """
    middle = F.median("signal_score") if exact else approximate_median(F.col("signal_score"))
    return (
        board.where(F.col("trades") >= min_trades)
        .groupBy("deal_month_date")
        .agg(
            middle.alias("signal_score_median"),
            F.avg("signal_score").alias("signal_score_avg"),
            F.avg("valuation_gap_pct").alias("valuation_gap_avg"),
            F.avg("liquidity_ratio").alias("liquidity_ratio_avg"),
            F.avg("mom3_avg").alias("mom3_avg"),
            F.avg("yoy_pct").alias("yoy_avg"),
        )
    )


def national_monthly_price(monthly: DataFrame) -> DataFrame:
    """National price per month: the regions' medians weighted by their trades."""
    return monthly.groupBy("deal_month_date").agg(
        scoring.weighted_mean(F.col("median_ppsqm_krw"), F.col("trades")).alias("weighted_median_ppsqm_krw"),
        F.sum("trades").alias("trades"),
    )


QUARTERS = {"price_p25": 0.25, "price_p50": 0.5, "price_p75": 0.75}


def price_quantiles(price_sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Quartiles of the price per square metre and trades of any grouping of regions and months, from the sketch mart alone."""
    return quantiles(merged(price_sketches, by), QUARTERS).withColumnRenamed("n", "trades")


def monthly_trades(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("deal_month_date").agg(F.sum("trades").alias("trades"))


def latest_month_trades(monthly: DataFrame) -> DataFrame:
    """Trades of the newest month. The filter is on the month, so only that month is summed."""
    return monthly_trades(latest_only(monthly, "deal_month_date"))


def region_last12_named(last12: DataFrame, names: DataFrame) -> DataFrame:
    return with_region_name(last12, names).select("sggcd", "region_ko", "median_ppsqm_krw_12m", "trades_12m")


def complex_premium_latest(
    complexes: DataFrame, monthly: DataFrame, names: DataFrame, min_trades: int = 3
) -> DataFrame:
    """Complexes against their region in the newest month."""
    newest = complexes.agg(F.max("deal_month_date")).scalar()
    ours = complexes.where((F.col("deal_month_date") == newest) & (F.col("trades") >= min_trades)).select(
        "deal_month_date", "sggcd", "aptseq", "aptnm",
        F.col("median_ppsqm_krw").alias("complex_median_ppsqm_krw"), F.col("trades").alias("complex_trades"),
    )
    region = monthly.where(F.col("deal_month_date") == newest).select(
        "sggcd", F.col("median_ppsqm_krw").alias("region_median_ppsqm_krw")
    )
    both = ours.join(region, "sggcd", "left").where(F.col("region_median_ppsqm_krw").isNotNull())
    return _premium(both, names)


def complex_premium_from_trades(trades: DataFrame, names: DataFrame, min_trades: int = 3) -> DataFrame:
    """The same from the trades of the newest month, where no mart is written: both medians come from one histogram."""
    grains = {"complex": (("aptseq", "aptnm", "sggcd", "deal_month_date"), 1), "region": (("sggcd", "deal_month_date"), 1)}
    found = marts.all_medians(trades.withColumn("area", F.lit(None).cast("double")), grains=grains)
    both = _beside_region(found, "median_ppsqm_krw").select(
        "deal_month_date", "sggcd", "aptseq", "aptnm", F.col("median_ppsqm_krw").alias("complex_median_ppsqm_krw"),
        F.col("trades").alias("complex_trades"), F.col("_region").alias("region_median_ppsqm_krw"),
    )
    return _premium(both.where(F.col("complex_trades") >= min_trades), names)


def _beside_region(found: DataFrame, median: str) -> DataFrame:
    """The finer grain's rows with their region's median as ``_region``, without a join of the medians with themselves."""
    region = Window.partitionBy("sggcd")
    of_region = F.max(F.when(F.col("grain") == "region", F.col(median))).over(region)
    return found.withColumn("_region", of_region).where((F.col("grain") != "region") & F.col("_region").isNotNull())


def _premium(both: DataFrame, names: DataFrame) -> DataFrame:
    price, base = F.col("complex_median_ppsqm_krw"), F.col("region_median_ppsqm_krw")
    return with_region_name(both, names).select(
        "deal_month_date", "sggcd", "region_ko", "aptseq", "aptnm",
        "complex_median_ppsqm_krw", "region_median_ppsqm_krw",
        scoring.ratio(price, base).alias("premium_ratio"),
        (price - base).alias("premium_diff_krw"),
        "complex_trades",
    )


def complex_gap_12m(
    buckets: DataFrame, last12: DataFrame, names: DataFrame, min_trades: int = 10
) -> DataFrame:
    """Complexes against their region over twelve months; buckets weigh in by their trades."""
    ours = buckets.groupBy("aptseq", "aptnm", "sggcd").agg(
        scoring.weighted_mean(F.col("median_ppsqm_krw_12m"), F.col("trades_12m")).alias("complex_weighted_ppsqm_12m"),
        F.sum("trades_12m").alias("complex_trades_12m"),
    )
    region = last12.select("sggcd", F.col("median_ppsqm_krw_12m").alias("region_weighted_ppsqm_12m"))
    both = (
        ours.where(F.col("complex_trades_12m") >= min_trades)
        .join(region, "sggcd", "left")
        .where(F.col("region_weighted_ppsqm_12m").isNotNull())
    )
    return _gap(both, names)


def complex_gap_from_trades(trades: DataFrame, names: DataFrame, min_trades: int = 10, bucket: Column | None = None) -> DataFrame:
    """The same from the trades of the newest twelve months, where no mart is written: both medians come from one histogram."""
    grains = {"complex": (("aptseq", "aptnm", "sggcd", "area_bucket"), 12), "region": (("sggcd",), 12)}
    found = _beside_region(marts.all_medians(trades, bucket, grains), "median_ppsqm_krw")
    both = found.groupBy("aptseq", "aptnm", "sggcd").agg(
        scoring.weighted_mean(F.col("median_ppsqm_krw"), F.col("trades")).alias("complex_weighted_ppsqm_12m"),
        F.sum("trades").alias("complex_trades_12m"),
        F.max("_region").alias("region_weighted_ppsqm_12m"),
    )
    return _gap(both.where(F.col("complex_trades_12m") >= min_trades), names)


def _gap(both: DataFrame, names: DataFrame) -> DataFrame:
    price, base = F.col("complex_weighted_ppsqm_12m"), F.col("region_weighted_ppsqm_12m")
    return with_region_name(both, names).select(
        "sggcd", "region_ko", "aptseq", "aptnm", "complex_weighted_ppsqm_12m", "region_weighted_ppsqm_12m",
        scoring.ratio(price, base).alias("gap_ratio_12m"),
        (price - base).alias("gap_diff_krw_12m"),
        "complex_trades_12m",
    )
