"""Window features of monthly series. All share one partitioning and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from hanok.functions.scoring import relative_change


def series(key: str = "sggcd", month: str = "deal_month_date") -> WindowSpec:
    return Window.partitionBy(key).orderBy(month)


def trailing(rows: int, key: str = "sggcd", month: str = "deal_month_date") -> WindowSpec:
    """The current row and those before it, ``rows`` in all."""
    return series(key, month).rowsBetween(1 - rows, 0)


def change_from(value: Column, rows_back: int, spec: WindowSpec) -> Column:
    """Relative change against the row ``rows_back`` earlier, whatever its month."""
    return relative_change(value, F.lag(value, rows_back).over(spec))


def price_features(monthly: DataFrame, key: str = "sggcd") -> DataFrame:
    """Add change, moving averages and volatility to a (key, month) series."""
    spec = series(key)
    price, trades = F.col("median_ppsqm_krw"), F.col("trades")
    first = monthly.withColumns(
        {
            "mom_pct": change_from(price, 1, spec),
            "yoy_pct": change_from(price, 12, spec),
            "ma24": F.avg(price).over(trailing(24, key)),
            "std24": F.stddev_samp(price).over(trailing(24, key)),
            "trades_ma12": F.avg(trades).over(trailing(12, key)),
        }
    )
    return first.withColumns(
        {
            "mom3_avg": F.avg("mom_pct").over(trailing(3, key)),
            "mom_vol_12m": F.stddev_samp("mom_pct").over(trailing(12, key)),
        }
    )


def densify_months(monthly: DataFrame, key: str = "sggcd", month: str = "deal_month_date") -> DataFrame:
    """Give every key each month between its first and last one; new rows carry NULLs.

    Makes row-based lags calendar-based: ``change_from(..., 12, ...)`` on the result
    always compares with the same month a year before.
    """
    span = monthly.groupBy(key).agg(F.min(month).alias("_lo"), F.max(month).alias("_hi"))
    grid = span.select(key, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias(month))
    return grid.join(monthly, [key, month], "left")
