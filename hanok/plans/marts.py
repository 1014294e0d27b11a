"""From raw rows to typed trades and the monthly and twelve-month marts.

A trade is a row with ``sggcd, aptseq, aptnm, deal_date, deal_month_date, deal_amount,
area`` and ``ppsqm_krw``, the price per square metre.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hanok.functions import dates, text
from hanok.functions.paging import row_hash
from hanok.functions.scoring import ratio
from hanok.operators.medians import grouped_median, large_group_median, medians_by_grain, small_group_median
from hanok.operators.sketches import value_sketches

# Upper edges of the area buckets in square metres.
AREA_EDGES = (60, 85, 135)
# Amounts are in units of 10,000.
AMOUNT_UNIT = 10_000


def area_bucket(area: Column, edges: tuple[int, ...] = AREA_EDGES) -> Column:
    out = None
    for edge in edges:
        out = F.when(area <= edge, f"<={edge}") if out is None else out.when(area <= edge, f"<={edge}")
    return out.otherwise(f">{edges[-1]}")


def price_per_area(amount: Column, area: Column, unit: int = AMOUNT_UNIT) -> Column:
    return ratio(amount.cast("double") * unit, area.cast("double"))


# Raw columns that become part of a trade.
USED_COLUMNS = (
    "lawdCd", "sggCd", "estateAgentSggNm", "aptSeq", "aptNm", "aptDong", "jibun", "dealYear", "dealMonth", "dealDay", "dealAmount", "excluUseAr",
    "floor", "buildYear", "year", "month",
)


def trades_from_raw(raw: DataFrame) -> DataFrame:
    """Typed trades of the raw table: trimmed, cancelled ones removed, equal rows kept once.

    Two raw rows are one trade only if they agree in every column but the file they came from: the columns that are used are compared
    as they are, all of them by a digest of 128 bits, so that the others need not be shuffled. A row whose own date is outside its partition's month is not a trade (see ``misdated_rows``),
    so one mistyped year does not move the marts' windows. Columns are made in steps, so that no parser runs twice for one cell.
    """
    filled = lambda c: text.blank_to_null(F.col(c))
    whole = lambda c: text.lenient_long(F.col(c))
    compared = [c for c in raw.columns if c != "_file"]
    digest = [row_hash(compared, seed).alias(f"_digest{i}") for i, seed in enumerate((17, 71))]
    whole_rows = raw.where(filled("cdealType").isNull()).select(*USED_COLUMNS, *digest).distinct()
    cells = whole_rows.select(
        F.coalesce(filled("sggCd"), F.col("lawdCd")).alias("sggcd"),
        filled("estateAgentSggNm").alias("estateagentsggnm"),
        filled("aptSeq").alias("aptseq"),
        filled("aptNm").alias("aptnm"),
        filled("aptDong").alias("aptdong"),
        filled("jibun").alias("jibun"),
        whole("dealYear").alias("_y"),
        whole("dealMonth").alias("_m"),
        whole("dealDay").alias("_d"),
        whole("dealAmount").alias("deal_amount"),
        text.lenient_double(F.col("excluUseAr")).alias("area"),
        whole("floor").alias("floor"),
        whole("buildYear").alias("build_year"),
        "year",
        "month",
    )
    dated = cells.withColumn("deal_date", dates.loose_date(F.col("_y"), F.col("_m"), F.col("_d")))
    # A date that cannot be read says nothing against the partition. The optimizer moves this filter below ``distinct`` with all its
    # parsers in it, so it compares the numbers a readable date is made of and names the date once, last.
    inside = ((F.col("_y") == F.col("year")) & (F.col("_m") == F.col("month"))) | F.col("deal_date").isNull()
    return dated.where(F.coalesce(inside, F.lit(True))).drop("_y", "_m", "_d").withColumns(
        {
            "deal_month_date": dates.month_start(F.col("deal_date")),
            "ppsqm_krw": price_per_area(F.col("deal_amount"), F.col("area")),
        }
    )


def misdated_rows(raw: DataFrame) -> DataFrame:
    """Raw rows whose year or month is not their partition's: the rows that ``trades_from_raw`` leaves out, to be reported."""
    same = (text.lenient_long(F.col("dealYear")) == F.col("year")) & (text.lenient_long(F.col("dealMonth")) == F.col("month"))
    return raw.where(~F.coalesce(same, F.lit(True)))


def last_month_of(trades: DataFrame) -> Column:
    """The newest month with a trade, as a scalar."""
    return trades.agg(F.max("deal_month_date")).scalar()


def within_months(trades: DataFrame, months: int, last: Column | None = None) -> DataFrame:
    """Trades of the newest ``months`` months."""
    end = last_month_of(trades) if last is None else last
    return trades.where(F.col("deal_month_date") > F.add_months(end, -months))


def region_monthly_stats(trades: DataFrame, months: int = 180) -> DataFrame:
    """Median price and number of trades per region and month."""
    return large_group_median(
        within_months(trades, months), ["sggcd", "deal_month_date"], F.col("ppsqm_krw"), "median_ppsqm_krw", "trades"
    ).select(
        "sggcd", "deal_month_date",
        F.year("deal_month_date").alias("deal_year"), F.month("deal_month_date").alias("deal_month"),
        "median_ppsqm_krw", "trades",
    )


def complex_monthly_median(trades: DataFrame, months: int = 120, median: Callable[..., DataFrame] = grouped_median) -> DataFrame:
    """Median price and number of trades per complex and month; ``small_group_median`` suits trades that are a written table."""
    return median(
        within_months(trades, months),
        ["aptseq", "aptnm", "sggcd", "deal_month_date"],
        F.col("ppsqm_krw"),
        "median_ppsqm_krw",
        "trades",
    )


def region_last12m(trades: DataFrame) -> DataFrame:
    """Median price and trades per region over the newest twelve months."""
    return large_group_median(
        within_months(trades, 12), ["sggcd"], F.col("ppsqm_krw"), "median_ppsqm_krw_12m", "trades_12m"
    )


def complex_bucket_12m(trades: DataFrame, bucket: Column | None = None, median: Callable[..., DataFrame] = grouped_median) -> DataFrame:
    """Median price and trades per complex and area bucket over the newest twelve months; ``median`` as above."""
    bucket = area_bucket(F.col("area")) if bucket is None else bucket
    return median(
        within_months(trades, 12).withColumn("area_bucket", bucket),
        ["aptseq", "aptnm", "sggcd", "area_bucket"],
        F.col("ppsqm_krw"),
        "median_ppsqm_krw_12m",
        "trades_12m",
    )


# What the marts group by, and over how many of the newest months.
GRAINS = {
    "region_month": (("sggcd", "deal_month_date"), 180),
    "complex_month": (("aptseq", "aptnm", "sggcd", "deal_month_date"), 120),
    "region_year": (("sggcd",), 12),
    "bucket_year": (("aptseq", "aptnm", "sggcd", "area_bucket"), 12),
}


def all_medians(trades: DataFrame, bucket: Column | None = None, grains: dict[str, tuple[Sequence[str], int]] = GRAINS) -> DataFrame:
    """Medians and trades of every grain together: grain, its keys, median_ppsqm_krw, trades.

    Trades are read for the newest month and once more for all medians.
    """
    end, widest = last_month_of(trades), max(months for _, months in grains.values())
    rows = within_months(trades, widest, end).withColumn("area_bucket", area_bucket(F.col("area")) if bucket is None else bucket)
    # Of the grains over fewer months, those months; one of the others then has the month among its keys.
    newest = lambda months: None if months == widest else F.col("deal_month_date") > F.add_months(end, -months)
    chosen = {name: (keys, newest(months)) for name, (keys, months) in grains.items()}
    return medians_by_grain(rows, chosen, F.col("ppsqm_krw"), "median_ppsqm_krw", "trades")


def all_medians_of_table(trades: DataFrame, grains: dict[str, tuple[Sequence[str], int]] = GRAINS) -> DataFrame:
    """The rows of ``all_medians``, from trades that are a written table: cheap to read again, so each grain goes the way of its groups.

    Complexes have few trades each, which are shuffled once; regions have many, of which only those near the middle are.
    """
    every, end = list(dict.fromkeys(k for keys, _ in grains.values() for k in keys)), last_month_of(trades)

    def of(name: str, keys: Sequence[str], months: int) -> DataFrame:
        rows = within_months(trades, months, end).withColumn("area_bucket", area_bucket(F.col("area")))
        median = small_group_median if "aptseq" in keys else large_group_median
        found = median(rows, keys, F.col("ppsqm_krw"), "median_ppsqm_krw", "trades")
        kinds = dict(rows.dtypes)
        cells = [(F.col(k) if k in keys else F.lit(None).cast(kinds[k])).alias(k) for k in every]
        return found.select(F.lit(name).alias("grain"), *cells, "median_ppsqm_krw", "trades")

    return reduce(DataFrame.unionByName, [of(name, keys, months) for name, (keys, months) in grains.items()])


def marts_of(found: DataFrame) -> dict[str, DataFrame]:
    """The four marts, each with its own columns, from ``all_medians``."""
    grain = lambda name: found.where(F.col("grain") == name)
    year = (F.col("median_ppsqm_krw").alias("median_ppsqm_krw_12m"), F.col("trades").alias("trades_12m"))
    month = ("median_ppsqm_krw", "trades")
    parts = (F.year("deal_month_date").alias("deal_year"), F.month("deal_month_date").alias("deal_month"))
    return {
        "region_monthly_stats": grain("region_month").select("sggcd", "deal_month_date", *parts, *month),
        "complex_monthly_median": grain("complex_month").select("aptseq", "aptnm", "sggcd", "deal_month_date", *month),
        "region_last12m": grain("region_year").select("sggcd", *year),
        "complex_bucket_12m": grain("bucket_year").select("aptseq", "aptnm", "sggcd", "area_bucket", *year),
    }


def region_month_names(features: DataFrame, since_year: int = 2024) -> DataFrame:
    """The last name in order of every region and month that has a non-blank one.

    Names become distinct first: that step hashes, while a maximum of texts sorts its input.
    """
    named = features.where(text.blank_to_null(F.col("estateagentsggnm")).isNotNull() & (F.col("year") >= since_year))
    few = named.where("deal_month_date IS NOT NULL").select("sggcd", "deal_month_date", "estateagentsggnm").distinct()
    return few.groupBy("sggcd", "deal_month_date").agg(F.max("estateagentsggnm").alias("region_ko"))


def newest_names(by_month: DataFrame) -> DataFrame:
    """Each region's name in its latest month."""
    return by_month.groupBy("sggcd").agg(F.max_by("region_ko", "deal_month_date").alias("region_ko"))


def region_names(features: DataFrame, since_year: int = 2024) -> DataFrame:
    """Latest non-blank name per region; of several names in its latest month the last in order."""
    return newest_names(region_month_names(features, since_year))


def price_sketches(trades: DataFrame, months: int = 180) -> DataFrame:
    """A sketch of the prices per square metre per region and month: sggcd, deal_month_date, sketch, n."""
    return value_sketches(within_months(trades, months), ["sggcd", "deal_month_date"], F.col("ppsqm_krw"))


def reconcile(mart: DataFrame, trades: DataFrame, months: int) -> DataFrame:
    """Mart against source per month: trades counted in each, and their difference."""
    source = (
        within_months(trades, months).where(F.col("ppsqm_krw").isNotNull())
        .groupBy("deal_month_date").agg(F.count(F.lit(1)).alias("source_trades"))
    )
    counted = mart.groupBy("deal_month_date").agg(F.sum("trades").alias("mart_trades"))
    both = counted.join(source, "deal_month_date", "full_outer")
    return both.withColumn(
        "difference", F.coalesce("mart_trades", F.lit(0)) - F.coalesce("source_trades", F.lit(0))
    )
