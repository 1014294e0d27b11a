"""First against last price of each complex and unit type, graded, mapped and animated.

Input rows are trades with ``complexNo, areaNo, date, dealPrice``; the complexes'
names and coordinates join after the aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hanok.functions import dates, scoring
from hanok.operators.joins import with_dimension, with_single_row
from hanok.operators.ranking import first_rows, ranked_values

UNIT = ("complexNo", "areaNo")
# Longitude step between the map columns of one complex.
OFFSET_STEP = 0.0002
MAP_HEIGHT = 1000


def in_period(trades: DataFrame, start: Column, end: Column, day: str = "date") -> DataFrame:
    """Trades from ``start`` to ``end``, both included."""
    return trades.where(F.col(day).between(start, end))


def daily_lowest(trades: DataFrame) -> DataFrame:
    """Lowest price per unit type and day: of trades on one day it stands for the day, at either end of a period."""
    return trades.groupBy(*UNIT, "date").agg(F.min("dealPrice").alias("_low"))


def first_and_last(trades: DataFrame) -> DataFrame:
    """Start and end price per unit type: the lowest of its first day and the lowest of its last.

    With one rule for both ends a unit type that traded on one day only has not changed.

    Days are aggregated first, so dates no longer tie and the second step
    combines before its shuffle too; neither step orders a group.
    """
    return daily_lowest(trades).groupBy(*UNIT).agg(
        F.min_by("_low", "date").alias("start_price"), F.max_by("_low", "date").alias("end_price")
    )


def with_change(prices: DataFrame) -> DataFrame:
    amount = F.col("end_price") - F.col("start_price")
    return prices.withColumns(
        {
            "price_change_rate": scoring.ratio(amount, F.col("start_price").cast("double")) * 100,
            "price_change_amount": amount,
        }
    )


RATE_STATS = (F.avg, "_mean"), (F.stddev_samp, "_deviation")


def _rate_stats(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return changes.groupBy(*by).agg(*[f("price_change_rate").alias(n) for f, n in RATE_STATS])


def _graded(changes: DataFrame) -> DataFrame:
    z = scoring.z_score(F.col("price_change_rate"), F.col("_mean"), F.col("_deviation"))
    return (
        changes.withColumn("z_score", z)
        .withColumn("performance_grade", scoring.performance_grade(F.col("z_score")))
        .drop("_mean", "_deviation")
    )


def price_changes(trades: DataFrame, complexes: DataFrame, start: Column, end: Column) -> DataFrame:
    """Graded price change of every unit type in a period. Grades are relative to all of them."""
    changes = with_change(first_and_last(in_period(trades, start, end)))
    graded = _graded(with_single_row(changes, _rate_stats(changes), {"_mean": "_mean", "_deviation": "_deviation"}))
    return with_dimension(graded, complexes.select("complexNo", "complexName", "latitude", "longitude"), "complexNo")


def only_areas(changes: DataFrame, areas: Sequence[int]) -> DataFrame:
    """Unit types of the chosen numbers; filters after grading, so grades stay relative to all."""
    return changes.where(F.col("areaNo").isin(*areas))


def price_trend(trades: DataFrame, complex_no: int, start: Column, end: Column, areas: Sequence[int]) -> DataFrame:
    """Mean price per day and unit type of one complex."""
    chosen = in_period(trades.where(F.col("complexNo") == complex_no), start, end).where(F.col("areaNo").isin(*areas))
    return chosen.groupBy("date", "areaNo").agg(F.avg("dealPrice").alias("dealPrice"))


def with_offset(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``longitude_offset``: columns of one complex stand side by side, by unit type rank."""
    if by:
        ranks = (
            changes.select(*by, "areaNo").distinct()
            .withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("areaNo")) - 1)
        )
    else:
        ranks = ranked_values(changes, "areaNo", "_rank")
    return (
        changes.join(ranks, [*by, "areaNo"], "left")
        .withColumn("longitude_offset", F.col("longitude") + F.coalesce("_rank", F.lit(0)) * OFFSET_STEP)
        .drop("_rank")
    )


def _height(value: Column, top: Column) -> Column:
    return value * F.when(top > 0, MAP_HEIGHT / top).otherwise(F.lit(float(MAP_HEIGHT)))


def _map_columns(changes: DataFrame, value: Column, top: Column) -> DataFrame:
    return changes.withColumns(
        {
            "elevation": _height(value, top),
            "color": scoring.grade_colour(F.col("performance_grade")),
            "tooltip_text": scoring.price_tooltip(
                F.col("complexName"), F.col("areaNo"), F.col("end_price"),
                F.col("price_change_rate"), F.col("price_change_amount"),
            ),
        }
    )


def map_layer(changes: DataFrame, by_rate: bool = False) -> DataFrame:
    """Map columns: offset, height, colour and hover text. Height shows the last price or the rate."""
    value = F.abs(F.col("price_change_rate")) if by_rate else F.col("end_price").cast("double")
    top = changes.agg(F.max(value).alias("top"))
    lifted = with_single_row(with_offset(changes), top, {"top": "_top"})
    return _map_columns(lifted, value, F.col("_top")).drop("_top")


def map_centre(changes: DataFrame) -> DataFrame:
    return changes.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def frame_bounds(start: Column, end: Column) -> tuple[Column, Column]:
    """First and last month that start inside the period; NULL where none does."""
    first = F.when(F.dayofmonth(start) == 1, start).otherwise(F.add_months(F.trunc(start, "month"), 1))
    return F.when(first <= end, first), F.when(first <= end, F.trunc(end, "month"))


def month_frames(start: Column, end: Column) -> Column:
    """(month, last day) of every month that starts in the period; the last frame ends with the period."""
    first, last = frame_bounds(start, end)
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.struct(m.alias("frame_month"), dates.frame_end(m, end).alias("frame_end")))


def price_change_frames(trades: DataFrame, complexes: DataFrame, start: Column, end: Column) -> DataFrame:
    """``price_changes`` from the fixed start to each month's end, for all months at once.

    The start price never changes once a unit type has traded, and the end price of a frame is
    that of the newest month up to it. So trades shrink to one row per unit type
    and month, gaps are filled forward, and no trade is repeated per frame.
    """
    first_frame, last_frame = frame_bounds(start, end)
    # Trades before the first frame's month count from the first frame on.
    month = F.greatest(F.trunc("date", "month"), first_frame)
    monthly = (
        daily_lowest(in_period(trades, start, end).where(first_frame.isNotNull()))
        .withColumn("frame_month", month)
        .groupBy(*UNIT, "frame_month")
        .agg(
            F.min_by("_low", "date").alias("_first"),
            F.max_by("_low", "date").alias("_last"),
        )
    )
    line = Window.partitionBy(*UNIT).orderBy("frame_month")
    # One row per month with trades; each stands until the next one, or until the period's last frame.
    lasting = monthly.select(
        *UNIT,
        F.first("_first").over(line).alias("start_price"),
        F.col("_last").alias("end_price"),
        F.sequence(
            F.col("frame_month"),
            F.greatest(
                F.col("frame_month"),
                F.coalesce(F.add_months(F.lead("frame_month").over(line), -1), last_frame),
            ),
            F.expr("interval 1 month"),
        ).alias("_months"),
    )
    changes = with_change(
        lasting.select(*UNIT, "start_price", "end_price", F.explode("_months").alias("frame_month"))
    ).withColumn("frame_end", dates.frame_end(F.col("frame_month"), end))
    # One row per frame.
    stats = _rate_stats(changes, ["frame_month"])
    graded = _graded(changes.join(stats, "frame_month"))
    return with_dimension(graded, complexes.select("complexNo", "complexName", "latitude", "longitude"), "complexNo")


def frame_layers(frames: DataFrame) -> DataFrame:
    """Map columns of every frame; offsets and heights are relative to the frame."""
    tops = frames.groupBy("frame_month").agg(F.max("end_price").cast("double").alias("_top"))
    lifted = with_offset(frames, ["frame_month"]).join(tops, "frame_month")
    return _map_columns(lifted, F.col("end_price").cast("double"), F.col("_top")).drop("_top")


def kpi(changes: DataFrame) -> DataFrame:
    return changes.agg(
        F.avg("price_change_rate").alias("mean_rate"),
        F.max("price_change_rate").alias("max_rate"),
        F.min("price_change_rate").alias("min_rate"),
        F.count(F.lit(1)).alias("units"),
    )


def top_bottom(changes: DataFrame, count: int = 10) -> DataFrame:
    """The best and the worst unit types by rate; ties go by complex and unit type."""
    ties = ["complexNo", "areaNo"]
    rated = changes.where(F.col("price_change_rate").isNotNull())
    best = first_rows(rated, count, [F.desc("price_change_rate"), *ties]).withColumn("side", F.lit("top"))
    worst = first_rows(rated, count, [F.asc("price_change_rate"), *ties]).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def trade_listing(trades: DataFrame, complexes: DataFrame, order: Sequence[Column | str], rows: int | None = None) -> DataFrame:
    """Trades with their complex, newest first.

    With a row count the newest trades are picked before the join, which then reads
    only them on the trade side; a left join on the complex's key adds none.
    """
    if rows is not None:
        return with_dimension(first_rows(trades, rows, order), complexes, "complexNo").orderBy(*order)
    return with_dimension(trades, complexes, "complexNo").orderBy(*order)


def avg_price_by_date(trades: DataFrame) -> DataFrame:
    return trades.groupBy("date").agg(F.avg("dealPrice").alias("avg_price"))
