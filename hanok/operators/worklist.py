"""Crawl planning over the keyspace region x month.

Codes are five digits, so there are at most 100,000 of them, and a plan covers a
stated number of months (120 by default). Ranks run over these two lists; running
sums are taken per month first, so no task orders the whole keyspace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hanok.functions import dates
from hanok.functions.paging import percent_position
from hanok.operators.joins import with_single_row


def ranked_codes(codes: DataFrame, code: str = "lawd_cd") -> DataFrame:
    """Codes with ``lawd_idx`` from 0 in code order and ``n_codes``."""
    ranked = codes.select(F.col(code).alias("lawd_cd"), (F.row_number().over(Window.orderBy(code)) - 1).alias("lawd_idx"))
    return with_single_row(ranked, codes.agg(F.count(F.lit(1)).alias("n")), {"n": "n_codes"})


def keyspace(codes: DataFrame, last_day: Column, months: int = 120, newest_first: bool = True) -> DataFrame:
    """Every (code, month) slot with its linear index; months are the slow axis."""
    # A column, because ``last_day`` may be a scalar subquery, which no lambda can hold.
    listed = dates.last_months(F.col("_last_day"), months)
    ordered = F.reverse(listed) if newest_first else listed
    return (
        ranked_codes(codes)
        .withColumn("_last_day", last_day)
        .select("lawd_cd", "lawd_idx", "n_codes", F.posexplode(ordered).alias("ym_idx", "deal_ym"))
        .withColumn("slot_idx", F.col("ym_idx") * F.col("n_codes") + F.col("lawd_idx"))
        .withColumn("total_slots", F.col("n_codes") * F.lit(months))
    )


def start_slot(slots: DataFrame, lawd_cd: str | None, deal_ym: str | None) -> Column:
    """Index of the cursor's slot; 0 without a cursor or where the plan no longer has it."""
    if not (lawd_cd and deal_ym):
        return F.lit(0).cast("long")
    at = slots.where((F.col("lawd_cd") == lawd_cd) & (F.col("deal_ym") == deal_ym))
    return F.coalesce(at.agg(F.max("slot_idx")).scalar(), F.lit(0).cast("long"))


def resume(slots: DataFrame, lawd_cd: str | None, deal_ym: str | None, done: DataFrame | None = None) -> DataFrame:
    """Slots from the cursor on, without those already complete."""
    ahead = slots.where(F.col("slot_idx") >= start_slot(slots, lawd_cd, deal_ym))
    if done is None:
        return ahead
    return ahead.join(done.select("lawd_cd", "deal_ym").distinct(), ["lawd_cd", "deal_ym"], "left_anti")


def with_pages(
    slots: DataFrame, pages: DataFrame, cursor: tuple[str, str, int] | None = None
) -> DataFrame:
    """Add ``total_pages`` (1 where unknown), ``start_page`` and ``pages_left`` of every slot."""
    known = slots.join(pages.select("lawd_cd", "deal_ym", "total_pages"), ["lawd_cd", "deal_ym"], "left")
    start = F.lit(1)
    if cursor:
        code, month, page = cursor
        start = F.when((F.col("lawd_cd") == code) & (F.col("deal_ym") == month), F.lit(page)).otherwise(F.lit(1))
    return (
        known.withColumn("total_pages", F.coalesce("total_pages", F.lit(1)))
        .withColumn("start_page", start)
        .withColumn("pages_left", F.greatest(F.col("total_pages") - F.col("start_page") + 1, F.lit(0)))
    )


def within_quota(work: DataFrame, limit: int) -> DataFrame:
    """Slots reached before ``limit`` requests are used, with the pages fetched in each.

    Adds ``used_before`` and ``fetched``; the last slot may be cut inside.
    """
    by_month = work.groupBy("ym_idx").agg(F.sum("pages_left").alias("_pages"))
    # One row per month of the plan.
    earlier = Window.orderBy("ym_idx").rowsBetween(Window.unboundedPreceding, -1)
    month_start = by_month.select("ym_idx", F.coalesce(F.sum("_pages").over(earlier), F.lit(0)).alias("_month_start"))
    in_month = Window.partitionBy("ym_idx").orderBy("lawd_idx").rowsBetween(Window.unboundedPreceding, -1)
    used = F.col("_month_start") + F.coalesce(F.sum("pages_left").over(in_month), F.lit(0))
    return (
        work.join(month_start, "ym_idx")
        .withColumn("used_before", used)
        .where(F.col("used_before") < limit)
        .withColumn("fetched", F.least(F.col("pages_left"), F.lit(limit) - F.col("used_before")))
        .drop("_month_start")
    )


def with_next_slot(slots: DataFrame, newest_first: bool = True) -> DataFrame:
    """Add the slot a cursor moves to after each slot, wrapping to the first one at the end."""
    ends = slots.agg(
        F.min("lawd_cd").alias("first_code"),
        (F.max("deal_ym") if newest_first else F.min("deal_ym")).alias("first_month"),
    )
    following = F.lead("lawd_cd").over(Window.partitionBy("deal_ym").orderBy("lawd_idx"))
    step = -1 if newest_first else 1
    next_month = dates.month_code(F.add_months(dates.month_from_code(F.col("deal_ym")), step))
    is_last = F.col("slot_idx") == F.col("total_slots") - 1
    return (
        with_single_row(slots, ends, {"first_code": "_first_code", "first_month": "_first_month"})
        .withColumn("_following", following)
        .withColumn("next_lawd_cd", F.coalesce("_following", F.col("_first_code")))
        .withColumn(
            "next_deal_ym",
            F.when(F.col("_following").isNotNull(), F.col("deal_ym"))
            .when(is_last, F.col("_first_month"))
            .otherwise(next_month),
        )
        .drop("_first_code", "_first_month", "_following")
    )


def with_percent(work: DataFrame) -> DataFrame:
    """Add ``percent``: the position after the last page fetched in the slot."""
    page = F.col("start_page") + F.col("fetched") - 1
    return work.withColumn("percent", percent_position(F.col("total_slots"), F.col("slot_idx"), page, F.col("total_pages")))


def crawl_plan(
    codes: DataFrame,
    last_day: Column,
    pages: DataFrame,
    limit: int,
    months: int = 120,
    newest_first: bool = True,
    cursor: tuple[str, str, int] | None = None,
    done: DataFrame | None = None,
) -> DataFrame:
    """One run's worklist: resume at the cursor, cut at the quota, with progress."""
    slots = keyspace(codes, last_day, months, newest_first)
    code, month, _ = cursor or (None, None, None)
    ahead = resume(slots, code, month, done)
    return with_percent(within_quota(with_pages(ahead, pages, cursor), limit))


def state_cursor(state: DataFrame, ignore_done: bool = False) -> tuple[bool, tuple[str, str, int] | None]:
    """Whether a backfill has work left, and its cursor, from the one-row state document.

    A finished backfill is left alone unless ``ignore_done``.
    """
    row = state.select("done", "cursor.lawd_cd", "cursor.deal_ym", F.coalesce("cursor.page_no", F.lit(1)).alias("page_no")).first()
    if row.done and not ignore_done:
        return False, None
    return True, (row.lawd_cd, row.deal_ym, row.page_no) if row.lawd_cd and row.deal_ym else None


def cycle_position(visit: Column, total_slots: Column) -> Column:
    """Cycle and slot of the n-th slot visit of an endless crawl."""
    return F.struct(F.floor(visit / total_slots).alias("cycle"), F.pmod(visit, total_slots).alias("slot_idx"))
