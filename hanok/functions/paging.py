"""Paging arithmetic and page fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def total_pages(total: Column, rows_per_page: Column) -> Column:
    """Pages needed for ``total`` rows; never less than one."""
    return F.greatest(
        F.ceil(F.coalesce(total, F.lit(0)) / F.greatest(rows_per_page, F.lit(1))).cast("int"), F.lit(1)
    )


def is_last_page(page_no: Column, rows_per_page: Column, total: Column) -> Column:
    """Whether the pages read so far cover the announced total."""
    return page_no * rows_per_page >= total


def is_suspect_page(total: Column, page_no: Column, pages: Column, item_count: Column) -> Column:
    """An empty page before the last one: rows are announced but missing."""
    return (total > 0) & (page_no < pages) & (item_count == 0)


def percent_position(total_slots: Column, slot: Column, page_no: Column, pages: Column) -> Column:
    """Rough position in the whole keyspace in percent."""
    slots = total_slots.cast("double")
    within = F.when(
        (page_no != 0) & (pages > 0), (F.greatest(page_no, F.lit(1)) - 1) / pages.cast("double")
    ).otherwise(F.lit(0.0))
    clamped = F.greatest(F.least(slot, total_slots), F.lit(0))
    return F.when(total_slots > 0, (clamped + F.coalesce(within, F.lit(0.0))) / slots * 100).otherwise(F.lit(0.0))


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of a row that tells NULLs apart by their places."""
    if len(columns) > 62:
        raise ValueError("at most 62 columns")
    # Spark's hash passes over NULLs, so their places are hashed as a number of their own.
    places = " + ".join(f"if(`{c}` IS NULL, {2**i}L, 0L)" for i, c in enumerate(columns))
    cells = ", ".join(f"`{c}`" for c in columns)
    return F.expr(f"xxhash64({seed}, {cells}, {places})")


def content_fingerprint(columns: Sequence[str], position: str | None = None) -> Column:
    """Aggregate fingerprint of a group of rows: 32 hex digits.

    With ``position``, the column that numbers a page's rows, each row is hashed with its place, so a reordered page is another
    one; without it the order of rows does not matter.

    Two 64-bit hashes of every row are summed, so a page is compared
    without ever gathering its rows in one place: the sums combine before the
    shuffle, and a huge page costs one small buffer. A repeated row does not cancel out. Both sides of a comparison need the
    same column types.
    """
    columns = [*columns, position] if position else columns
    sums = [F.coalesce(F.sum(row_hash(columns, seed).cast("decimal(20, 0)")).cast("string"), F.lit("0")) for seed in (17, 71)]
    return F.md5(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums))
