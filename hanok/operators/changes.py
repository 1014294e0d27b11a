"""Change detection between landed and fetched pages, run reports and completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hanok.functions.paging import content_fingerprint

PAGE_KEYS = ("lawd_cd", "deal_ym", "page_no")
PARTITION_KEYS = ("lawd_cd", "deal_ym")
ACTIONS = ("created", "updated", "unchanged", "skipped_empty")


def page_fingerprints(
    rows: DataFrame, content: Sequence[str], keys: Sequence[str] = PAGE_KEYS, position: str | None = None
) -> DataFrame:
    """One row per page: fingerprint and row count. Content never leaves the map side. ``position`` numbers a page's rows."""
    return rows.groupBy(*keys).agg(
        content_fingerprint(content, position).alias("fingerprint"), F.count(F.lit(1)).alias("row_count")
    )


def with_empty_pages(fingerprints: DataFrame, fetched: DataFrame, keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """All fetched pages; those without rows get a count of 0."""
    return fetched.select(*keys).join(fingerprints, list(keys), "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))


def page_changes(landed: DataFrame, fetched: DataFrame, keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """What a fetch does to every page: one of ``ACTIONS``, or ``kept`` for pages not fetched.

    Both sides are fingerprints, one short row per page.
    """
    old = landed.select(*keys, F.col("fingerprint").alias("old_fingerprint"))
    new = fetched.select(*keys, F.col("fingerprint").alias("new_fingerprint"), "row_count")
    return old.join(new, list(keys), "full_outer").withColumn(
        "action",
        F.when(F.col("row_count").isNull(), "kept")
        .when(F.col("row_count") == 0, "skipped_empty")
        .when(F.col("old_fingerprint").isNull(), "created")
        .when(F.col("old_fingerprint") == F.col("new_fingerprint"), "unchanged")
        .otherwise("updated"),
    )


def changed_partitions(changes: DataFrame) -> DataFrame:
    """Partitions with at least one page to write."""
    return changes.where(F.col("action").isin("created", "updated")).select(*PARTITION_KEYS).distinct()


def pages_to_land(fetched: DataFrame, landed: DataFrame, keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """Write-once rule: fetched pages with rows, unless the page is landed and not empty."""
    present = landed.where(F.col("size") > 0).select(*keys)
    return fetched.where(F.col("row_count") > 0).join(present, list(keys), "left_anti")


def without_stale_pages(pages: DataFrame, totals: DataFrame) -> DataFrame:
    """Drop pages above the newest page total of their partition."""
    current = totals.select(*PARTITION_KEYS, F.col("total_pages").alias("_total"))
    return (
        pages.join(current, list(PARTITION_KEYS), "left")
        .where(F.col("_total").isNull() | (F.col("page_no") <= F.col("_total")))
        .drop("_total")
    )


def mark_stale(changes: DataFrame, totals: DataFrame) -> DataFrame:
    """Pages above the newest total of their partition: ``removed`` where they were landed, ``stale`` where they only were fetched.

    ``changes`` comes from ``page_changes``, ``totals`` has one row per partition.
    """
    current = totals.select(*PARTITION_KEYS, F.col("total_pages").alias("_total"))
    above = F.col("page_no") > F.col("_total")
    gone = F.when(above & F.col("old_fingerprint").isNotNull(), "removed").when(above, "stale")
    return changes.join(current, list(PARTITION_KEYS), "left").withColumn("action", F.coalesce(gone, "action")).drop("_total")


def page_totals(visits: DataFrame) -> DataFrame:
    """(lawd_cd, deal_ym, total_pages) as the newest visit announced it; without ``fetched_at`` the greatest total counts."""
    newest = F.max_by("total_pages", F.struct("fetched_at", "total_pages")) if "fetched_at" in visits.columns else F.max("total_pages")
    return visits.groupBy(*PARTITION_KEYS).agg(newest.alias("total_pages"))


def seen_pages(visits: DataFrame) -> DataFrame:
    """Per partition ``total_pages``, ``last_page`` and ``missing``, the pages from 1 to the total that no visit saw, in whatever run.

    The lists hold one partition's page numbers, a few hundred at most.
    """
    newest = F.max_by("total_pages", F.struct("fetched_at", "total_pages")) if "fetched_at" in visits.columns else F.max("total_pages")
    seen = visits.groupBy(*PARTITION_KEYS).agg(F.max("page_no").alias("last_page"), newest.alias("total_pages"), F.collect_set("page_no").alias("_seen"))
    expected = F.when(F.col("total_pages") > 0, F.sequence(F.lit(1), F.col("total_pages"))).otherwise(F.array().cast("array<int>"))
    return seen.withColumn("missing", F.sort_array(F.array_except(expected, F.col("_seen").cast("array<int>")))).drop("_seen")


def completed_partitions(visits: DataFrame) -> DataFrame:
    """Partitions of which every page from 1 to the total was seen, from (lawd_cd, deal_ym, page_no, total_pages)."""
    return seen_pages(visits).where(F.size("missing") == 0).drop("missing")


def add_markers(status: DataFrame, completed: DataFrame) -> DataFrame:
    """Write-once completion markers: a partition that has one keeps it."""
    fresh = completed.select(*status.columns).join(status, list(PARTITION_KEYS), "left_anti")
    return status.unionByName(fresh)


def count_actions(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pages and pages per action."""
    return changes.groupBy(*by).agg(
        F.count_if(F.col("action") != "kept").alias("pages"),
        *[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS],
    )


def manifest_by_region(completed: DataFrame) -> DataFrame:
    """Completed partitions as JSON, one document per region (at most one entry per month)."""
    entry = F.struct("lawd_cd", "deal_ym")
    return completed.groupBy("lawd_cd").agg(
        F.to_json(F.array_sort(F.collect_list(entry))).alias("completed_partitions"),
        F.count(F.lit(1)).alias("partitions"),
    )


def run_manifest(completed: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """One run's manifest. A run completes at most as many partitions as its request quota.

    ``run`` is the run's one row with the other fields: ts, started_at, cycles_completed, cursor, percent, quota_used, quota_limit.
    """
    done = completed.agg(F.array_sort(F.collect_list(F.struct("lawd_cd", "deal_ym"))).alias("completed_partitions"))
    if run is None:
        return done
    fields = ("ts", "started_at", "cycles_completed", "cursor", "percent", "quota_used", "quota_limit")
    entries = done.scalar()
    return run.select(*fields, entries.alias("completed_partitions"))


def completeness(pages: DataFrame, status: DataFrame) -> DataFrame:
    """Audit every partition: landed pages against its completion marker."""
    found = pages.groupBy(*PARTITION_KEYS).agg(
        F.count_distinct("page_no").alias("page_count"), F.max("page_no").alias("last_page")
    )
    marked = status.select(*PARTITION_KEYS, F.col("total_pages").cast("int").alias("total_pages"))
    both = found.join(marked, list(PARTITION_KEYS), "full_outer")
    return both.withColumn(
        "finding",
        F.when(F.col("total_pages").isNull(), "no_marker")
        .when(F.col("page_count").isNull(), "marker_without_page")
        .when(F.col("last_page") > F.col("total_pages"), "stale_pages")
        .when(F.col("page_count") < F.col("total_pages"), "missing_pages")
        .otherwise("complete"),
    ).withColumn("page_count", F.coalesce("page_count", F.lit(0)))
