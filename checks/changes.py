"""Page change detection, manifests and audits on pages made from the trades."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import all_trades, check, rounded, sql
from hanok.functions import dates, text
from hanok.functions.paging import percent_position
from hanok.operators import changes as ch
from hanok.operators.joins import not_listed, only_listed

CONTENT = ["orderkey", "partkey", "cents", "area"]


def page_rows(spark, sf):
    """Trades as page items: region, month, and the unit type as page number."""
    t = all_trades(spark, sf)
    return t.select(
        F.col("sggcd").alias("lawd_cd"),
        dates.month_code(F.col("deal_date")).alias("deal_ym"),
        F.col("areaNo").alias("page_no"),
        "orderkey", "partkey", F.round(F.col("deal_amount") * 100).cast("bigint").alias("cents"),
        F.col("area").cast("bigint").alias("area"), "tax",
    )


def landed(spark, sf):
    return page_rows(spark, sf).where(F.col("deal_ym") < "200007")


def fetched(spark, sf):
    corrected = F.col("deal_ym").between("200003", "200006") & (F.col("tax") >= 0.04)
    return page_rows(spark, sf).where((F.col("deal_ym") >= "200001") & ~corrected)


def page_changes_of(spark, sf):
    asked = page_rows(spark, sf).where(F.col("deal_ym") >= "200001").select(*ch.PAGE_KEYS).distinct()
    new = ch.with_empty_pages(ch.page_fingerprints(fetched(spark, sf), CONTENT), asked)
    return ch.page_changes(ch.page_fingerprints(landed(spark, sf), CONTENT), new)


@check("page_changes", sql("SELECT lawd_cd, deal_ym, page_no, action FROM change", "change"))
def page_changes(spark, sf):
    return page_changes_of(spark, sf).select(*ch.PAGE_KEYS, "action")


@check("k10_actions_by_region", sql(
    """SELECT lawd_cd, count(*) FILTER (action <> 'kept') AS pages, count(*) FILTER (action = 'created') AS created,
        count(*) FILTER (action = 'updated') AS updated, count(*) FILTER (action = 'unchanged') AS unchanged,
        count(*) FILTER (action = 'skipped_empty') AS skipped_empty FROM change GROUP BY lawd_cd""", "change"))  # fmt: skip
def k10_actions_by_region(spark, sf):
    return ch.count_actions(page_changes_of(spark, sf), ["lawd_cd"])


@check("run_summary", sql(
    """SELECT count(*) FILTER (action <> 'kept') AS pages, count(*) FILTER (action = 'created') AS created,
        count(*) FILTER (action = 'updated') AS updated, count(*) FILTER (action = 'unchanged') AS unchanged,
        count(*) FILTER (action = 'skipped_empty') AS skipped_empty,
        round(count(*) FILTER (action <> 'kept') / count(*) * 100.0::DOUBLE, 6) AS percent FROM change""", "change"))  # fmt: skip
def run_summary(spark, sf):
    all_pages = page_changes_of(spark, sf)
    out = all_pages.agg(
        F.count_if(F.col("action") != "kept").alias("pages"),
        *[F.count_if(F.col("action") == a).alias(a) for a in ch.ACTIONS],
        (F.count_if(F.col("action") != "kept") / F.count(F.lit(1)) * 100).alias("percent"),
    )
    return rounded(out, percent=6)


@check("a16_action_counts", sql("SELECT action, count(*) AS n FROM change GROUP BY action", "change"))
def a16_action_counts(spark, sf):
    return page_changes_of(spark, sf).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@check("r5_changed_partitions", sql("SELECT DISTINCT lawd_cd, deal_ym FROM change WHERE action IN ('created', 'updated')", "change"))
def r5_changed_partitions(spark, sf):
    """Partitions to replace after late corrections."""
    return ch.changed_partitions(page_changes_of(spark, sf))


@check("r3_repeated_delivery", sql("SELECT count(*) AS pages, 0::BIGINT AS written FROM (SELECT DISTINCT lawd_cd, deal_ym, page_no FROM pages_all)", "pages_all"))
def r3_repeated_delivery(spark, sf):
    """The same pages delivered again, in another row order: nothing to write."""
    rows = page_rows(spark, sf)
    once = ch.page_fingerprints(rows, CONTENT)
    again = ch.page_fingerprints(rows.repartition(5, "partkey"), CONTENT)
    out = ch.page_changes(once, again)
    return out.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("action") != "unchanged").alias("written"))


@check("k9_write_once", sql(
    """SELECT DISTINCT lawd_cd, deal_ym, page_no FROM pages_all p WHERE deal_ym >= '200001'
        AND (deal_ym >= '200007' OR page_no = 7)""", "pages_all"))  # fmt: skip
def k9_write_once(spark, sf):
    """Pages to land: not there yet, or there with size 0 (page 7 of every partition)."""
    there = ch.page_fingerprints(landed(spark, sf), CONTENT).withColumn(
        "size", F.when(F.col("page_no") == 7, F.lit(0)).otherwise(F.col("row_count"))
    )
    new = ch.page_fingerprints(page_rows(spark, sf).where(F.col("deal_ym") >= "200001"), CONTENT)
    return ch.pages_to_land(new, there).select(*ch.PAGE_KEYS)


def visits(spark, sf):
    """Pages seen, with a page total that odd months announce too high."""
    pages = page_rows(spark, sf).select(*ch.PAGE_KEYS).distinct()
    return pages.withColumn("total_pages", F.when(F.col("deal_ym").substr(6, 1).cast("int") % 2 == 1, 8).otherwise(7))


TOTAL = "max(CASE WHEN CAST(substr(deal_ym, 6, 1) AS INT) % 2 = 1 THEN 8 ELSE 7 END)"
COMPLETED = f"""SELECT lawd_cd, deal_ym, max(page_no) AS last_page, {TOTAL} AS total_pages
    FROM pages_all GROUP BY ALL HAVING count(DISTINCT page_no) >= {TOTAL}"""


@check("k12_completed_partitions", sql(COMPLETED, "pages_all"))
def k12_completed_partitions(spark, sf):
    return ch.completed_partitions(visits(spark, sf))


@check("run_manifest", sql(
    f"""SELECT lawd_cd, '[' || string_agg('{{"lawd_cd":"' || lawd_cd || '","deal_ym":"' || deal_ym || '"}}', ',' ORDER BY deal_ym) || ']' AS completed_partitions,
        count(*) AS partitions FROM ({COMPLETED}) GROUP BY lawd_cd""", "pages_all"))  # fmt: skip
def run_manifest(spark, sf):
    return ch.manifest_by_region(ch.completed_partitions(visits(spark, sf)))


@check("partition_semi_scan", sql(
    f"SELECT lawd_cd, deal_ym, count(*) AS n FROM pages_all JOIN ({COMPLETED}) USING (lawd_cd, deal_ym) GROUP BY ALL", "pages_all"))
def partition_semi_scan(spark, sf):
    """Rows of the partitions a manifest lists."""
    listed = ch.completed_partitions(visits(spark, sf))
    rows = only_listed(page_rows(spark, sf), listed, ["lawd_cd", "deal_ym"])
    return rows.groupBy("lawd_cd", "deal_ym").agg(F.count(F.lit(1)).alias("n"))


@check("s3_partitions_without_marker", sql(
    f"SELECT DISTINCT lawd_cd, deal_ym FROM pages_all ANTI JOIN ({COMPLETED}) USING (lawd_cd, deal_ym)", "pages_all"))
def s3_partitions_without_marker(spark, sf):
    pages = page_rows(spark, sf).select("lawd_cd", "deal_ym").distinct()
    return not_listed(pages, ch.completed_partitions(visits(spark, sf)), ["lawd_cd", "deal_ym"])


def status(spark, sf):
    """Completion markers: none for the first region, one page too few or too many for some months."""
    partitions = page_rows(spark, sf).select("lawd_cd", "deal_ym").distinct().where(F.col("lawd_cd") != "00000")
    last_digit = F.col("deal_ym").substr(6, 1)
    total = F.when(last_digit == "3", 6).when(last_digit == "5", 8).otherwise(7)
    # Markers of months a year on, which have no pages after the tables end.
    later = dates.month_code(F.add_months(dates.month_from_code(F.col("deal_ym")), 120))
    return partitions.withColumn("total_pages", total).unionByName(
        partitions.where(F.col("deal_ym") >= "200007").withColumn("deal_ym", later).withColumn("total_pages", F.lit(1))
    )


STATUS = """SELECT DISTINCT lawd_cd, deal_ym, CASE substr(deal_ym, 6, 1) WHEN '3' THEN 6 WHEN '5' THEN 8 ELSE 7 END AS total_pages
    FROM pages_all WHERE lawd_cd <> '00000'
    UNION ALL SELECT DISTINCT lawd_cd, strftime(strptime(deal_ym, '%Y%m') + INTERVAL 120 MONTH, '%Y%m'), 1
    FROM pages_all WHERE lawd_cd <> '00000' AND deal_ym >= '200007'"""


@check("completeness_audit", sql(
    f"""SELECT lawd_cd, deal_ym, coalesce(n, 0) AS page_count, total_pages,
        CASE WHEN total_pages IS NULL THEN 'no_marker' WHEN n IS NULL THEN 'marker_without_page' WHEN top > total_pages THEN 'stale_pages'
             WHEN n < total_pages THEN 'missing_pages' ELSE 'complete' END AS finding
        FROM (SELECT lawd_cd, deal_ym, count(DISTINCT page_no) AS n, max(page_no) AS top FROM pages_all GROUP BY ALL)
        FULL JOIN ({STATUS}) USING (lawd_cd, deal_ym)""", "pages_all"))  # fmt: skip
def completeness_audit(spark, sf):
    pages = page_rows(spark, sf).select(*ch.PAGE_KEYS)
    return ch.completeness(pages, status(spark, sf)).select("lawd_cd", "deal_ym", "page_count", "total_pages", "finding")


@check("k11_add_markers", sql(
    f"""SELECT lawd_cd, deal_ym, total_pages FROM ({STATUS})
        UNION ALL SELECT lawd_cd, deal_ym, total_pages FROM ({COMPLETED}) ANTI JOIN ({STATUS}) USING (lawd_cd, deal_ym)""", "pages_all"))  # fmt: skip
def k11_add_markers(spark, sf):
    return ch.add_markers(status(spark, sf), ch.completed_partitions(visits(spark, sf)))


@check("r1_without_stale_pages", sql(
    f"""SELECT DISTINCT p.lawd_cd, p.deal_ym, p.page_no FROM pages_all p LEFT JOIN ({STATUS}) s USING (lawd_cd, deal_ym)
        WHERE s.total_pages IS NULL OR p.page_no <= s.total_pages""", "pages_all"))  # fmt: skip
def r1_without_stale_pages(spark, sf):
    return ch.without_stale_pages(page_rows(spark, sf).select(*ch.PAGE_KEYS).distinct(), status(spark, sf))


@check("f27_page_fingerprint", sql(
    """SELECT lawd_cd, deal_ym, page_no, count(*) OVER (PARTITION BY body) AS same_content
        FROM (SELECT lawd_cd, deal_ym, page_no, string_agg(CAST(area AS BIGINT) || '/' || (tax > 0.06), ',' ORDER BY area, tax > 0.06) AS body
              FROM pages_all GROUP BY lawd_cd, deal_ym, page_no)""", "pages_all"))  # fmt: skip
def f27_page_fingerprint(spark, sf):
    """Pages with the same fingerprint have the same rows: how many share a page's content."""
    rows = page_rows(spark, sf).withColumn("high", F.col("tax") > 0.06)
    prints = ch.page_fingerprints(rows, ["area", "high"])
    shared = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("same_content"))
    return prints.join(shared, "fingerprint").select(*ch.PAGE_KEYS, "same_content")


@check("f28_plain_etag", sql(
    """SELECT DISTINCT orderkey, CASE WHEN orderkey % 3 > 0 THEN md5(CAST(orderkey AS VARCHAR)) END AS etag FROM all_trade""", "all_trade"))  # fmt: skip
def f28_plain_etag(spark, sf):
    digest = F.md5(F.col("orderkey").cast("string"))
    tag = (
        F.when(F.col("orderkey") % 3 == 1, F.concat(F.lit('"'), digest, F.lit('"')))
        .when(F.col("orderkey") % 6 == 0, F.concat(F.lit('"'), digest, F.lit('-3"')))
        .when(F.col("orderkey") % 3 == 0, F.substring(digest, 1, 20))
        .otherwise(digest)
    )
    return all_trades(spark, sf).select("orderkey", text.plain_etag(tag).alias("etag")).distinct()


@check("f26_percent_position", sql(
    """SELECT lawd_cd, deal_ym, page_no, round((CAST(lawd_cd AS INT) + (page_no - 1) / 7.0::DOUBLE) / 25 * 100, 6) AS percent
        FROM (SELECT DISTINCT lawd_cd, deal_ym, page_no FROM pages_all)""", "pages_all"))  # fmt: skip
def f26_percent_position(spark, sf):
    pages = page_rows(spark, sf).select(*ch.PAGE_KEYS).distinct()
    percent = percent_position(F.lit(25), F.col("lawd_cd").cast("int"), F.col("page_no"), F.lit(7))
    return rounded(pages.withColumn("percent", percent), percent=6)
