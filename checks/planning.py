"""Keyspace, worklist and cycles over regions and months."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, rounded, table
from hanok.functions.paging import total_pages
from hanok.operators import worklist as wl
from hanok.operators.quality import code_list

ROWS_PER_PAGE = 4
LIMIT = 1500
MONTHS = 120


def codes(spark, sf):
    return code_list(table(spark, sf, "customer").selectExpr("lpad(c_nationkey, 5, '0') AS LAWD_CD"))


def last_day(spark, sf):
    return table(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate"))).scalar()


def pages(spark, sf):
    """Page totals per region and month from the number of orders."""
    o = table(spark, sf, "orders").selectExpr("o_custkey", "date_format(o_orderdate, 'yyyyMM') AS deal_ym")
    c = table(spark, sf, "customer").selectExpr("c_custkey", "lpad(c_nationkey, 5, '0') AS lawd_cd")
    counted = o.join(c, F.expr("o_custkey = c_custkey")).groupBy("lawd_cd", "deal_ym").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("lawd_cd", "deal_ym", "n", total_pages(F.col("n"), F.lit(ROWS_PER_PAGE)).alias("total_pages"))


CTES = f"""WITH code AS (SELECT lawd_cd, row_number() OVER (ORDER BY lawd_cd) - 1 AS i, count(*) OVER () AS n_codes
        FROM (SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS lawd_cd FROM customer)),
    month AS (SELECT strftime(m - INTERVAL (k) MONTH, '%Y%m') AS deal_ym, k
        FROM (SELECT date_trunc('month', max(o_orderdate)) AS m FROM orders), (SELECT unnest(generate_series(0, {MONTHS - 1})) AS k)),
    slot AS (SELECT lawd_cd, deal_ym, i AS lawd_idx, CAST(k AS BIGINT) AS ym_idx, k * n_codes + i AS slot_idx, n_codes * {MONTHS} AS total_slots
        FROM code, month),
    page AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS lawd_cd, strftime(o_orderdate, '%Y%m') AS deal_ym, count(*) AS n,
        CAST(ceil(count(*) / {ROWS_PER_PAGE}) AS INTEGER) AS total_pages
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def slots(spark, sf, newest_first=True):
    return wl.keyspace(codes(spark, sf), last_day(spark, sf), MONTHS, newest_first)


@check("j6_keyspace", f"{CTES} SELECT lawd_cd, deal_ym, CAST(slot_idx AS BIGINT) AS slot_idx, CAST(total_slots AS BIGINT) AS total_slots FROM slot")
def j6_keyspace(spark, sf):
    return slots(spark, sf).select("lawd_cd", "deal_ym", F.col("slot_idx").cast("bigint").alias("slot_idx"), F.col("total_slots").cast("bigint").alias("total_slots"))


@check(
    "w8_slot_index",
    f"""{CTES} SELECT lawd_cd, deal_ym, CAST(({MONTHS} - 1 - ym_idx) * (SELECT max(n_codes) FROM code) + lawd_idx AS BIGINT) AS slot_idx,
        CAST(lawd_idx AS BIGINT) AS lawd_idx FROM slot""",
)
def w8_slot_index(spark, sf):
    """Slot index with the oldest month first, and the code index got back from it."""
    s = slots(spark, sf, newest_first=False)
    return s.select(
        "lawd_cd", "deal_ym", F.col("slot_idx").cast("bigint").alias("slot_idx"),
        F.pmod("slot_idx", "n_codes").cast("bigint").alias("lawd_idx"),
    )


CURSOR = ("00003", "200104", 2)
DONE = "lawd_idx % 5 = 2"


def done(spark, sf):
    return slots(spark, sf).where(DONE).select("lawd_cd", "deal_ym")


CUT_SQL = f"""{CTES},
    start AS (SELECT coalesce(max(slot_idx), 0) AS s FROM slot WHERE lawd_cd = '{CURSOR[0]}' AND deal_ym = '{CURSOR[1]}'),
    work AS (SELECT slot.*, coalesce(total_pages, 1) AS pages,
            CASE WHEN lawd_cd = '{CURSOR[0]}' AND deal_ym = '{CURSOR[1]}' THEN {CURSOR[2]} ELSE 1 END AS first_page
        FROM slot LEFT JOIN page USING (lawd_cd, deal_ym), start WHERE slot_idx >= s AND NOT ({DONE})),
    used AS (SELECT *, greatest(pages - first_page + 1, 0) AS pages_left,
            sum(greatest(pages - first_page + 1, 0)) OVER (ORDER BY slot_idx) - greatest(pages - first_page + 1, 0) AS used_before FROM work),
    plan AS (SELECT *, least(pages_left, {LIMIT} - used_before) AS fetched FROM used WHERE used_before < {LIMIT})"""


def plan(spark, sf):
    return wl.crawl_plan(codes(spark, sf), last_day(spark, sf), pages(spark, sf), LIMIT, MONTHS, cursor=CURSOR, done=done(spark, sf))


@check(
    "crawl_worklist",
    f"""{CUT_SQL} SELECT lawd_cd, deal_ym, CAST(slot_idx AS BIGINT) AS slot_idx, first_page AS start_page, pages AS total_pages,
        CAST(used_before AS BIGINT) AS used_before, CAST(fetched AS BIGINT) AS fetched,
        round((slot_idx + (first_page + fetched - 2) / pages) / total_slots * 100, 6) AS percent FROM plan""",
)
def crawl_worklist(spark, sf):
    out = plan(spark, sf).select(
        "lawd_cd", "deal_ym", F.col("slot_idx").cast("bigint").alias("slot_idx"), "start_page", "total_pages",
        F.col("used_before").cast("bigint").alias("used_before"), F.col("fetched").cast("bigint").alias("fetched"), "percent",
    )
    return rounded(out, percent=6)


@check(
    "t7_quota_cut",
    f"{CUT_SQL} SELECT CAST(sum(fetched) AS BIGINT) AS requests, count(*) AS slots, CAST(max(slot_idx) AS BIGINT) AS last_slot FROM plan",
)
def t7_quota_cut(spark, sf):
    return plan(spark, sf).agg(
        F.sum("fetched").cast("bigint").alias("requests"), F.count(F.lit(1)).alias("slots"), F.max("slot_idx").cast("bigint").alias("last_slot")
    )


@check(
    "j7_resume_without_done",
    f"""{CTES} SELECT lawd_cd, deal_ym FROM slot WHERE slot_idx >= (SELECT coalesce(max(slot_idx), 0) FROM slot
        WHERE lawd_cd = '{CURSOR[0]}' AND deal_ym = '{CURSOR[1]}') AND NOT ({DONE})""",
)
def j7_resume_without_done(spark, sf):
    return wl.resume(slots(spark, sf), CURSOR[0], CURSOR[1], done(spark, sf)).select("lawd_cd", "deal_ym")


@check(
    "w11_next_slot",
    f"""{CTES} SELECT lawd_cd, deal_ym,
        coalesce(lead(lawd_cd) OVER (ORDER BY slot_idx), first_value(lawd_cd) OVER (ORDER BY slot_idx)) AS next_lawd_cd,
        coalesce(lead(deal_ym) OVER (ORDER BY slot_idx), first_value(deal_ym) OVER (ORDER BY slot_idx)) AS next_deal_ym FROM slot""",
)
def w11_next_slot(spark, sf):
    return wl.with_next_slot(slots(spark, sf)).select("lawd_cd", "deal_ym", "next_lawd_cd", "next_deal_ym")


@check(
    "r4_cycles",
    f"""{CTES} SELECT o_orderkey AS visit, CAST(o_orderkey // (SELECT max(total_slots) FROM slot) AS BIGINT) AS cycle,
        CAST(o_orderkey % (SELECT max(total_slots) FROM slot) AS BIGINT) AS slot_idx FROM orders""",
)
def r4_cycles(spark, sf):
    """Cycle and slot of every visit of an endless crawl, the order number standing in for the visit."""
    total = slots(spark, sf).agg(F.max("total_slots").cast("bigint").alias("n")).scalar()
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("visit")).withColumn("_n", total)
    return o.select("visit", wl.cycle_position(F.col("visit"), F.col("_n")).alias("p")).select("visit", "p.cycle", "p.slot_idx")


@check("f24_total_pages", f"{CTES} SELECT lawd_cd, deal_ym, n, total_pages FROM page")
def f24_total_pages(spark, sf):
    return pages(spark, sf)


@check(
    "f24_last_page_rule",
    f"{CTES} SELECT lawd_cd, deal_ym, p AS page_no, p * {ROWS_PER_PAGE} >= n AS is_last FROM page, (SELECT unnest([1, 2, 3]) AS p)",
)
def f24_last_page_rule(spark, sf):
    from hanok.functions.paging import is_last_page

    p = pages(spark, sf).withColumn("page_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return p.select("lawd_cd", "deal_ym", "page_no", is_last_page(F.col("page_no"), F.lit(ROWS_PER_PAGE), F.col("n")).alias("is_last"))


@check(
    "f25_suspect_pages",
    f"{CTES} SELECT lawd_cd, deal_ym, total_pages > 2 AND n % 3 = 0 AS suspect FROM page",
)
def f25_suspect_pages(spark, sf):
    """Page 2 of every slot, empty where the number of orders divides by three."""
    from hanok.functions.paging import is_suspect_page

    empty = F.when(F.col("n") % 3 == 0, 0).otherwise(5)
    return pages(spark, sf).select(
        "lawd_cd", "deal_ym", is_suspect_page(F.col("n"), F.lit(2), F.col("total_pages"), empty).alias("suspect")
    )
