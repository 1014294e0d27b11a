"""The run log over pages made from the trades: one run per year, summary, manifest, gaps and the point to resume at."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from checks.changes import CONTENT, page_rows
from checks.planning import CTES, slots
from checks.registry import check, rounded, sql
from hanok.functions import dates
from hanok.operators import changes as ch, ledger as lg

OUTCOMES = ("created", "updated", "unchanged", "skipped_empty", "error")


def with_slots(body: str, *relations: str) -> str:
    """``body`` behind the keyspace and the named relations."""
    return f"{CTES}, {sql(body, *relations).removeprefix('WITH ')}"


def fetch_log(spark, sf):
    """Every page fetched once, region by region in its month; what became of it hangs on page and month."""
    month = F.substring("deal_ym", 5, 2).cast("int")
    pages = page_rows(spark, sf).select(*ch.PAGE_KEYS).distinct().withColumns({
        "total_pages": F.when(month % 3 == 0, 8).otherwise(7),
        "fetched_at": F.expr("timestamp_seconds(unix_timestamp(to_date(deal_ym, 'yyyyMM')) + cast(lawd_cd AS int) * 3600L + page_no * 60L)"),
        "action": F.element_at(F.array(*[F.lit(o) for o in OUTCOMES]), (F.col("page_no") + month) % 5 + 1),
        "run_id": F.concat(F.lit("run-"), F.substring("deal_ym", 1, 4)),
    })
    done = ch.completed_partitions(pages.where("action <> 'error' OR page_no % 2 = 1")).select(*ch.PARTITION_KEYS, F.lit(True).alias("_done"))
    return pages.join(done, list(ch.PARTITION_KEYS), "left").withColumns({
        "completed": F.coalesce("_done", F.lit(False)), "started_at": F.expr("timestamp(concat(substr(deal_ym, 1, 4), '-01-01'))"), "quota_limit": F.lit(10_000),
    }).drop("_done")


LOG = """log AS (SELECT *, CASE WHEN m % 3 = 0 THEN 8 ELSE 7 END AS total_pages, strptime(deal_ym, '%Y%m') + to_hours(CAST(lawd_cd AS INT)) + to_minutes(page_no) AS fetched_at,
        ['created', 'updated', 'unchanged', 'skipped_empty', 'error'][(page_no + m) % 5 + 1] AS action, 'run-' || substr(deal_ym, 1, 4) AS run_id
        FROM (SELECT DISTINCT lawd_cd, deal_ym, page_no, CAST(substr(deal_ym, 5, 2) AS INT) AS m FROM pages_all)),
    done AS (SELECT run_id, lawd_cd, deal_ym FROM log WHERE action <> 'error' OR page_no % 2 = 1
        GROUP BY ALL HAVING count(DISTINCT page_no) = max(total_pages)),
    good AS (SELECT * FROM log WHERE action <> 'error'),
    lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY fetched_at DESC, page_no DESC, deal_ym DESC, lawd_cd DESC) AS rn FROM good) WHERE rn = 1),
    ahead AS (SELECT lawd_cd, deal_ym, slot_idx, total_slots, coalesce(lead(lawd_cd) OVER (ORDER BY slot_idx), first_value(lawd_cd) OVER (ORDER BY slot_idx)) AS next_code,
        coalesce(lead(deal_ym) OVER (ORDER BY slot_idx), first_value(deal_ym) OVER (ORDER BY slot_idx)) AS next_month FROM slot),
    cursors AS (SELECT run_id,
        CASE WHEN slot_idx IS NULL THEN (SELECT lawd_cd FROM slot WHERE slot_idx = 0) WHEN page_no < total_pages THEN l.lawd_cd ELSE next_code END AS cursor_code,
        CASE WHEN slot_idx IS NULL THEN (SELECT deal_ym FROM slot WHERE slot_idx = 0) WHEN page_no < total_pages THEN l.deal_ym ELSE next_month END AS cursor_month,
        CASE WHEN slot_idx IS NOT NULL AND page_no < total_pages THEN page_no + 1 ELSE 1 END AS cursor_page
        FROM lasts l LEFT JOIN ahead a ON l.lawd_cd = a.lawd_cd AND l.deal_ym = a.deal_ym)"""


@check("k13_run_summary", with_slots(f""", {LOG}
    SELECT l.run_id, strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S') AS ts, count(*) AS quota_used, 10000 AS quota_limit, count(*) FILTER (action <> 'error') AS pages_fetched,
        count(*) FILTER (action = 'created') AS created, count(*) FILTER (action = 'updated') AS updated, count(*) FILTER (action = 'unchanged') AS unchanged,
        count(*) FILTER (action = 'skipped_empty') AS skipped_empty, count(*) FILTER (action = 'error') AS failed,
        (SELECT count(*) FROM done d WHERE d.run_id = l.run_id) AS partitions_completed, any_value(cursor_code) AS cursor_lawd_cd, any_value(cursor_month) AS cursor_deal_ym,
        any_value(cursor_page) AS cursor_page_no, round(any_value(slot_idx) / any_value(total_slots) * 100.0::DOUBLE, 6) AS percent,
        (SELECT count(*) FROM good g JOIN slot s ON g.lawd_cd = s.lawd_cd AND g.deal_ym = s.deal_ym
            WHERE s.slot_idx = s.total_slots - 1 AND g.page_no >= g.total_pages AND g.run_id <= l.run_id) AS cycles_completed
    FROM log l JOIN cursors c ON l.run_id = c.run_id JOIN slot s ON s.lawd_cd = cursor_code AND s.deal_ym = cursor_month GROUP BY l.run_id""", "pages_all"))  # fmt: skip
def k13_run_summary(spark, sf):
    runs = lg.run_summaries(fetch_log(spark, sf), slots(spark, sf))
    out = runs.select(
        "run_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "quota_used", "quota_limit", "pages_fetched",
        "created", "updated", "unchanged", "skipped_empty", "failed", "partitions_completed",
        *[F.col(f"cursor.{c}").alias(f"cursor_{c}") for c in ("lawd_cd", "deal_ym", "page_no")], "percent", "cycles_completed",
    )
    return rounded(out, percent=6)


MANIFEST_RUN = "run-2000"


@check("k12_run_manifest", with_slots(f""", {LOG}
    SELECT strftime(max(fetched_at), '%Y-%m-%dT%H:%M:%S') AS ts, '2000-01-01T00:00:00' AS started_at, CAST(count(*) AS INTEGER) AS quota_used, 10000 AS quota_limit,
        any_value(cursor_code) || '/' || any_value(cursor_month) || '/' || any_value(cursor_page) AS cursor,
        (SELECT '[' || string_agg('{{"lawd_cd":"' || lawd_cd || '","deal_ym":"' || deal_ym || '"}}', ',' ORDER BY lawd_cd, deal_ym) || ']' FROM done WHERE run_id = '{MANIFEST_RUN}') AS completed_partitions
    FROM log l JOIN cursors c ON l.run_id = c.run_id WHERE l.run_id = '{MANIFEST_RUN}'""", "pages_all"))  # fmt: skip
def k12_run_manifest(spark, sf):
    """One run's whole manifest, as ``write_manifest`` writes it."""
    made = lg.manifest(fetch_log(spark, sf), slots(spark, sf), MANIFEST_RUN)
    return made.select(
        "ts", "started_at", "quota_used", "quota_limit", F.concat_ws("/", "cursor.lawd_cd", "cursor.deal_ym", "cursor.page_no").alias("cursor"),
        F.to_json("completed_partitions").alias("completed_partitions"),
    )


@check("r2_next_fetch_per_run", with_slots(f""", {LOG} SELECT run_id, cursor_code AS lawd_cd, cursor_month AS deal_ym, cursor_page AS page_no FROM cursors""", "pages_all"))
def r2_next_fetch_per_run(spark, sf):
    """Where each run's successor resumes."""
    return lg.next_cursors(fetch_log(spark, sf), slots(spark, sf)).select("run_id", "lawd_cd", "deal_ym", "page_no")


@check("k11_missing_pages", sql(
    """SELECT lawd_cd, deal_ym, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS missing
        FROM (SELECT lawd_cd, deal_ym, max(CASE WHEN page_no <= 4 THEN 5 ELSE 8 END) AS total FROM pages_all GROUP BY ALL) t, (SELECT unnest(range(1, 9)) AS p)
        WHERE p <= total AND NOT EXISTS (SELECT 1 FROM pages_all x WHERE x.lawd_cd = t.lawd_cd AND x.deal_ym = t.deal_ym AND x.page_no = p) GROUP BY ALL""", "pages_all"))  # fmt: skip
def k11_missing_pages(spark, sf):
    """Pages that none of two runs saw: one fetched pages 1 to 4, when 5 were announced, a later one the rest of 8."""
    visits = page_rows(spark, sf).select(*ch.PAGE_KEYS).distinct()
    first = visits.where("page_no <= 4").select("*", F.lit(5).alias("total_pages"), F.lit("2024-01-01").cast("timestamp").alias("fetched_at"))
    later = visits.where("page_no > 4").select("*", F.lit(8).alias("total_pages"), F.lit("2024-02-01").cast("timestamp").alias("fetched_at"))
    seen = ch.seen_pages(first.unionByName(later)).where(F.size("missing") > 0)
    return seen.select("lawd_cd", "deal_ym", F.array_join(F.col("missing").cast("array<string>"), ",").alias("missing"))


def in_page(*order):
    """Places of a page's rows."""
    return F.row_number().over(Window.partitionBy(*ch.PAGE_KEYS).orderBy(*order))


def numbered(spark, sf):
    return page_rows(spark, sf).withColumn("row_no", in_page("orderkey", "partkey", "cents", "area", "tax"))


NUMBERED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY lawd_cd, deal_ym, page_no ORDER BY orderkey, partkey, round(price * 100), CAST(area AS BIGINT), tax) AS row_no,
        CAST(substr(deal_ym, 5, 2) AS INT) AS m FROM pages_all),
    landed AS (SELECT lawd_cd, deal_ym, page_no, m, string_agg(item, ',' ORDER BY row_no) AS body FROM numbered WHERE m <> 6 GROUP BY ALL),
    asked AS (SELECT DISTINCT lawd_cd, deal_ym, page_no, m FROM numbered WHERE m <> 4 AND NOT (m = 5 AND page_no > 4)),
    got AS (SELECT a.*, string_agg(item, ',' ORDER BY CASE WHEN a.m = 3 THEN -row_no ELSE row_no END) AS body FROM asked a LEFT JOIN numbered n
        ON a.lawd_cd = n.lawd_cd AND a.deal_ym = n.deal_ym AND a.page_no = n.page_no AND NOT (a.m = 7 AND tax >= 0.04) AND a.m <> 8 GROUP BY ALL),
    act AS (SELECT coalesce(o.lawd_cd, g.lawd_cd) AS lawd_cd, coalesce(o.deal_ym, g.deal_ym) AS deal_ym, coalesce(o.page_no, g.page_no) AS page_no,
        CASE WHEN coalesce(o.m, g.m) = 5 AND coalesce(o.page_no, g.page_no) > 4 THEN 'removed' WHEN g.page_no IS NULL THEN 'kept' WHEN g.body IS NULL THEN 'skipped_empty'
             WHEN o.page_no IS NULL THEN 'created' WHEN o.body = g.body THEN 'unchanged' ELSE 'updated' END AS action
        FROM landed o FULL JOIN got g ON o.lawd_cd = g.lawd_cd AND o.deal_ym = g.deal_ym AND o.page_no = g.page_no)"""


@check("k10_actions_of_a_run", sql(f", {NUMBERED} SELECT lawd_cd, deal_ym, page_no, action FROM act", "pages_all"))
def k10_actions_of_a_run(spark, sf):
    """Reordered (March), kept (April), vanished (May), new (June), corrected (July) and empty (August) pages, by row and place."""
    month = F.substring("deal_ym", 5, 2).cast("int")
    rows = numbered(spark, sf)
    sent = rows.where((month != 4) & (month != 8) & ~((month == 5) & (F.col("page_no") > 4)) & ~((month == 7) & (F.col("tax") >= 0.04)))
    place = F.when(month == 3, -F.col("row_no")).otherwise(F.col("row_no"))
    sent = sent.withColumn("row_no", in_page(place))
    asked = rows.where((month != 4) & ~((month == 5) & (F.col("page_no") > 4))).select(*ch.PAGE_KEYS).distinct()
    old = ch.page_fingerprints(rows.where(month != 6), CONTENT, position="row_no")
    new = ch.with_empty_pages(ch.page_fingerprints(sent, CONTENT, position="row_no"), asked)
    totals = rows.select(*ch.PARTITION_KEYS).distinct().withColumn("total_pages", F.when(month == 5, 4).otherwise(7))
    return ch.mark_stale(ch.page_changes(old, new), totals).select(*ch.PAGE_KEYS, "action")
