"""Registration of queries and the shared pieces of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL, if it has one."""

    def add(query):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def round_half_up(column: str, digits: int) -> Column:
    """Binary rounding, halves away from zero: the same double in both engines.

    ``F.round`` goes through the decimal text of a double, so 2223.31375 would round up
    here and down there.
    """
    return F.expr(f"signum({column}) * floor(abs({column}) * {10**digits}D + 0.5D) / {10**digits}D")


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: round_half_up(c, n) for c, n in digits.items()})


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def all_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Trades read off the order lines: a supplier is a complex, its nation the region."""
    lines = table(spark, sf, "lineitem")
    complexes = table(spark, sf, "supplier").selectExpr("s_suppkey", "s_name", "lpad(cast(s_nationkey AS string), 5, '0') AS sggcd")
    return lines.join(complexes, F.expr("l_suppkey = s_suppkey")).selectExpr(
        "sggcd",
        "cast(l_suppkey AS string) AS aptseq",
        "s_name AS aptnm",
        "l_suppkey AS complexNo",
        "l_linenumber AS areaNo",
        "cast(l_shipdate AS date) AS date",
        "cast(l_shipdate AS date) AS deal_date",
        "trunc(cast(l_shipdate AS date), 'month') AS deal_month_date",
        "l_extendedprice AS deal_amount",
        "l_extendedprice AS dealPrice",
        "l_quantity AS area",
        "l_extendedprice / l_quantity AS ppsqm_krw",
        "cast(floor(l_quantity / 10) AS string) AS bucket",
        "l_returnflag AS flag",
        "l_orderkey AS orderkey",
        "l_partkey AS partkey",
        "l_discount AS discount",
        "l_tax AS tax",
    )


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Trades that were not cancelled."""
    return all_trades(spark, sf).where(F.col("flag") != "R")


def names(spark: SparkSession, sf: str) -> DataFrame:
    """Region names; the last regions have none, so their code stands in."""
    nation = table(spark, sf, "nation")
    return nation.selectExpr("lpad(cast(n_nationkey AS string), 5, '0') AS sggcd", "if(n_nationkey < 20, n_name, NULL) AS region_ko")


def complexes(spark: SparkSession, sf: str) -> DataFrame:
    """The complex dimension with made-up coordinates."""
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS complexNo",
        "s_name AS complexName",
        "37 + s_suppkey % 100 / 1000 AS latitude",
        "127 + s_suppkey % 77 / 1000 AS longitude",
    )


# The same relations in SQL. Each names the ones it reads.
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "all_trade": (
        (),
        """SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS sggcd, CAST(l_suppkey AS VARCHAR) AS aptseq,
               s_name AS aptnm, l_suppkey AS complexNo, l_linenumber AS areaNo,
               CAST(l_shipdate AS DATE) AS deal_date, CAST(date_trunc('month', l_shipdate) AS DATE) AS deal_month_date,
               l_extendedprice AS price, l_quantity AS area, l_extendedprice / l_quantity AS ppsqm,
               CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR) AS bucket, l_returnflag AS flag,
               l_orderkey AS orderkey, l_partkey AS partkey, l_discount AS discount, l_tax AS tax
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "trade": (("all_trade",), "SELECT * FROM all_trade WHERE flag <> 'R'"),
    "newest": (("trade",), "SELECT max(deal_month_date) AS m FROM trade"),
    "last12": (
        ("trade", "newest"),
        "SELECT t.* FROM trade t, newest WHERE t.deal_month_date > newest.m - INTERVAL 12 MONTH",
    ),
    "region_month": (
        ("trade", "newest"),
        """SELECT sggcd, deal_month_date, CAST(year(deal_month_date) AS INTEGER) AS deal_year,
               CAST(month(deal_month_date) AS INTEGER) AS deal_month, median(ppsqm) AS price, count(*) AS trades
        FROM trade, newest WHERE deal_month_date > newest.m - INTERVAL 180 MONTH
        GROUP BY sggcd, deal_month_date""",
    ),
    "complex_month": (
        ("trade", "newest"),
        """SELECT aptseq, aptnm, sggcd, deal_month_date, median(ppsqm) AS price, count(*) AS trades
        FROM trade, newest WHERE deal_month_date > newest.m - INTERVAL 120 MONTH
        GROUP BY aptseq, aptnm, sggcd, deal_month_date""",
    ),
    "region_year": (("last12",), "SELECT sggcd, median(ppsqm) AS price, count(*) AS trades FROM last12 GROUP BY sggcd"),
    "bucket_year": (
        ("last12",),
        """SELECT aptseq, aptnm, sggcd, bucket, median(ppsqm) AS price, count(*) AS trades
        FROM last12 GROUP BY aptseq, aptnm, sggcd, bucket""",
    ),
    "names": (
        (),
        "SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS sggcd, CASE WHEN n_nationkey < 20 THEN n_name END AS region_ko FROM nation",
    ),
    "complex": (
        (),
        """SELECT s_suppkey AS complexNo, s_name AS complexName, 37 + (s_suppkey % 100) / 1000.0::DOUBLE AS latitude,
               127 + (s_suppkey % 77) / 1000.0::DOUBLE AS longitude FROM supplier""",
    ),
    "feature": (
        ("region_month",),
        """SELECT *, avg(mom) OVER (o ROWS 2 PRECEDING) AS mom3, stddev_samp(mom) OVER (o ROWS 11 PRECEDING) AS vol12
        FROM (SELECT *, price / nullif(lag(price) OVER o, 0) - 1 AS mom, price / nullif(lag(price, 12) OVER o, 0) - 1 AS yoy,
                     avg(price) OVER (o ROWS 23 PRECEDING) AS ma24, stddev_samp(price) OVER (o ROWS 23 PRECEDING) AS std24,
                     avg(trades) OVER (o ROWS 11 PRECEDING) AS tma12
              FROM region_month WINDOW o AS (PARTITION BY sggcd ORDER BY deal_month_date))
        WINDOW o AS (PARTITION BY sggcd ORDER BY deal_month_date)""",
    ),
    "measure": (
        ("feature",),
        """SELECT *, (price - ma24) / nullif(ma24, 0) AS gap, (price - ma24) / nullif(std24, 0) AS z,
               trades / nullif(tma12, 0) AS liq FROM feature""",
    ),
    "scored": (
        ("measure",),
        """SELECT *, 0.35::DOUBLE * greatest(-0.3::DOUBLE, least(0.3::DOUBLE, coalesce(yoy, 0))) / 0.3::DOUBLE
               + 0.25::DOUBLE * greatest(-0.15::DOUBLE, least(0.15::DOUBLE, coalesce(mom3, 0))) / 0.15::DOUBLE
               + 0.2::DOUBLE * greatest(-0.7::DOUBLE, least(0.7::DOUBLE, coalesce(liq - 1, 0))) / 0.7::DOUBLE
               - 0.2::DOUBLE * greatest(-2.0::DOUBLE, least(2.0::DOUBLE, coalesce(z, 0))) / 2.0::DOUBLE AS score
        FROM measure""",
    ),
    "board": (
        ("scored", "names"),
        """SELECT s.*, coalesce(n.region_ko, s.sggcd) AS region_ko,
               CASE WHEN ma24 IS NULL OR std24 IS NULL THEN '판단보류(데이터부족)' WHEN price - ma24 < -std24 THEN '저평가권'
                    WHEN price - ma24 > std24 THEN '고평가권' ELSE '적정권' END AS state,
               CASE WHEN score >= 0.35 THEN '상승우세' WHEN score <= -0.35 THEN '조정우세' ELSE '중립' END AS phase
        FROM scored s LEFT JOIN names n USING (sggcd)""",
    ),
    "unit_change": (
        ("trade",),
        """SELECT *, (p1 - p0) / p0 * 100 AS rate, p1 - p0 AS amount
        FROM (SELECT complexNo, areaNo, min(price) FILTER (deal_date = d0) AS p0, min(price) FILTER (deal_date = d1) AS p1
              FROM (SELECT *, min(deal_date) OVER u AS d0, max(deal_date) OVER u AS d1 FROM trade
                    WHERE deal_date BETWEEN DATE '1997-02-10' AND DATE '1999-10-20' WINDOW u AS (PARTITION BY complexNo, areaNo))
              GROUP BY complexNo, areaNo)""",
    ),
    "graded": (
        ("unit_change", "complex"),
        """SELECT *, CASE WHEN z >= 1 THEN 'excellent' WHEN z >= 0.5 THEN 'good' WHEN z >= -0.5 THEN 'average'
                     WHEN z >= -1 THEN 'poor' ELSE 'very_poor' END AS grade
        FROM (SELECT c.*, (rate - avg(rate) OVER ()) / nullif(stddev_samp(rate) OVER (), 0) AS z, d.complexName, d.latitude, d.longitude
              FROM unit_change c LEFT JOIN complex d USING (complexNo))""",
    ),
    "pages_all": (
        ("all_trade",),
        """SELECT sggcd AS lawd_cd, strftime(deal_date, '%Y%m') AS deal_ym, CAST(areaNo AS INTEGER) AS page_no, *,
               concat(orderkey, '/', partkey, '/', CAST(round(price * 100) AS BIGINT), '/', CAST(area AS BIGINT)) AS item
        FROM all_trade""",
    ),
    "landed_rows": (("pages_all",), "SELECT * FROM pages_all WHERE deal_ym < '200007'"),
    "fetched_rows": (
        ("pages_all",),
        "SELECT * FROM pages_all WHERE deal_ym >= '200001' AND NOT (deal_ym BETWEEN '200003' AND '200006' AND tax >= 0.04)",
    ),
    "change": (
        ("landed_rows", "fetched_rows", "pages_all"),
        """SELECT coalesce(o.lawd_cd, f.lawd_cd) AS lawd_cd, coalesce(o.deal_ym, f.deal_ym) AS deal_ym,
               coalesce(o.page_no, f.page_no) AS page_no,
               CASE WHEN f.page_no IS NULL THEN 'kept' WHEN f.n = 0 THEN 'skipped_empty' WHEN o.page_no IS NULL THEN 'created'
                    WHEN o.body = f.body THEN 'unchanged' ELSE 'updated' END AS action
        FROM (SELECT lawd_cd, deal_ym, page_no, string_agg(item, ',' ORDER BY item) AS body FROM landed_rows GROUP BY ALL) o
        FULL JOIN (SELECT lawd_cd, deal_ym, page_no, count(r.item) AS n, string_agg(r.item, ',' ORDER BY r.item) AS body
                   FROM (SELECT DISTINCT lawd_cd, deal_ym, page_no FROM pages_all WHERE deal_ym >= '200001')
                   LEFT JOIN fetched_rows r USING (lawd_cd, deal_ym, page_no) GROUP BY ALL) f
          ON o.lawd_cd = f.lawd_cd AND o.deal_ym = f.deal_ym AND o.page_no = f.page_no""",
    ),
}


def sql(body: str, *relations: str) -> str:
    """``body`` behind a WITH clause of the named relations and those they read."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name not in ordered:
            for other in RELATIONS[name][0]:
                need(other)
            ordered.append(name)

    for name in relations:
        need(name)
    ctes = ", ".join(f"{n} AS ({RELATIONS[n][1]})" for n in ordered)
    return f"WITH {ctes} {body}" if ctes else body
