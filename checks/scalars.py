"""Month lists, parsers and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from hanok.functions import dates, text
from hanok.plans.catalog import lineage_edges


def orders(spark, sf, *columns):
    return table(spark, sf, "orders").selectExpr("o_orderkey", *columns)


@check(
    "month_range",
    """SELECT strftime(m, '%Y%m') AS deal_ym FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
        max(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders)""",
)
def month_range(spark, sf):
    span = table(spark, sf, "orders").agg(
        F.date_format(F.min("o_orderdate"), "yyyyMM").alias("a"), F.date_format(F.max("o_orderdate"), "yyyyMM").alias("b")
    )
    return span.select(F.explode(dates.months_between_codes(F.col("a"), F.col("b"))).alias("deal_ym"))


@check(
    "f21_last_120_months",
    """SELECT c_custkey, strftime(last - INTERVAL 119 MONTH, '%Y%m') AS oldest, strftime(last, '%Y%m') AS newest, 120 AS n
        FROM (SELECT o_custkey AS c_custkey, date_trunc('month', max(o_orderdate)) AS last FROM orders GROUP BY 1)""",
)
def f21_last_120_months(spark, sf):
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.to_date("o_orderdate")).alias("day"))
    listed = last.select("c_custkey", dates.last_months(F.col("day")).alias("m"))
    return listed.select(
        "c_custkey", F.element_at("m", 1).alias("oldest"), F.element_at("m", -1).alias("newest"), F.size("m").alias("n")
    )


@check(
    "f22_month_range_bad_input",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 OR month(o_orderdate) = 12 THEN 0
        ELSE 13 - month(o_orderdate) END::INTEGER AS n FROM orders""",
)
def f22_month_range_bad_input(spark, sf):
    """Months from an order to the end of its year; none for blank, malformed or crossed ends."""
    o = orders(
        spark, sf, "date_format(o_orderdate, 'yyyyMM') AS a",
        """CASE WHEN o_orderkey % 8 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN '2024'
            WHEN month(o_orderdate) = 12 THEN concat(year(o_orderdate), '01') ELSE concat(year(o_orderdate), '12') END AS b""",
    )
    return o.select("o_orderkey", F.size(dates.months_between_codes(F.col("a"), F.col("b"))).alias("n"))


@check(
    "f37_collection_window",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE) - 3650, '%Y%m')
        ELSE strftime(o_orderdate, '%Y%m') END AS start_ym, strftime(o_orderdate, '%Y%m') AS end_ym FROM orders""",
)
def f37_collection_window(spark, sf):
    o = orders(spark, sf, "cast(o_orderdate AS date) AS day", "if(o_orderkey % 2 = 0, '10y', '1m') AS w")
    return o.select("o_orderkey", dates.collection_window(F.col("w"), F.col("day")).alias("p")).select("o_orderkey", "p.*")


@check(
    "f1_f2_path_columns",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') END AS lawdCd,
        CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y%m') END AS deal_ym,
        CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate) END::INTEGER AS year,
        CASE WHEN o_orderkey % 5 > 0 THEN month(o_orderdate) END::INTEGER AS month FROM orders""",
)
def f1_f2_path_columns(spark, sf):
    from hanok.sources.bronze import path_columns

    o = orders(
        spark, sf,
        """CASE WHEN o_orderkey % 5 = 0 THEN 's3a://lake/other/file.csv' ELSE concat('s3a://lake/bronze/LAWD_CD=',
            lpad(o_custkey % 100000, 5, '0'), '/DEAL_YM=', date_format(o_orderdate, 'yyyyMM'), '/page=1.csv') END AS _file""",
    )
    return path_columns(o).select("o_orderkey", "lawdCd", "deal_ym", "year", "month")


@check("f32_flags", "SELECT o_orderkey, o_orderkey % 3 = 0 OR o_orderkey % 3 = 2 AND o_orderkey % 2 = 0 AS flag FROM orders")
def f32_flags(spark, sf):
    o = orders(
        spark, sf,
        """CASE WHEN o_orderkey % 3 = 0 THEN element_at(array('1', ' True ', 'YES', 'y', 'on'), cast(o_orderkey % 5 + 1 AS int))
            WHEN o_orderkey % 3 = 1 THEN element_at(array('0', 'false', ' No', 'N', 'off', 'maybe', ''), cast(o_orderkey % 7 + 1 AS int))
            WHEN o_orderkey % 2 = 0 THEN 'on' END AS w""",
    )
    return o.select("o_orderkey", text.to_flag(F.col("w")).alias("flag"))


@check(
    "f34_dataset_root",
    "SELECT o_orderkey, 's3://lake/' || o_custkey AS root FROM orders",
)
def f34_dataset_root(spark, sf):
    o = orders(
        spark, sf,
        """concat('s3://lake/', o_custkey, element_at(array('/', '', '/LAWD_CD=*/DEAL_YM=*/page=*.csv', '//'), cast(o_orderkey % 4 + 1 AS int))) AS p""",
    )
    return o.select("o_orderkey", text.dataset_root(F.col("p")).alias("root"))


@check(
    "f35_uri_parts",
    """SELECT o_orderkey, 'b' || o_custkey AS bucket, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'raw/' || o_orderkey || '.csv' END AS key,
        'b' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '/raw/' || o_orderkey || '.csv' END AS path FROM orders""",
)
def f35_uri_parts(spark, sf):
    o = orders(spark, sf, "concat(if(o_orderkey % 3 = 0, 's3://b', 's3a://b'), o_custkey, if(o_orderkey % 2 = 0, '', concat('/raw/', o_orderkey, '.csv'))) AS uri")
    uri = F.col("uri")
    return o.select("o_orderkey", text.uri_bucket(uri).alias("bucket"), text.uri_key(uri).alias("key"), text.bucket_path(uri).alias("path"))


def statements(spark, sf):
    """SQL texts made from the parts: quoted names, mixed case, and a subquery without a table."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey",
        "concat('board_', p_size) AS dataset",
        """concat('WITH c AS (SELECT 1) select x\nFROM lake."silver".', replace(p_name, ' ', '_'),
            ' t\n  Join `lake`.mart.', lower(p_type), ' m ON t.a = m.a JOIN c ON true WHERE note = ''from a.b''') AS sql""",
    )


@check(
    "lineage_edges",
    """SELECT DISTINCT 'lake' AS input_catalog, unnest(['silver.' || replace(p_name, ' ', '_'), 'mart.' || lower(p_type)]) AS input_table,
        'board_' || p_size AS dataset FROM part""",
)
def lineage(spark, sf):
    return lineage_edges(statements(spark, sf))


@check(
    "f33_table_references",
    """SELECT p_partkey, 'lake.mart.' || lower(p_type) || ',lake.silver.' || replace(p_name, ' ', '_') AS refs FROM part""",
)
def f33_table_references(spark, sf):
    return statements(spark, sf).select("p_partkey", F.concat_ws(",", text.table_references(F.col("sql"))).alias("refs"))


@check(
    "f30_tooltip",
    """SELECT o_orderkey, '<b>C' || o_custkey || '</b><br/>평수(areaNo): ' || o_orderkey % 7 || '<br/>현재 금액: '
        || format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) || '원<br/>변동률(%): '
        || printf('%.1f', CAST(round_even(o_totalprice / 1000 - 100, 1) AS DOUBLE)) || '%<br/>변동금액(원): '
        || format('{:,}', CAST(round_even(o_totalprice - 200000, 0) AS BIGINT)) || '원' AS tooltip FROM orders""",
)
def f30_tooltip(spark, sf):
    from hanok.functions.scoring import price_tooltip

    o = orders(spark, sf, "concat('C', o_custkey) AS name", "o_orderkey % 7 AS area", "o_totalprice AS p", "o_totalprice / 1000 - 100 AS r", "o_totalprice - 200000 AS d")
    return o.select("o_orderkey", price_tooltip(*[F.col(c) for c in ("name", "area", "p", "r", "d")]).alias("tooltip"))


@check("f4_guards", "SELECT o_orderkey, o_totalprice / nullif(o_orderkey % 3, 0) AS share, coalesce(nullif(o_orderstatus, 'F'), 'none') AS status FROM orders")
def f4_guards(spark, sf):
    from hanok.functions.scoring import ratio

    o = orders(spark, sf, "o_totalprice AS p", "o_orderkey % 3 AS k", "o_orderstatus AS s")
    return o.select(
        "o_orderkey", ratio(F.col("p"), F.col("k").cast("double")).alias("share"),
        F.coalesce(F.nullif(F.col("s"), F.lit("F")), F.lit("none")).alias("status"),
    )


@check(
    "t8_months_newest_first",
    "SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS deal_ym FROM orders ORDER BY 1 DESC",
)
def t8_months_newest_first(spark, sf):
    return table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("deal_ym")).distinct().orderBy(F.desc("deal_ym"))
