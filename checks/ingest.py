"""Typed casts, bad rows, normalisation, lists and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, rounded, sql, table, trades
from hanok.functions import dates, text
from hanok.operators import quality
from hanok.operators.joins import with_dimension, with_parent
from hanok.operators.ranking import first_per_key, first_rows
from hanok.schema import REQUIRED_TRADE_COLUMNS, TRADE_SCHEMA
from hanok.sinks.files import preview
from hanok.sources.files import read_parquet


def raw_trades(spark, sf):
    """Trade history as text: floors and prices that do not parse for some rows."""
    return trades(spark, sf).selectExpr(
        "'A1' AS tradeType",
        "cast(year(deal_date) AS string) AS tradeYear",
        "cast(month(deal_date) AS string) AS tradeMonth",
        "cast(dayofmonth(deal_date) AS string) AS tradeDate",
        "CASE WHEN areaNo = 6 AND area < 10 THEN '' ELSE cast(cast(floor(dealPrice) AS bigint) AS string) END AS dealPrice",
        "CASE WHEN areaNo = 7 AND area > 40 THEN 'B1' ELSE cast(areaNo AS string) END AS floor",
        "cast(area AS string) AS representativeArea",
        "CASE WHEN area = 25 THEN 'n/a' ELSE cast(area * 2 AS string) END AS exclusiveArea",
        "cast(areaNo AS string) AS areaNo",
        "cast(complexNo AS string) AS complexNo",
        "orderkey",
    )


BAD = "(areaNo = 6 AND area < 10) OR (areaNo = 7 AND area > 40) OR area = 25"


@check(
    "bad_rows",
    sql(
        f"""SELECT orderkey, areaNo::VARCHAR AS areaNo, rtrim(CASE WHEN areaNo = 6 AND area < 10 THEN 'dealPrice,' ELSE '' END
            || CASE WHEN areaNo = 7 AND area > 40 THEN 'floor,' ELSE '' END || CASE WHEN area = 25 THEN 'exclusiveArea' ELSE '' END, ',') AS failed
        FROM trade WHERE {BAD}""",
        "trade",
    ),
)
def bad_rows(spark, sf):
    _, bad = quality.split_bad_rows(raw_trades(spark, sf), REQUIRED_TRADE_COLUMNS, TRADE_SCHEMA)
    return bad.select("orderkey", "areaNo", F.concat_ws(",", "failed").alias("failed"))


@check(
    "clean_trades",
    sql(
        f"""SELECT 'A1' AS tradeType, CAST(year(deal_date) AS BIGINT) AS tradeYear, CAST(floor(price) AS BIGINT) AS dealPrice,
            CAST(areaNo AS BIGINT) AS floor, area AS representativeArea, area * 2 AS exclusiveArea, CAST(areaNo AS BIGINT) AS areaNo,
            complexNo, deal_date AS date FROM trade WHERE NOT ({BAD})""",
        "trade",
    ),
)
def clean_trades(spark, sf):
    out = quality.typed_trades(raw_trades(spark, sf), REQUIRED_TRADE_COLUMNS, TRADE_SCHEMA)
    return out.select(
        "tradeType", "tradeYear", "dealPrice", "floor", "representativeArea", "exclusiveArea", "areaNo", "complexNo",
        F.to_date("date").alias("date"),
    )


@check(
    "p11_accepted_and_rejected",
    sql(f"SELECT count(*) FILTER ({BAD}) AS rejected, count(*) FILTER (NOT ({BAD})) AS accepted FROM trade", "trade"),
)
def p11_accepted_and_rejected(spark, sf):
    flagged = quality.flag_bad_rows(raw_trades(spark, sf), REQUIRED_TRADE_COLUMNS, TRADE_SCHEMA)
    return flagged.agg(
        F.count_if(F.size("failed") > 0).alias("rejected"), F.count_if(F.size("failed") == 0).alias("accepted")
    )


@check(
    "f18_cast_block",
    "SELECT o_orderkey AS k, CAST(o_custkey AS DOUBLE) AS cust, floor(o_totalprice)::BIGINT AS price, o_orderkey % 2 = 0 AS even FROM orders",
)
def f18_cast_block(spark, sf):
    from pyspark.sql import types as T

    raw = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey AS string) AS k", "cast(o_custkey AS string) AS cust",
        "cast(cast(floor(o_totalprice) AS bigint) AS string) AS price",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS even",
    )
    kinds = {"k": T.LongType(), "cust": T.DoubleType(), "price": T.LongType(), "even": T.BooleanType()}
    return text.try_cast_to(raw, T.StructType([T.StructField(n, t) for n, t in kinds.items()]))


@check(
    "f19_try_cast",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END AS number FROM orders",
)
def f19_try_cast(spark, sf):
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 4 WHEN 0 THEN concat('x', o_custkey) ELSE concat(' ', o_custkey, ' ') END AS t"
    )
    return raw.select("o_orderkey", F.trim("t").try_cast("bigint").alias("number"))


@check("f14_trim", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def f14_trim(spark, sf):
    noisy = table(spark, sf, "customer").selectExpr(
        "c_custkey", "concat('  ', c_name) AS c_name", "concat(' ', c_mktsegment, '   ') AS c_mktsegment"
    )
    return text.trim_strings(noisy)


@check(
    "f15_lenient_numbers",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey * 1000 END AS whole,
        CASE WHEN o_orderkey % 7 > 0 THEN o_custkey + 0.5 END::DOUBLE AS fraction FROM orders""",
)
def f15_lenient_numbers(spark, sf):
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 5 WHEN 0 THEN '12.5' ELSE concat('  ', format_number(o_orderkey * 1000, 0), ' ') END AS a",
        "CASE o_orderkey % 7 WHEN 0 THEN 'none' ELSE concat(' ', format_number(o_custkey, 0), '.5 ') END AS b",
    )
    return raw.select("o_orderkey", text.lenient_long(F.col("a")).alias("whole"), text.lenient_double(F.col("b")).alias("fraction"))


@check(
    "f16_alias_fallback",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE o_custkey + 1 END AS amount,
        CASE WHEN o_orderkey % 2 = 0 THEN 84.5 ELSE 59.25 END::DOUBLE AS area FROM orders""",
)
def f16_alias_fallback(spark, sf):
    """Korean and English keys of one row, blank in the one or the other."""
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey AS string) ELSE '  ' END AS `거래금액`",
        "cast(o_custkey + 1 AS string) AS dealAmount",
        "CASE WHEN o_orderkey % 2 = 0 THEN ' 84.5 ' END AS exclusiveArea",
        "'59.25' AS excluUseAr",
    )
    out = quality.normalise_rows(raw)
    return out.select("o_orderkey", F.col("`거래금액(만원)`").alias("amount"), F.col("`전용면적`").alias("area"))


@check(
    "f17_padded_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
)
def f17_padded_date(spark, sf):
    o = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "year(o_orderdate) AS y", "month(o_orderdate) AS m",
        "CASE WHEN o_orderkey % 9 = 0 THEN 32 ELSE dayofmonth(o_orderdate) END AS d",
    )
    return o.select("o_orderkey", F.to_date(dates.padded_date(F.col("y"), F.col("m"), F.col("d"))).alias("day"))


@check(
    "f20_digits_and_slices",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS a, CAST(year(o_orderdate) AS INTEGER) AS b,
        CAST(month(o_orderdate) AS INTEGER) AS c FROM orders""",
)
def f20_digits_and_slices(spark, sf):
    o = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat(year(o_orderdate), '년') AS t", "date_format(o_orderdate, 'yyyy.MM.dd') AS s"
    )
    return o.select(
        "o_orderkey", text.leading_digits(F.col("t")).alias("a"),
        F.substring("s", 1, 4).try_cast("int").alias("b"), F.substring("s", 6, 2).try_cast("int").alias("c"),
    )


@check(
    "code_list",
    "SELECT DISTINCT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS lawd_cd FROM supplier",
)
def code_list(spark, sf):
    codes = table(spark, sf, "supplier").selectExpr("concat(' ', lpad(s_nationkey, 5, '0'), lpad(s_suppkey, 5, '0')) AS cortarNo")
    return quality.code_list(codes)


@check(
    "s13_code_list_in_file_order",
    """SELECT lawd_cd FROM (SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS lawd_cd, min(s_suppkey) AS o
        FROM supplier GROUP BY 1) ORDER BY o""",
)
def s13_code_list_in_file_order(spark, sf):
    codes = table(spark, sf, "supplier").selectExpr("lpad(s_nationkey, 5, '0') AS Lawd_Cd", "s_suppkey AS line")
    return quality.code_list_in_file_order(codes, "line")


@check(
    "p10_non_blank",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 > 1 AND year(o_orderdate) >= 1997",
)
def p10_non_blank(spark, sf):
    o = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "year(o_orderdate) AS year", "CASE o_orderkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE o_orderstatus END AS name"
    )
    return quality.usable_pairs(o, ["name"]).where("year >= 1997").select("o_orderkey")


@check(
    "p14_first_row_per_key",
    """SELECT n AS key, min_by(c_name, c_custkey) AS name FROM (SELECT c_nationkey AS n, * FROM customer) WHERE c_custkey % 3 > 0 GROUP BY n""",
)
def p14_first_row_per_key(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS key", "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name END AS name", "c_custkey"
    )
    return first_per_key(quality.usable_pairs(c, ["name"]), ["key"], ["c_custkey"]).select("key", "name")


@check("p15_drop_missing", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def p15_drop_missing(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'F') AS s").dropna(subset=["s"]).select("o_orderkey")


@check("p1_forced_columns", "SELECT s_name, s_suppkey, CAST(NULL AS VARCHAR) AS floor FROM supplier")
def p1_forced_columns(spark, sf):
    from pyspark.sql import types as T

    wanted = T.StructType([T.StructField("s_name", T.StringType()), T.StructField("s_suppkey", T.LongType()), T.StructField("floor", T.StringType())])
    return text.try_cast_to(table(spark, sf, "supplier"), wanted)


@check("p4_rename", "SELECT s_suppkey AS complexNo, s_name AS complexName FROM supplier")
def p4_rename(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return s.withColumnsRenamed({"s_suppkey": "complexNo", "s_name": "complexName"})


@check("s6_forced_schema_scan", "SELECT s_suppkey, s_name FROM supplier")
def s6_forced_schema_scan(spark, sf):
    from pyspark.sql import types as T

    wanted = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())])
    return read_parquet(spark, f"{sf}/supplier*.parquet", wanted)


@check("s7_schema_from_file", "SELECT * FROM customer")
def s7_schema_from_file(spark, sf):
    return read_parquet(spark, f"{sf}/customer.parquet")


@check("s8_scan_by_name", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY ALL")
def s8_scan_by_name(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("lake_customer")
    return spark.table("lake_customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@check("s20_limited_scan", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5000")
def s20_limited_scan(spark, sf):
    return first_rows(table(spark, sf, "customer").select("c_custkey", "c_name"), 5000, ["c_custkey"])


@check("k17_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey, o_totalprice LIMIT 3")
def k17_preview(spark, sf):
    return preview(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey", "o_totalprice"])


@check(
    "u1_concatenate_differing",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS code FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier""",
)
def u1_concatenate_differing(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    s = table(spark, sf, "supplier").selectExpr("cast(s_nationkey AS string) AS code", "s_acctbal AS balance", "s_name AS name")
    return quality.union_by_name(c, s)


@check(
    "u2_distinct_union",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def u2_distinct_union(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_nationkey AS nationkey").distinct()
    return c.union(table(spark, sf, "supplier").selectExpr("s_nationkey").distinct()).distinct()


@check(
    "j8_region_hierarchy",
    """SELECT c_custkey AS cortarNo, n_nationkey AS parentCortarNo, n_name AS parentCortarName, r_name AS top
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def j8_region_hierarchy(spark, sf):
    districts = with_parent(
        table(spark, sf, "nation"), table(spark, sf, "region"), "n_regionkey", "r_regionkey", "r_name"
    ).selectExpr("n_nationkey", "n_name", "parentCortarName AS top")
    leaves = with_parent(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), districts, "c_nationkey", "n_nationkey", "n_name")
    return with_dimension(leaves, districts.selectExpr("n_nationkey AS parentCortarNo", "top"), "parentCortarNo").selectExpr(
        "c_custkey AS cortarNo", "parentCortarNo", "parentCortarName", "top"
    )


@check(
    "json_props_flatten",
    "SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL",
)
def json_props_flatten(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.from_json("props", "k INT").alias("p"))
    return e.groupBy("event_type", F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


PRICE_SQL = sql(
    """SELECT complexNo, CAST(areaNo AS BIGINT) AS areaNo, CAST(year(deal_date) AS INTEGER) AS tradeYear,
        CAST(month(deal_date) AS INTEGER) AS tradeMonth, CAST(floor(price) AS BIGINT) AS dealPrice FROM trade""",
    "trade",
)


@check("s16_price_history_json", PRICE_SQL)
def s16_price_history_json(spark, sf):
    """Nested price answers flattened again."""
    from hanok.sources.responses import price_history

    item = (
        "named_struct('tradeYear', concat(year(deal_date), '년'), 'tradeMonth', CASE WHEN areaNo = 1 THEN NULL ELSE month(deal_date) END, "
        "'dealPrice', floor(dealPrice), 'formattedTradeYearMonth', date_format(deal_date, 'yyyy.MM.dd'))"
    )
    # One answer per trade, with a second month that has none.
    answers = trades(spark, sf).selectExpr(
        "complexNo", "cast(areaNo AS bigint) AS areaNo",
        f"""to_json(named_struct('realPriceOnMonthList', array(named_struct('realPriceList', array({item})),
            named_struct('realPriceList', slice(array({item}), 1, 0))))) AS body""",
    )
    out = price_history(answers)
    return out.select("complexNo", "areaNo", "tradeYear", "tradeMonth", "dealPrice")


@check(
    "s14_xml_pages",
    """SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS region, c_custkey AS key, c_name AS aptNm, c_custkey % 4 AS announced FROM customer WHERE c_custkey % 4 = 1
    UNION ALL SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0'), c_custkey, unnest([c_name, 'second']), c_custkey % 4 FROM customer WHERE c_custkey % 4 = 2""",
)
def s14_xml_pages(spark, sf):
    """XML answers with no, one or two items, and error answers, flattened to item rows."""
    from hanok.sources import responses

    c = table(spark, sf, "customer").selectExpr(
        "lpad(c_nationkey, 5, '0') AS region", "c_custkey AS key", "c_custkey % 4 AS announced", "cast(1 AS int) AS page_no",
        """concat('<response><header><resultCode>', if(c_custkey % 4 = 3, '99', '000'), '</resultCode></header><body><items>',
            if(c_custkey % 4 IN (1, 2, 3), concat('<item><aptNm> ', c_name, ' </aptNm></item>'), ''),
            if(c_custkey % 4 = 2, '<item><aptNm>second</aptNm></item>', ''),
            '</items><numOfRows>1000</numOfRows><totalCount>', c_custkey % 4, '</totalCount></body></response>') AS body""",
    )
    good, _ = responses.split_pages(responses.parse_pages(c))
    return responses.page_items(good, ["aptNm"]).select("region", "key", "aptNm", "announced")


@check(
    "s15_error_pages",
    """SELECT c_custkey % 6 AS kind, count(*) AS n FROM customer WHERE c_custkey % 6 IN (1, 2, 5) GROUP BY ALL""",
)
def s15_error_pages(spark, sf):
    """Answers to fetch again: error codes, broken documents, and empty pages before the last."""
    from hanok.sources import responses

    c = table(spark, sf, "customer").selectExpr(
        "c_custkey % 6 AS kind", "cast(1 AS int) AS page_no",
        """CASE c_custkey % 6 WHEN 0 THEN '<response><header><resultCode>00</resultCode></header><body><items/><totalCount>0</totalCount></body></response>'
            WHEN 1 THEN '<response><header><resultCode>22</resultCode><resultMsg>LIMITED</resultMsg></header></response>'
            WHEN 2 THEN '<response><header><resultCode>00'
            WHEN 3 THEN '<response><header><resultCode>1</resultCode><resultMsg>NORMAL SERVICE.</resultMsg></header><body><items/><totalCount>0</totalCount></body></response>'
            WHEN 4 THEN '<response><body><items><item><a>1</a></item></items><totalCount>5000</totalCount></body></response>'
            ELSE '<response><body><items/><totalCount>5000</totalCount></body></response>' END AS body""",
    )
    _, wrong = responses.split_pages(responses.parse_pages(c))
    return wrong.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@check(
    "s19_inline_map",
    "SELECT s_suppkey, CASE s_nationkey WHEN 1 THEN 'north' WHEN 2 THEN 'it''s south' ELSE CAST(s_nationkey AS VARCHAR) END AS region_ko FROM supplier",
)
def s19_inline_map(spark, sf):
    """Suppliers named by an inline code list."""
    from hanok.operators.joins import with_region_name

    inline = spark.createDataFrame([("1", "north"), ("2", "it's south")], "sggcd STRING, region_ko STRING")
    s = table(spark, sf, "supplier").selectExpr("s_suppkey", "cast(s_nationkey AS string) AS sggcd")
    return with_region_name(s, inline).select("s_suppkey", "region_ko")


@check("a8_avg_by_date", "SELECT CAST(o_orderdate AS DATE) AS day, round(avg(o_totalprice), 4) AS price FROM orders GROUP BY 1")
def a8_avg_by_date(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("price"))
    return rounded(o, price=4)


@check(
    "a12_kpi",
    "SELECT round(avg(o_totalprice), 4) AS mean_price, max(o_totalprice) AS top, min(o_totalprice) AS low, count(*) AS n FROM orders",
)
def a12_kpi(spark, sf):
    o = table(spark, sf, "orders").agg(
        F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low"),
        F.count(F.lit(1)).alias("n"),
    )
    return rounded(o, mean_price=4)


@check(
    "p13_usable_manifest_entries",
    """SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS lawd_cd, '20240' || c_custkey % 9 AS deal_ym FROM customer
    WHERE c_custkey % 9 > 0""",
)
def p13_usable_manifest_entries(spark, sf):
    """Manifests of which some entries lack the month."""
    m = table(spark, sf, "customer").selectExpr(
        """array(named_struct('lawd_cd', lpad(c_nationkey, 5, '0'), 'deal_ym',
            CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE concat('20240', c_custkey % 9) END)) AS completed_partitions"""
    )
    return quality.partition_entries(m)
