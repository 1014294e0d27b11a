"""The price change family: listings, changes, map, frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, complexes, rounded, sql, trades
from hanok.functions import scoring
from hanok.operators.ranking import first_per_key, first_rows, names_by_best, ranked_values
from hanok.plans import price_change as pc

START, END = "1997-02-10", "1999-10-20"


def _day(text: str):
    return F.lit(text).cast("date")


def changes(spark, sf):
    return pc.price_changes(trades(spark, sf), complexes(spark, sf), _day(START), _day(END))


CHANGE_COLUMNS = ["complexNo", "areaNo", "complexName", "latitude", "longitude", "start_price", "end_price",
                  "price_change_rate", "price_change_amount", "z_score", "performance_grade"]
CHANGE_DIGITS = {"latitude": 4, "longitude": 4, "price_change_rate": 6, "price_change_amount": 4, "z_score": 6}
CHANGE_SQL = """SELECT complexNo, areaNo, complexName, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude,
    p0 AS start_price, p1 AS end_price, round(rate, 6) AS price_change_rate, round(amount, 4) AS price_change_amount,
    round(z, 6) AS z_score, grade AS performance_grade FROM graded"""


@check("price_change", sql(CHANGE_SQL, "graded"))
def price_change(spark, sf):
    return rounded(changes(spark, sf).select(*CHANGE_COLUMNS), **CHANGE_DIGITS)


@check("p6_area_filter_after_grading", sql(CHANGE_SQL + " WHERE areaNo IN (2, 5)", "graded"))
def p6_area_filter_after_grading(spark, sf):
    return rounded(pc.only_areas(changes(spark, sf), [2, 5]).select(*CHANGE_COLUMNS), **CHANGE_DIGITS)


@check(
    "a10_mean_and_deviation",
    sql(
        "SELECT round(avg(rate), 6) AS mean_rate, round(stddev_samp(rate), 6) AS deviation, count(*) AS units FROM unit_change",
        "unit_change",
    ),
)
def a10_mean_and_deviation(spark, sf):
    c = pc.with_change(pc.first_and_last(pc.in_period(trades(spark, sf), _day(START), _day(END))))
    out = c.agg(
        F.avg("price_change_rate").alias("mean_rate"),
        F.stddev_samp("price_change_rate").alias("deviation"),
        F.count(F.lit(1)).alias("units"),
    )
    return rounded(out, mean_rate=6, deviation=6)


@check(
    "a11_first_last_per_group",
    sql(
        """SELECT complexNo, areaNo, arg_min(price, (deal_date, price)) AS start_price, arg_max(price, (deal_date, -price)) AS end_price
        FROM trade GROUP BY complexNo, areaNo""",
        "trade",
    ),
)
def a11_first_last_per_group(spark, sf):
    return pc.first_and_last(trades(spark, sf))


@check(
    "j4_first_joined_to_last",
    sql(
        """SELECT f.complexNo, f.areaNo, f.price AS start_price, l.price AS end_price
        FROM (SELECT * FROM trade QUALIFY row_number() OVER (PARTITION BY complexNo, areaNo ORDER BY deal_date, price) = 1) f
        JOIN (SELECT * FROM trade QUALIFY row_number() OVER (PARTITION BY complexNo, areaNo ORDER BY deal_date DESC, price) = 1) l
          ON l.complexNo = f.complexNo AND l.areaNo = f.areaNo""",
        "trade",
    ),
)
def j4_first_joined_to_last(spark, sf):
    """First trades joined to last trades, in the join form."""
    t = trades(spark, sf)
    days = pc.daily_lowest(t)
    first = days.groupBy(*pc.UNIT).agg(F.min_by("_low", "date").alias("start_price"))
    last = days.groupBy(*pc.UNIT).agg(F.max_by("_low", "date").alias("end_price"))
    return first.join(last, list(pc.UNIT))


@check(
    "p5_date_range",
    sql(
        f"SELECT count(*) AS n, min(deal_date) AS lo, max(deal_date) AS hi FROM trade WHERE deal_date >= DATE '{START}' AND deal_date <= DATE '{END}'",
        "trade",
    ),
)
def p5_date_range(spark, sf):
    return pc.in_period(trades(spark, sf), _day(START), _day(END)).agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )


@check(
    "p7_key_equality",
    sql("SELECT complexNo, areaNo, deal_date, price FROM trade WHERE complexNo = 3", "trade"),
)
def p7_key_equality(spark, sf):
    return trades(spark, sf).where(F.col("complexNo") == 3).select("complexNo", "areaNo", "deal_date", F.col("dealPrice").alias("price"))


@check(
    "price_trend",
    sql(
        f"""SELECT deal_date AS date, areaNo, round(avg(price), 4) AS dealPrice FROM trade
        WHERE complexNo = 3 AND deal_date BETWEEN DATE '{START}' AND DATE '{END}' AND areaNo IN (1, 2, 3, 4) GROUP BY ALL""",
        "trade",
    ),
)
def price_trend(spark, sf):
    return rounded(pc.price_trend(trades(spark, sf), 3, _day(START), _day(END), [1, 2, 3, 4]), dealPrice=4)


@check(
    "a9_mean_by_date_and_area",
    sql("SELECT deal_date AS date, areaNo, round(avg(price), 4) AS price FROM trade GROUP BY ALL", "trade"),
)
def a9_mean_by_date_and_area(spark, sf):
    return rounded(trades(spark, sf).groupBy("date", "areaNo").agg(F.avg("dealPrice").alias("price")), price=4)


@check(
    "avg_price_by_date",
    sql("SELECT deal_date AS date, round(avg(price), 4) AS avg_price FROM trade GROUP BY ALL", "trade"),
)
def avg_price_by_date(spark, sf):
    return rounded(pc.avg_price_by_date(trades(spark, sf)), avg_price=4)


MAP_SQL = """SELECT complexNo, areaNo, round(longitude + dense_rank() OVER (ORDER BY areaNo) * 0.0002 - 0.0002, 6) AS longitude_offset,
    round({value} * 1000 / max({value}) OVER (), 4) AS elevation,
    CASE grade WHEN 'excellent' THEN '0,255,0,200' WHEN 'good' THEN '144,238,144,200' WHEN 'average' THEN '255,255,0,200'
               WHEN 'poor' THEN '255,165,0,200' ELSE '255,0,0,200' END AS color,
    '<b>' || complexName || '</b><br/>평수(areaNo): ' || areaNo || '<br/>현재 금액: '
      || format('{{:,}}', CAST(round_even(p1, 0) AS BIGINT)) || '원<br/>변동률(%): ' || printf('%.1f', CAST(round_even(rate, 1) AS DOUBLE))
      || '%<br/>변동금액(원): ' || format('{{:,}}', CAST(round_even(amount, 0) AS BIGINT)) || '원' AS tooltip_text
    FROM graded"""


def _layer(spark, sf, by_rate):
    out = pc.map_layer(changes(spark, sf), by_rate).select(
        "complexNo", "areaNo", "longitude_offset", "elevation",
        F.concat_ws(",", F.transform("color", lambda v: v.cast("string"))).alias("color"), "tooltip_text",
    )
    return rounded(out, longitude_offset=6, elevation=4)


@check("map_layer", sql(MAP_SQL.format(value="p1"), "graded"))
def map_layer(spark, sf):
    return _layer(spark, sf, False)


@check("f31_map_layer_by_rate", sql(MAP_SQL.format(value="abs(rate)"), "graded"))
def f31_map_layer_by_rate(spark, sf):
    return _layer(spark, sf, True)


@check(
    "f13_colour_per_grade",
    sql(
        """SELECT grade, CASE grade WHEN 'excellent' THEN '0,255,0,200' WHEN 'good' THEN '144,238,144,200'
            WHEN 'average' THEN '255,255,0,200' WHEN 'poor' THEN '255,165,0,200' WHEN 'very_poor' THEN '255,0,0,200'
            ELSE '128,128,128,200' END AS color, count(*) AS n
        FROM (SELECT CASE WHEN areaNo = 7 THEN 'none' ELSE grade END AS grade FROM graded) GROUP BY ALL""",
        "graded",
    ),
)
def f13_colour_per_grade(spark, sf):
    grade = F.when(F.col("areaNo") == 7, "none").otherwise(F.col("performance_grade")).alias("grade")
    colour = F.concat_ws(",", F.transform(scoring.grade_colour(F.col("grade")), lambda v: v.cast("string")))
    return changes(spark, sf).select(grade).groupBy("grade").agg(F.count(F.lit(1)).alias("n")).withColumn("color", colour)


@check(
    "f11_f12_change_and_grade",
    sql("SELECT grade AS performance_grade, count(*) AS n, round(avg(rate), 4) AS rate FROM graded GROUP BY ALL", "graded"),
)
def f11_f12_change_and_grade(spark, sf):
    out = changes(spark, sf).groupBy("performance_grade").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price_change_rate").alias("rate")
    )
    return rounded(out, rate=4)


@check(
    "a18_map_centre",
    sql("SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude FROM graded", "graded"),
)
def a18_map_centre(spark, sf):
    return rounded(pc.map_centre(changes(spark, sf)), latitude=6, longitude=6)


@check("a19_max_for_scale", sql("SELECT round(1000 / max(p1), 8) AS height_scale FROM graded", "graded"))
def a19_max_for_scale(spark, sf):
    return rounded(changes(spark, sf).agg((1000 / F.max("end_price")).alias("height_scale")), height_scale=8)


KPI_SQL = """SELECT round(avg(rate), 6) AS mean_rate, round(max(rate), 6) AS max_rate, round(min(rate), 6) AS min_rate,
    count(*) AS units FROM graded"""


@check("kpi", sql(KPI_SQL, "graded"))
def kpi(spark, sf):
    return rounded(pc.kpi(changes(spark, sf)), mean_rate=6, max_rate=6, min_rate=6)


@check(
    "top_bottom",
    sql(
        """SELECT 'top' AS side, * FROM (SELECT complexNo, areaNo, round(rate, 6) AS price_change_rate, grade AS performance_grade
            FROM graded ORDER BY rate DESC, complexNo, areaNo LIMIT 10)
        UNION ALL SELECT 'bottom', * FROM (SELECT complexNo, areaNo, round(rate, 6), grade
            FROM graded ORDER BY rate, complexNo, areaNo LIMIT 10)""",
        "graded",
    ),
)
def top_bottom(spark, sf):
    out = pc.top_bottom(changes(spark, sf)).select("side", "complexNo", "areaNo", "price_change_rate", "performance_grade")
    return rounded(out, price_change_rate=6)


def _order():
    return [F.desc("date"), "complexNo", "areaNo", "dealPrice", "orderkey", "partkey", "discount", "tax"]


LISTING_SQL = """SELECT deal_date AS date, t.complexNo, complexName, areaNo, price AS dealPrice, orderkey
    FROM trade t LEFT JOIN complex USING (complexNo)"""
LISTING = ["date", "complexNo", "complexName", "areaNo", "dealPrice", "orderkey"]


@check("trade_listing", sql(LISTING_SQL, "trade", "complex"))
def trade_listing(spark, sf):
    return pc.trade_listing(trades(spark, sf), complexes(spark, sf), _order()).select(*LISTING)


@check(
    "t1_newest_20",
    sql(
        LISTING_SQL + " ORDER BY deal_date DESC, complexNo, areaNo, price, orderkey, partkey, discount, tax LIMIT 20",
        "trade",
        "complex",
    ),
)
def t1_newest_20(spark, sf):
    return pc.trade_listing(trades(spark, sf), complexes(spark, sf), _order(), rows=20).select(*LISTING)


@check(
    "j1_fact_to_dimension",
    sql(
        """SELECT complexName, count(*) AS n, round(sum(price), 2) AS total
        FROM trade LEFT JOIN (SELECT * FROM complex WHERE complexNo % 3 <> 0) USING (complexNo) GROUP BY ALL""",
        "trade",
        "complex",
    ),
)
def j1_fact_to_dimension(spark, sf):
    """Left join to a dimension that lacks some keys; trades are summed per key before the join."""
    from hanok.operators.joins import with_dimension

    known = complexes(spark, sf).where(F.col("complexNo") % 3 != 0)
    sums = trades(spark, sf).groupBy("complexNo").agg(F.count(F.lit(1)).alias("n"), F.sum("dealPrice").alias("total"))
    out = with_dimension(sums, known, "complexNo").groupBy("complexName").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return rounded(out, total=2)


@check(
    "t2_order_by_date",
    sql("SELECT deal_date AS date, areaNo, max(price) AS price FROM trade GROUP BY ALL", "trade"),
)
def t2_order_by_date(spark, sf):
    out = trades(spark, sf).groupBy("date", "areaNo").agg(F.max("dealPrice").alias("price"))
    return out.orderBy(F.desc("date"), "areaNo")


@check(
    "t4_names_by_best_rate",
    sql("SELECT complexName, round(max(rate), 6) AS price_change_rate FROM graded GROUP BY complexName", "graded"),
)
def t4_names_by_best_rate(spark, sf):
    return rounded(names_by_best(changes(spark, sf), "complexName", "price_change_rate"), price_change_rate=6)


@check("t5_sorted_distinct", sql("SELECT DISTINCT areaNo FROM trade WHERE areaNo IS NOT NULL", "trade"))
def t5_sorted_distinct(spark, sf):
    return trades(spark, sf).select("areaNo").dropna().distinct().orderBy("areaNo")


@check(
    "t6_first_areas_per_complex",
    sql(
        """SELECT complexNo, areaNo FROM (SELECT DISTINCT complexNo, areaNo FROM trade)
        QUALIFY row_number() OVER (PARTITION BY complexNo ORDER BY areaNo) <= 3""",
        "trade",
    ),
)
def t6_first_areas_per_complex(spark, sf):
    units = trades(spark, sf).select("complexNo", "areaNo").distinct()
    return first_per_key(units, ["complexNo"], ["areaNo"], 3)


@check(
    "t3_top_trades",
    sql("SELECT complexNo, areaNo, deal_date AS date, price FROM trade ORDER BY price DESC, complexNo, areaNo, deal_date LIMIT 10", "trade"),
)
def t3_top_trades(spark, sf):
    t = trades(spark, sf).select("complexNo", "areaNo", "date", F.col("dealPrice").alias("price"))
    return first_rows(t, 10, [F.desc("price"), "complexNo", "areaNo", "date"])


@check(
    "w9_area_rank_offset",
    sql("SELECT areaNo, round((dense_rank() OVER (ORDER BY areaNo) - 1) * 0.0002::DOUBLE, 6) AS offset_lon FROM (SELECT DISTINCT areaNo FROM trade)", "trade"),
)
def w9_area_rank_offset(spark, sf):
    ranks = ranked_values(trades(spark, sf), "areaNo", "rank")
    return rounded(ranks.select("areaNo", (F.col("rank") * pc.OFFSET_STEP).alias("offset_lon")), offset_lon=6)


@check(
    "j10_offset_lookup",
    sql(
        """SELECT g.complexNo, g.areaNo, round(g.longitude + r.k * 0.0002, 6) AS longitude_offset
        FROM graded g JOIN (SELECT areaNo, row_number() OVER (ORDER BY areaNo) - 1 AS k FROM (SELECT DISTINCT areaNo FROM graded)) r
          ON r.areaNo = g.areaNo""",
        "graded",
    ),
)
def j10_offset_lookup(spark, sf):
    out = pc.with_offset(changes(spark, sf)).select("complexNo", "areaNo", "longitude_offset")
    return rounded(out, longitude_offset=6)


FRAMES = f"""frame AS (SELECT CAST(unnest(generate_series(DATE '1997-03-01', DATE '{END}', INTERVAL 1 MONTH)) AS DATE) AS frame_month),
    shown AS (SELECT f.frame_month, least(last_day(f.frame_month), DATE '{END}') AS frame_end, t.complexNo, t.areaNo,
                     arg_min(t.price, (t.deal_date, t.price)) AS p0, arg_max(t.price, (t.deal_date, -t.price)) AS p1
              FROM frame f JOIN trade t ON t.deal_date BETWEEN DATE '{START}' AND least(last_day(f.frame_month), DATE '{END}')
              GROUP BY ALL),
    rated AS (SELECT *, (p1 - p0) / p0 * 100 AS rate FROM shown),
    scaled AS (SELECT *, (rate - avg(rate) OVER (PARTITION BY frame_month)) / nullif(stddev_samp(rate) OVER (PARTITION BY frame_month), 0) AS z
               FROM rated)"""


def frames(spark, sf):
    return pc.price_change_frames(trades(spark, sf), complexes(spark, sf), _day(START), _day(END))


@check(
    "price_change_frames",
    sql("", "trade").rstrip() + ", " + FRAMES + """ SELECT frame_month, frame_end, complexNo, areaNo, p0 AS start_price, p1 AS end_price,
        round(rate, 6) AS price_change_rate, round(z, 6) AS z_score,
        CASE WHEN z >= 1 THEN 'excellent' WHEN z >= 0.5 THEN 'good' WHEN z >= -0.5 THEN 'average'
             WHEN z >= -1 THEN 'poor' ELSE 'very_poor' END AS performance_grade FROM scaled""",
)
def price_change_frames(spark, sf):
    out = frames(spark, sf).select(
        "frame_month", "frame_end", "complexNo", "areaNo", "start_price", "end_price", "price_change_rate", "z_score", "performance_grade"
    )
    return rounded(out, price_change_rate=6, z_score=6)


@check(
    "w10_expanding_snapshot",
    sql("", "trade").rstrip() + ", " + FRAMES + " SELECT frame_month, count(*) AS units, round(sum(p1), 2) AS total FROM shown GROUP BY frame_month",
)
def w10_expanding_snapshot(spark, sf):
    out = frames(spark, sf).groupBy("frame_month").agg(F.count(F.lit(1)).alias("units"), F.sum("end_price").alias("total"))
    return rounded(out, total=2)


@check(
    "q14_frame_layers",
    sql("", "trade").rstrip() + ", " + FRAMES + """ SELECT frame_month, complexNo, areaNo,
        round(p1 * 1000 / max(p1) OVER (PARTITION BY frame_month), 4) AS elevation,
        round(127 + (complexNo % 77) / 1000.0::DOUBLE
              + (dense_rank() OVER (PARTITION BY frame_month ORDER BY areaNo) - 1) * 0.0002, 6) AS longitude_offset FROM shown""",
)
def q14_frame_layers(spark, sf):
    out = pc.frame_layers(frames(spark, sf)).select("frame_month", "complexNo", "areaNo", "elevation", "longitude_offset")
    return rounded(out, elevation=4, longitude_offset=6)


@check(
    "j9_month_end_range_join",
    sql(
        """SELECT m.frame_month, count(*) AS trades_until FROM (SELECT DISTINCT deal_month_date AS frame_month FROM trade) m
        JOIN trade t ON t.deal_date <= last_day(m.frame_month) GROUP BY m.frame_month""",
        "trade",
    ),
)
def j9_month_end_range_join(spark, sf):
    """Trades up to each month's end: counted per month first, then summed along the months."""
    from pyspark.sql import Window

    per_month = trades(spark, sf).groupBy(F.col("deal_month_date").alias("frame_month")).agg(F.count(F.lit(1)).alias("n"))
    # One row per month.
    upto = Window.orderBy("frame_month").rowsBetween(Window.unboundedPreceding, 0)
    return per_month.select("frame_month", F.sum("n").over(upto).alias("trades_until"))


@check(
    "f23_month_frames",
    sql(
        """SELECT frame_month, least(last_day(frame_month), hi) AS frame_end
        FROM (SELECT CAST(unnest(generate_series(date_trunc('month', lo) + CASE WHEN day(lo) = 1 THEN INTERVAL 0 MONTH ELSE INTERVAL 1 MONTH END,
                     hi, INTERVAL 1 MONTH)) AS DATE) AS frame_month, hi
              FROM (SELECT min(deal_date) + 3 AS lo, max(deal_date) - 5 AS hi FROM trade))""",
        "trade",
    ),
)
def f23_month_frames(spark, sf):
    span = trades(spark, sf).agg(F.date_add(F.min("date"), 3).alias("lo"), F.date_sub(F.max("date"), 5).alias("hi"))
    return span.select(F.inline(pc.month_frames(F.col("lo"), F.col("hi"))))


@check("w9_rank_of_every_price", sql(
    "SELECT price AS deal_amount, CAST(dense_rank() OVER (ORDER BY price) - 1 AS INTEGER) AS rank FROM (SELECT DISTINCT price FROM trade)", "trade"))
def w9_rank_of_every_price(spark, sf):
    """Distinct prices with their ranks, counted in buckets."""
    return ranked_values(trades(spark, sf), "deal_amount", "rank")


@check("w9_rank_of_names_and_days", sql(
    """SELECT 'name' AS what, aptnm AS value, CAST(dense_rank() OVER (ORDER BY aptnm) - 1 AS INTEGER) AS rank FROM (SELECT DISTINCT aptnm FROM trade)
        UNION ALL SELECT 'day', CAST(deal_date AS VARCHAR), CAST(dense_rank() OVER (ORDER BY deal_date) - 1 AS INTEGER) FROM (SELECT DISTINCT deal_date FROM trade)""",
    "trade"))
def w9_rank_of_names_and_days(spark, sf):
    t = trades(spark, sf)
    ranks = [ranked_values(t, c, "rank").select(F.lit(what).alias("what"), F.col(c).cast("string").alias("value"), "rank") for what, c in (("name", "aptnm"), ("day", "deal_date"))]
    return ranks[0].unionByName(ranks[1])
