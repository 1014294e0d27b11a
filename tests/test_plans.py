"""Catalog, planning, change detection and scoring on small fixtures."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hanok.functions import dates, paging, scoring, text
from hanok.operators import changes as ch
from hanok.operators import worklist as wl
from hanok.plans import price_change as pc
from hanok.plans.catalog import DatasetCatalog, lineage_edges, publish_sql_view


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_catalog_builds_in_dependency_order(spark):
    c = DatasetCatalog({"base": spark.range(4)})
    c.define("big", ("even",), lambda d: d.where("id > 1"))
    c.define("even", ("base",), lambda d: d.where("id % 2 = 0"))
    assert c.publish_views() == ["big", "even"]
    assert rows(spark.table("big")) == [(2,)]
    assert rows(c.edges(spark)) == [("base", "even"), ("even", "big")]


def test_catalog_rejects_circles_and_unknown_names(spark):
    c = DatasetCatalog({})
    c.define("a", ("b",), lambda d: d)
    c.define("b", ("a",), lambda d: d)
    c.define("c", ("nowhere",), lambda d: d)
    with pytest.raises(ValueError, match="circle"):
        c.get("a")
    with pytest.raises(ValueError, match="unknown dataset nowhere in c"):
        c.get("c")


def test_views_are_replaced(spark):
    for n in (1, 2):
        publish_sql_view(spark, "published", f"SELECT {n} AS v")
    assert spark.table("published").first().v == 2
    spark.sql("DROP VIEW published")


def test_lineage_of_cte_from_and_join(spark):
    sql = 'WITH m AS (SELECT * FROM iceberg.default.names) SELECT * FROM iceberg."default".base b\nleft JOIN `iceberg`.default.stats s ON true'
    df = spark.createDataFrame([("board", sql), ("none", "SELECT 1"), ("two", "select * from a.b")], "dataset STRING, sql STRING")
    assert rows(lineage_edges(df)) == [("iceberg", f"default.{t}", "board") for t in ("base", "names", "stats")]


def test_connectivity_range(spark):
    assert rows(spark.range(5)) == [(i,) for i in range(5)]


def slots(spark, newest_first=True):
    codes = spark.createDataFrame([("22220",), ("11110",)], "lawd_cd STRING")
    return wl.keyspace(codes, F.lit("2024-02-15").cast("date"), 2, newest_first)


def test_slot_order_and_cursor(spark):
    s = slots(spark)
    listed = [(r.lawd_cd, r.deal_ym) for r in s.orderBy("slot_idx").collect()]
    assert listed == [("11110", "202402"), ("22220", "202402"), ("11110", "202401"), ("22220", "202401")]
    at = lambda *c: s.select(wl.start_slot(s, *c).alias("x")).first().x
    assert (at(None, None), at("22220", "202402"), at("11110", "202401"), at("33330", "202401")) == (0, 1, 2, 0)
    assert s.first().total_slots == 4


def test_quota_cuts_inside_a_slot(spark):
    pages = spark.createDataFrame([("11110", "202402", 3), ("22220", "202402", 4)], "lawd_cd STRING, deal_ym STRING, total_pages INT")
    codes = slots(spark).select("lawd_cd").distinct()
    day = F.lit("2024-02-15").cast("date")
    got = wl.crawl_plan(codes, day, pages, 5, 2, cursor=("11110", "202402", 2))
    assert [(r.lawd_cd, r.start_page, r.used_before, r.fetched) for r in got.orderBy("slot_idx").collect()] == [("11110", 2, 0, 2), ("22220", 1, 2, 3)]
    all_of_it = wl.crawl_plan(codes, day, pages, 100, 2)
    assert all_of_it.agg(F.sum("fetched")).first()[0] == 3 + 4 + 1 + 1
    assert wl.crawl_plan(codes, day, pages, 0, 2).isEmpty()


def test_next_slot_wraps(spark):
    got = {(r.lawd_cd, r.deal_ym): (r.next_lawd_cd, r.next_deal_ym) for r in wl.with_next_slot(slots(spark)).collect()}
    assert got[("22220", "202401")] == ("11110", "202402") and got[("22220", "202402")] == ("11110", "202401")
    old = {(r.lawd_cd, r.deal_ym): (r.next_lawd_cd, r.next_deal_ym) for r in wl.with_next_slot(slots(spark, False), False).collect()}
    assert old[("22220", "202402")] == ("11110", "202401") and old[("22220", "202401")] == ("11110", "202402")


def test_percent_grows_with_the_page_and_is_clamped(spark):
    p = lambda *a: one(spark, paging.percent_position(*[F.lit(v).cast("int") for v in a]))
    assert p(4, 1, 1, 4) == 25 and p(4, 1, 3, 4) == 37.5 and p(4, 9, None, None) == 100 and p(0, 1, 1, 1) == 0


def test_total_pages(spark):
    t = lambda *a: one(spark, paging.total_pages(*[F.lit(v).cast("int") for v in a]))
    assert [t(0, 1000), t(None, 1000), t(1000, 1000), t(1001, 1000), t(5, 0), t(-1, 10)] == [1, 1, 1, 2, 5, 1]


def fingerprints(spark, data):
    df = spark.createDataFrame([("11110", "202401", n, a, b) for n, items in data.items() for a, b in items], "lawd_cd STRING, deal_ym STRING, page_no INT, a STRING, b STRING")
    asked = spark.createDataFrame([("11110", "202401", n) for n in data], "lawd_cd STRING, deal_ym STRING, page_no INT")
    return ch.with_empty_pages(ch.page_fingerprints(df, ["a", "b"]), asked)


def test_page_actions(spark):
    old = fingerprints(spark, {1: [("1", "2"), ("3", None)], 2: [("1", "2")], 3: [("x", "y")], 5: [("1", None)], 6: [("p", "p")]})
    new = fingerprints(spark, {1: [("3", None), ("1", "2")], 2: [("9", "2")], 3: [], 4: [("1", "2")], 5: [(None, "1")], 6: [("p", "p"), ("p", "p")]})
    got = {r.page_no: r.action for r in ch.page_changes(old, new).collect()}
    assert got == {1: "unchanged", 2: "updated", 3: "skipped_empty", 4: "created", 5: "updated", 6: "updated"}
    counts = ch.count_actions(ch.page_changes(old, new)).first()
    assert (counts.pages, counts.created, counts.updated, counts.unchanged, counts.skipped_empty) == (6, 1, 3, 1, 1)


def test_cells_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([(1, "a=", "b"), (2, "a", "=b"), (3, "~", None), (4, None, "~")], "k INT, a STRING, b STRING")
    assert df.groupBy("k").agg(paging.content_fingerprint(["a", "b"]).alias("f")).select("f").distinct().count() == 4


def test_run_manifest_document(spark):
    done = spark.createDataFrame([("2", "202401"), ("1", "202402")], "lawd_cd STRING, deal_ym STRING")
    assert [tuple(p) for p in ch.run_manifest(done).first().completed_partitions] == [("1", "202402"), ("2", "202401")]


def test_month_ranges(spark):
    r = lambda a, b: one(spark, dates.months_between_codes(F.lit(a), F.lit(b)))
    assert r("202311", "202402") == ["202311", "202312", "202401", "202402"]
    assert r("202401", "202401") == ["202401"]
    assert r("", "202401") == [] and r("202402", "202401") == [] and r("2024", "202401") == [] and r("202413", "202501") == []


def test_last_120_months(spark):
    m = one(spark, dates.last_months(F.lit("2025-08-31").cast("date")))
    assert len(m) == 120 and m[0] == "201509" and m[-1] == "202508"


def test_loose_dates(spark):
    d = lambda *a: one(spark, dates.padded_date(*[F.lit(v).cast("int") for v in a]))
    assert str(d(2024, 2, 9)) == "2024-02-09 00:00:00"
    assert d(2024, 2, 30) is None and d(2024, 123, 1) is None and d(2024, None, 1) is None


def test_now_is_iso_text(spark):
    assert one(spark, dates.utc_now_text().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$"))


def test_text_parsers(spark):
    assert one(spark, text.plain_etag(F.lit('"d41d8cd98f00b204e9800998ecf8427e"'))) == "d41d8cd98f00b204e9800998ecf8427e"
    assert one(spark, text.plain_etag(F.lit('"d41d8cd98f00b204e9800998ecf8427e-2"'))) is None
    assert one(spark, text.bucket_path(F.lit("s3a://lake/bronze/x"))) == "lake/bronze/x"
    assert one(spark, text.to_flag(F.lit(" YES "))) and not one(spark, text.to_flag(F.lit("odd")))
    assert one(spark, text.to_flag(F.lit("odd"), True)) and one(spark, text.to_flag(F.lit(None).cast("string"), True))


def test_score_stays_within_one(spark):
    df = spark.createDataFrame([(9.0, 9.0, 9.0, -9.0), (-9.0, -9.0, -9.0, 9.0), (None, None, None, None), (0.3, 0.0, 1.0, 0.0)], "y DOUBLE, m DOUBLE, l DOUBLE, z DOUBLE")
    got = [r.s for r in df.select(scoring.signal_score(*[F.col(c) for c in "ymlz"]).alias("s")).collect()]
    assert got == pytest.approx([1.0, -1.0, 0.0, 0.35])


def test_phase_limits_are_inclusive(spark):
    df = spark.createDataFrame([(0.35,), (0.3499,), (-0.35,), (None,)], "s DOUBLE")
    assert [r.p for r in df.select(scoring.market_phase(F.col("s")).alias("p")).collect()] == ["상승우세", "중립", "조정우세", "중립"]


def test_grades_of_zero_and_missing_deviation(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, float("nan")), (1.0, 1.0)], "x DOUBLE, sd DOUBLE")
    z = scoring.z_score(F.col("x"), F.lit(0.0), F.col("sd"))
    assert [r.g for r in df.select(scoring.performance_grade(z).alias("g")).collect()] == ["very_poor"] * 3 + ["excellent"]


def trade_rows(spark):
    data = [
        (1, 1, "2024-01-20", 100.0), (1, 1, "2024-01-20", 90.0), (1, 1, "2024-02-10", 120.0), (1, 1, "2024-04-30", 60.0),
        (1, 2, "2024-02-01", 50.0), (2, 1, "2024-03-31", 10.0), (2, 1, "2024-03-31", 30.0), (3, 1, "2023-12-31", 1.0),
    ]
    t = spark.createDataFrame(data, "complexNo LONG, areaNo LONG, date STRING, dealPrice DOUBLE").withColumn("date", F.to_date("date"))
    c = spark.createDataFrame([(1, "A", 37.0, 127.0), (2, "B", 38.0, 128.0)], "complexNo LONG, complexName STRING, latitude DOUBLE, longitude DOUBLE")
    return t, c


def test_frames_equal_one_computation_per_month(spark):
    trades, complexes = trade_rows(spark)
    day = lambda s: F.lit(s).cast("date")
    start, end = "2024-01-15", "2024-04-30"
    frames = pc.price_change_frames(trades, complexes, day(start), day(end))
    columns = ["complexNo", "areaNo", "complexName", "start_price", "end_price", "performance_grade"]
    columns += [F.round(c, 9) for c in ("price_change_rate", "z_score")]
    for month, last in (("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-31"), ("2024-04-01", "2024-04-30")):
        alone = pc.price_changes(trades, complexes, day(start), day(last)).select(*columns)
        assert rows(frames.where(F.col("frame_month") == day(month)).select(*columns)) == rows(alone)
    assert frames.select("frame_month").distinct().count() == 3


def test_a_period_without_a_month_start_has_no_frames(spark):
    trades, complexes = trade_rows(spark)
    got = pc.price_change_frames(trades, complexes, F.lit("2024-01-15").cast("date"), F.lit("2024-01-25").cast("date"))
    assert got.isEmpty()


def test_a_single_unit_grades_lowest(spark):
    trades, complexes = trade_rows(spark)
    day = F.lit("2024-03-31").cast("date")
    got = pc.price_changes(trades, complexes, day, day).select("start_price", "end_price", "z_score", "performance_grade").collect()
    assert [tuple(r) for r in got] == [(10.0, 10.0, None, "very_poor")]


def test_empty_period(spark):
    trades, complexes = trade_rows(spark)
    day = F.lit("1999-01-01").cast("date")
    changes = pc.price_changes(trades, complexes, day, day)
    assert changes.isEmpty() and pc.map_layer(changes).isEmpty() and pc.kpi(changes).first().units == 0


def test_unit_traded_on_one_day_has_not_changed(spark):
    from hanok.plans import price_change as pc

    day, later = "2024-03-01", "2024-04-01"
    rows = [(1, 1, day, 100.0), (1, 1, day, 150.0), (2, 1, day, 100.0), (2, 1, later, 130.0), (2, 1, later, 120.0)]
    df = spark.createDataFrame(rows, "complexNo LONG, areaNo LONG, date STRING, dealPrice DOUBLE").withColumn("date", F.to_date("date"))
    got = {r.complexNo: (r.start_price, r.end_price) for r in pc.first_and_last(df).collect()}
    assert got == {1: (100.0, 100.0), 2: (100.0, 120.0)}


def test_table_references_leave_out_comments_and_texts(spark):
    from hanok.functions import text

    sql = "SELECT ' from l.m.n' AS t -- from x.y.z\nFROM a.\"b-c\".d JOIN `e`.f.g /* join h.i.j */ ON 1 = 1 JOIN k.l ON 1 = 1"
    row = spark.createDataFrame([(sql,)], "s STRING").select(text.table_references(F.col("s")).alias("r")).first()
    assert row.r == ["a.b-c.d", "e.f.g"]


def test_only_finite_numbers_are_numbers(spark):
    from hanok.functions import text

    given = ["nan", "Infinity", "-inf", "1e999", "84.97", " 1,200.5 ", "-3", "84d", "", None, "."]
    df = spark.createDataFrame([(v,) for v in given], "v STRING").select(text.lenient_double(F.col("v")).alias("n"))
    assert [r.n for r in df.collect()] == [None, None, None, None, 84.97, 1200.5, -3.0, None, None, None, None]


def test_trades_differing_in_any_column_stay_and_mistyped_years_are_reported(spark):
    from hanok.plans import marts
    from hanok.schema import RAW_SCHEMA

    def row(**cells):
        base = {"lawdCd": "11110", "year": 2024, "month": 3, "dealYear": "2024", "dealMonth": "3", "dealDay": "5", "dealAmount": "1", "excluUseAr": "1"}
        return {f.name: (base | cells).get(f.name) for f in RAW_SCHEMA.fields}

    given = [row(buyerGbn="a"), row(buyerGbn="b"), row(buyerGbn="a"), row(dealYear="2204")]
    raw = spark.createDataFrame([tuple(r.values()) for r in given], RAW_SCHEMA)
    assert marts.trades_from_raw(raw).count() == 2
    assert [r.dealYear for r in marts.misdated_rows(raw).collect()] == ["2204"]


def test_a_reordered_page_is_updated(spark):
    columns = "lawd_cd STRING, deal_ym STRING, page_no INT, row_no INT, name STRING"
    old = spark.createDataFrame([("1", "202401", 1, 0, "a"), ("1", "202401", 1, 1, "b"), ("1", "202401", 2, 0, "c")], columns)
    new = spark.createDataFrame([("1", "202401", 1, 0, "b"), ("1", "202401", 1, 1, "a"), ("1", "202401", 2, 0, "c")], columns)
    prints = [ch.page_fingerprints(d, ["name"], position="row_no") for d in (old, new)]
    assert rows(ch.page_changes(*prints).select("page_no", "action")) == [(1, "updated"), (2, "unchanged")]
    loose = [ch.page_fingerprints(d, ["name"]) for d in (old, new)]
    assert rows(ch.page_changes(*loose).select("page_no", "action")) == [(1, "unchanged"), (2, "unchanged")]
