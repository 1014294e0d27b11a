"""API answers, documents and lists from FIXTURES.md."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hanok.schema import COMPLEX_SCHEMA, RESPONSE_SCHEMA, TRADE_SCHEMA
from hanok.operators import quality
from hanok.operators.changes import run_manifest
from hanok.operators.worklist import state_cursor
from hanok.sinks.files import write_manifest
from hanok.sources import files, responses


def xml(items="", total=None, code="00", msg="OK", rows_=None, page_no=None, header=True):
    head = f"<header><resultCode>{code}</resultCode><resultMsg>{msg}</resultMsg></header>" if header else ""
    extra = "".join(f"<{k}>{v}</{k}>" for k, v in (("totalCount", total), ("numOfRows", rows_), ("pageNo", page_no)) if v is not None)
    return f"<response>{head}<body><items>{items}</items>{extra}</body></response>"


def item(**kv):
    return "<item>" + "".join(f"<{k}>{v}</{k}>" for k, v in kv.items()) + "</item>"


def landed(spark, *bodies):
    from datetime import datetime

    return spark.createDataFrame([(f"r{i}", "202401", 1, datetime(2024, 1, 1), b) for i, b in enumerate(bodies)], RESPONSE_SCHEMA)


def test_none_one_and_many_items(spark):
    pages = responses.parse_pages(
        landed(
            spark,
            xml(item(aptNm="A", floor=3), 1, rows_=1000, page_no=1),
            xml(item(aptNm="B") + item(aptNm="C"), 2),
            xml("", 0),
            xml(header=False),
        )
    )
    got = {r.region: (r.total_count, r.total_pages, len(r["items"]), r.is_error, r.is_suspect) for r in pages.collect()}
    assert got == {"r0": (1, 1, 1, False, False), "r1": (2, 1, 2, False, False), "r2": (0, 1, 0, False, False), "r3": (0, 1, 0, False, False)}
    flat = responses.page_items(pages, ["aptNm", "floor"]).select("region", "aptNm", "floor")
    assert rows(flat) == [("r0", "A", "3"), ("r1", "B", None), ("r1", "C", None)]


def test_empty_page_before_the_last_is_suspect_and_errors_are_split_off(spark):
    pages = responses.parse_pages(
        landed(spark, xml("", 2, rows_=1, page_no=1), xml("", 2, rows_=1, page_no=2), xml(code="99", msg="ERROR"), "not xml", xml(code="", msg=""))
    )
    good, wrong = responses.split_pages(pages)
    assert {r.region for r in wrong.collect()} == {"r0", "r2", "r3"}
    assert {r.region for r in good.collect()} == {"r1", "r4"}
    assert {r.region: r.is_suspect for r in pages.collect()}["r0"]


def test_total_pages_uses_announced_rows(spark):
    pages = responses.parse_pages(landed(spark, xml(item(a=1), 2001), xml(item(a=1), 201, rows_=100), xml(item(a=1), 5, rows_=0)))
    assert [r.total_pages for r in pages.orderBy("region").collect()] == [3, 3, 1]


def test_repeated_fetches_keep_the_newest(spark):
    from datetime import datetime

    df = spark.createDataFrame(
        [("r", "202401", 1, datetime(2024, 1, d), f"v{d}") for d in (1, 3, 2)] + [("r", "202401", 2, datetime(2024, 1, 1), "w")], RESPONSE_SCHEMA
    )
    assert rows(responses.newest_fetch(df).select("page_no", "body")) == [(1, "v3"), (2, "w")]


def test_nested_prices(spark):
    doc = {
        "realPriceOnMonthList": [
            {"realPriceList": [{"tradeYear": "2025년", "tradeMonth": 3, "dealPrice": 100, "formattedTradeYearMonth": "2025.03.22"}]},
            {"realPriceList": []},
            {"realPriceList": [{"dealPrice": 90, "formattedTradeYearMonth": "2024.12.01"}, {"dealPrice": 80, "formattedTradeYearMonth": "2024.11.30"}]},
        ],
        "addedRowCount": 3,
        "totalRowCount": 3,
    }
    df = spark.createDataFrame([(7, 11, json.dumps(doc, ensure_ascii=False)), (8, 1, "{}")], "complexNo LONG, areaNo LONG, body STRING")
    got = responses.price_history(df).select("complexNo", "areaNo", "tradeYear", "tradeMonth", "dealPrice")
    assert rows(got) == [(7, 11, 2024, 11, 80), (7, 11, 2024, 12, 90), (7, 11, 2025, 3, 100)]


def test_unit_types_regions_and_complexes(spark):
    body = json.dumps({"complexNo": 7, "complexName": "X", "eupmeandongCortarName": "D", "pyeongs": [{"pyeongNo": 1}, {"pyeongNo": 2}]})
    units = responses.unit_type_rows(spark.createDataFrame([(body,)], "body STRING"))
    assert rows(units.select("complexNo", "complexName", "pyeongNo")) == [(7, "X", 1), (7, "X", 2)]
    body = json.dumps({"regionList": [{"cortarNo": "1100000000", "cortarName": "Seoul", "centerLat": 37.5, "centerLon": 127.0, "cortarType": "city"}]})
    regions = responses.region_rows(spark.createDataFrame([(body, "0000000000", "all")], "body STRING, parentCortarNo STRING, parentCortarName STRING"))
    assert regions.select("cortarNo", "parentCortarName").first() == ("1100000000", "all")
    body = json.dumps({"complexList": [{"complexNo": 9, "complexName": "Y", "isInterest": False}]})
    complexes = responses.complex_rows(spark.createDataFrame([(body, 1, "d")], "body STRING, eupmeandongCortarNo LONG, eupmeandongCortarName STRING"))
    assert complexes.select("complexNo", "isInterest", "eupmeandongCortarName").first() == (9, False, "d")


def test_manifest_is_one_document(spark, tmp_path):
    path = tmp_path / "latest.json"
    path.write_text(json.dumps({"percent": 1.5, "cursor": {"lawd_cd": "11110", "deal_ym": "202401", "page_no": 2}, "completed_partitions": []}, indent=2))
    m = files.read_manifest(spark, str(path))
    assert m.count() == 1 and m.first().cursor.page_no == 2 and quality.partition_entries(m).isEmpty()


def test_state_defaults(spark, tmp_path):
    assert files.read_state(spark, f"{tmp_path}/none.json").select("version", "done", "cursor").first() == (2, False, None)
    old = tmp_path / "old.json"
    old.write_text('{"cursor": {"lawd_cd": "11110", "deal_ym": "202401", "page_no": 3}}')
    assert files.read_state(spark, str(old)).select("version", "done", "cursor.page_no").first() == (1, False, 3)
    new = tmp_path / "new.json"
    new.write_text('{"version": 2, "done": true}')
    assert files.read_state(spark, str(new)).select("version", "done").first() == (2, True)
    cursor = lambda p, *a: state_cursor(files.read_state(spark, str(p)), *a)
    assert cursor(tmp_path / "none.json") == (True, None) and cursor(old) == (True, ("11110", "202401", 3))
    assert cursor(new) == (False, None) and cursor(new, True) == (True, None)


def test_manifest_round_trip(spark, tmp_path):
    done = spark.createDataFrame([("2", "202401"), ("1", "202402")], "lawd_cd STRING, deal_ym STRING")
    write_manifest(run_manifest(done), f"{tmp_path}/latest.json")
    assert rows(quality.partition_entries(files.read_manifest(spark, f"{tmp_path}/latest.json"))) == [("1", "202402"), ("2", "202401")]


def test_per_entity_files_carry_their_key(spark, tmp_path):
    for no in (7, 12):
        (tmp_path / f"trade_history_{no}.csv").write_text(f"tradeYear,dealPrice\n2024,{no}00\n")
    df = files.read_keyed_csv(spark, f"{tmp_path}/trade_history_*.csv", r"trade_history_(\d+)", "complexNo")
    assert rows(df.select("complexNo", "dealPrice")) == [(12, "1200"), (7, "700")]


def test_csv_tree_and_its_fallback(spark, tmp_path):
    (tmp_path / "t" / "complexNo=1").mkdir(parents=True)
    (tmp_path / "t" / "complexNo=1" / "a.csv").write_text("complexNo,complexName,pyeongNo\n1,A,11\n1,A,11\n1,A,\n")
    (tmp_path / "legacy.csv").write_text("complexNo,complexName,areaNo\n2,B,5\n")
    (tmp_path / "empty").mkdir()
    tree = files.unit_types(files.read_csv_tree(spark, f"{tmp_path}/t"))
    assert rows(tree) == [(1, "A", 11)]
    assert rows(files.unit_types(files.read_csv_tree(spark, f"{tmp_path}/empty", f"{tmp_path}/legacy.csv"))) == [(2, "B", 5)]
    with pytest.raises(ValueError):
        files.read_csv_tree(spark, f"{tmp_path}/empty")


def test_complex_number_list(spark, tmp_path):
    (tmp_path / "list.csv").write_text("complexNo,name\n119219,A\n x1,B\n42,C\n\n")
    assert rows(files.complex_numbers(spark, f"{tmp_path}/list.csv")) == [("119219",), ("42",)]


def test_inferred_columns_are_cast_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text("complexName,complexNo,latitude,isInterest\nA,1,37.5,True\nB,x,,false\n")
    df = files.read_typed_csv(spark, f"{tmp_path}/c.csv", COMPLEX_SCHEMA)
    assert df.columns == COMPLEX_SCHEMA.names
    assert rows(df.select("complexNo", "complexName", "latitude", "isInterest")) == [(1, "A", 37.5, True), (None, "B", None, False)]


def test_forced_parquet_schema(spark, tmp_path):
    spark.sql("SELECT 1L AS complexNo, 'A1' AS tradeType, 9 AS extra").write.parquet(f"{tmp_path}/a.parquet")
    df = files.read_parquet(spark, f"{tmp_path}/*.parquet", TRADE_SCHEMA)
    assert df.columns == TRADE_SCHEMA.names and df.first().complexNo == 1


def test_code_lists(spark):
    df = spark.createDataFrame([("333303333",), (" 111101234",), ("111109999",), (None,), ("",)], "cortarNo STRING")
    assert [r.lawd_cd for r in quality.code_list(df).collect()] == ["11110", "33330"]
    ordered = spark.createDataFrame([(2, "222", "11110"), (1, "x", "33330"), (3, "y", "33330")], "line INT, name STRING, Lawd_Cd STRING")
    assert [r.lawd_cd for r in quality.code_list_in_file_order(ordered, "line").collect()] == ["33330", "11110"]
    with pytest.raises(ValueError):
        quality.code_list(spark.createDataFrame([("1",)], "other STRING"))


def test_code_precedence(spark):
    table = spark.createDataFrame([(1, "22222")], "line INT, lawdCode STRING")
    regions = spark.createDataFrame([(1, "3333300000")], "line INT, cortarNo STRING")
    pick = lambda *a: [r.lawd_cd for r in quality.choose_codes(spark, *a).collect()]
    assert pick(["11110", " ", "11111"], table, regions) == ["11110", "11111"]
    assert pick([], table, regions) == ["22222"] and pick([], None, regions) == ["33333"]
    with pytest.raises(ValueError):
        pick([], regions)


def test_normalised_row(spark):
    df = spark.createDataFrame(
        [("  120,000 ", "2005", "2024", " 5 ", " 3 ", " 84.97 ", " 10 ", "  text  ")], ["거래금액", "건축년도", "년", "월", "일", "전용면적", "층", "other"]
    )
    r = quality.normalise_rows(df).first()
    assert (r["거래금액(만원)"], r["건축년도"], r["년"], r["월"], r["일"], r["전용면적"], r["층"], r["other"]) == (120000, 2005, 2024, 5, 3, 84.97, 10, "text")


def test_english_keys_and_bad_numbers(spark):
    df = spark.createDataFrame([("1,200", "59.9", "B1", "84f")], ["dealAmount", "excluUseAr", "floor", "exclusiveArea"])
    r = quality.normalise_rows(df).first()
    assert (r["거래금액(만원)"], r["전용면적"], r["층"], r["년"]) == (1200, None, None, None)
    assert quality.normalise_rows(df.drop("exclusiveArea")).first()["전용면적"] == 59.9


def test_null_codes_do_not_turn_into_text(spark):
    df = spark.createDataFrame([(None,), ("11110",)], "LAWD_CD STRING")
    assert quality.code_list(df).count() == 1
    assert df.select(F.count("LAWD_CD")).first()[0] == 1


def test_csv_files_are_read_by_their_own_header(spark, tmp_path):
    deep = tmp_path / "t" / "a" / "b" / "c" / "d" / "e" / "f" / "g" / "h"
    deep.mkdir(parents=True)
    (tmp_path / "t" / "trades_12.csv").write_text('p,q\n1,"x, y"\n')
    (tmp_path / "t" / "trades_34.csv").write_text("q,p,r\nz,2,3\n")
    (deep / "trades_56.csv").write_text("r\n9\n")
    tree = files.read_csv_tree(spark, f"{tmp_path}/t")
    assert tree.columns == ["p", "q", "r"]
    assert rows(tree) == rows(spark.createDataFrame([("1", "x, y", None), ("2", "z", "3"), (None, None, "9")], "p STRING, q STRING, r STRING"))
    keyed = files.read_keyed_csv(spark, f"{tmp_path}/t/*.csv", r"trades_(\d+)", "complexNo").select("complexNo", "p", "q")
    assert rows(keyed) == [(12, "1", "x, y"), (34, "2", "z")]
