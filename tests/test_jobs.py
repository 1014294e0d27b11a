from test_bronze import page

from hanok import jobs
from hanok.sinks import lake


def test_load_build_and_write(spark, tmp_path, capsys):
    head = "aptNm,aptSeq,dealAmount,dealYear,dealMonth,dealDay,excluUseAr,sggCd,estateAgentSggNm\n"
    for code in ("11110", "01110"):
        for month in range(1, 4):
            lines = "".join(f'N{i},{code}-{i},"{i + 1},000",2024,{month},{i + 1},84.5,{code},agent {code}\n' for i in range(5))
            page(tmp_path, code, f"2024{month:02d}", 1, head + lines)
    assert jobs.main(["full-load", "--bronze", str(tmp_path), "--table", "job_raw"]) == 0
    jobs.main(["build-marts", "--database", "job_db", "--table", "job_raw"])
    jobs.main(["write-boards", "--database", "job_db"])
    assert "region_decision_latest" in capsys.readouterr().out
    got = {(r.sggcd, r.region_ko, r.trades) for r in spark.table("job_db.region_decision_latest").collect()}
    assert got == {("11110", "agent 11110", 5), ("01110", "agent 01110", 5)}
    jobs.main(["incremental-load", "--bronze", str(tmp_path), "--manifest", f"{tmp_path}/none.json", "--table", "job_raw"])
    assert "nothing to do" in capsys.readouterr().out
    jobs.main(["drop-table", "--table", "job_raw"])
    assert not spark.catalog.tableExists("job_raw")
    lake.drop_table(spark, "job_raw")
    spark.sql("DROP DATABASE job_db CASCADE")


def test_price_changes_and_landing(spark, tmp_path, capsys):
    from datetime import datetime

    from test_sources import item, xml

    lake.create_database(spark, "price_db")
    trades = [(1, 1, "2024-01-05", 100.0), (1, 1, "2024-03-05", 150.0), (2, 1, "2024-02-01", 80.0), (2, 1, "2024-02-01", 90.0)]
    df = spark.createDataFrame(trades, "complexNo LONG, areaNo LONG, date STRING, dealPrice DOUBLE").selectExpr("complexNo", "areaNo", "to_date(date) AS date", "dealPrice")
    lake.replace_table(df, "price_db.trade_history")
    places = [(1, "one", 37.0, 127.0), (2, "two", 37.1, 127.1)]
    lake.replace_table(spark.createDataFrame(places, "complexNo LONG, complexName STRING, latitude DOUBLE, longitude DOUBLE"), "price_db.complexes")
    jobs.main(["write-price-changes", "--database", "price_db", "--start", "2024-01-01", "--end", "2024-03-31"])
    assert "price_change_frame_layers" in capsys.readouterr().out
    got = {r.complexNo: r.price_change_rate for r in spark.table("price_db.price_change").collect()}
    assert got == {1: 50.0, 2: 0.0}
    spark.sql("DROP DATABASE price_db CASCADE")
    answers = [("01110", "202401", 1, datetime(2024, 5, 1), xml(item(aptNm="A"), 1, page_no=1))]
    spark.createDataFrame(answers, "region STRING, deal_ym STRING, page_no INT, fetched_at TIMESTAMP, body STRING").write.parquet(f"{tmp_path}/answers")
    jobs.main(["land-answers", "--answers", f"{tmp_path}/answers", "--table", "job_pages", "--markers", "job_markers"])
    assert "created" in capsys.readouterr().out and spark.table("job_pages").count() == 1
    for name in ("job_pages", "job_markers", "job_pages_index", "job_pages_runs", "job_pages_staged"):
        lake.drop_table(spark, name)


def test_a_run_from_answers_to_marts_and_the_next_worklist(spark, tmp_path, capsys):
    from datetime import datetime

    from test_sources import item, xml

    trade = lambda name, day: item(aptNm=name, aptSeq=f"{name}-1", dealAmount="90,000", excluUseAr="84.5", dealYear=2024, dealMonth=3, dealDay=day, sggCd="11110")
    one = xml(trade("A", 1) + trade("B", 2), 3, rows_=2, page_no=1)
    rest = xml(trade("C", 3), 3, rows_=2, page_no=2)
    (tmp_path / "codes.csv").write_text("LAWD_CD,name\n11110,x\n22220,y\n")
    schema = "region STRING, deal_ym STRING, page_no INT, fetched_at TIMESTAMP, body STRING"
    spark.createDataFrame([("11110", "202403", 1, datetime(2024, 4, 1), one)], schema).write.parquet(f"{tmp_path}/a1")
    spark.createDataFrame([("11110", "202403", 2, datetime(2024, 4, 2), rest)], schema).write.parquet(f"{tmp_path}/a2")
    pages = ["--pages", "run_pages", "--markers", "run_markers", "--day", "2024-04-15", "--months", "3"]
    codes = ["--codes", f"{tmp_path}/codes.csv"]
    jobs.main(["daily-sync", "--answers", f"{tmp_path}/a1", "--database", "run_db", "--table", "run_raw", "--run", "r1", *pages])
    jobs.main(["worklist", "--quota", "3", "--out", f"{tmp_path}/plan", *pages, *codes])
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/plan").select("deal_ym", "lawd_cd", "start_page", "fetched").orderBy("percent").collect()]
    assert got == [("202403", "11110", 2, 1), ("202403", "22220", 1, 1), ("202402", "11110", 1, 1)]
    jobs.main(["land-answers", "--answers", f"{tmp_path}/a2", "--run", "r2", "--quota-limit", "9", "--manifest", f"{tmp_path}/latest.json", *pages, *codes])
    assert spark.table("run_raw").count() == 2  # landed, not yet reflected
    for _ in range(2):
        jobs.main(["incremental-load", "--pages", "run_pages", "--manifest", f"{tmp_path}/latest.json", "--table", "run_raw"])
    assert "reflected" in capsys.readouterr().out
    raw = spark.table("run_raw")
    assert sorted(r.aptNm for r in raw.collect()) == ["A", "B", "C"] and raw.where("_file LIKE '%LAWD_CD=11110/DEAL_YM=202403/page=2.csv'").count() == 1
    jobs.main(["change-report", *pages, *codes])
    assert "r2" in capsys.readouterr().out
    jobs.main(["audit", "--out", f"{tmp_path}/audit", *pages])
    assert [(r.finding, r.missing) for r in spark.read.parquet(f"{tmp_path}/audit").collect()] == [("complete", [])]
    assert spark.table("run_db.region_monthly_stats").first().trades == 2
    for name in ("run_pages", "run_markers", "run_pages_index", "run_pages_runs", "run_pages_staged", "run_raw"):
        lake.drop_table(spark, name)
    spark.sql("DROP DATABASE run_db CASCADE")
