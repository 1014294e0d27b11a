from conftest import rows
from test_bronze import page

from hanok.plans import refresh
from hanok.session import shared_checkpoint_dir
from hanok.sinks import lake
from hanok.streaming.reflect import reflect_new_pages


def run(spark, bronze, table, checkpoint):
    query = reflect_new_pages(spark, str(bronze), table, str(checkpoint))
    query.awaitTermination()
    assert query.exception() is None
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_restart_takes_only_new_files_and_keeps_their_siblings(spark, tmp_path):
    bronze, checkpoint, table = tmp_path / "bronze", tmp_path / "checkpoint", "streamed"
    lake.drop_table(spark, table)
    page(bronze, "11110", "202401", 1, "aptNm,floor\nA,1\n")
    page(bronze, "01110", "202402", 1, "aptNm,floor\nB,2\n")
    assert run(spark, bronze, table, checkpoint) == 2  # files
    assert run(spark, bronze, table, checkpoint) == 0
    page(bronze, "11110", "202401", 2, "floor,aptNm\n5,late\n")
    assert run(spark, bronze, table, checkpoint) == 1
    got = rows(spark.table(table).select("aptNm", "floor", "lawdCd", "deal_ym"))
    assert got == [("A", "1", "11110", "202401"), ("B", "2", "01110", "202402"), ("late", "5", "11110", "202401")]
    lake.drop_table(spark, table)


def test_a_batch_opens_the_touched_folders_only(spark, tmp_path, monkeypatch):
    bronze, checkpoint, table, opened = tmp_path / "bronze", tmp_path / "checkpoint", "streamed", []
    lake.drop_table(spark, table)
    scan = refresh.bronze.scan_partitions

    def watched(*args):
        df = scan(*args)
        opened.append(sorted("/".join(f.split("/")[-3:]) for f in df.inputFiles()))
        return df

    monkeypatch.setattr(refresh.bronze, "scan_partitions", watched)
    for ym in range(202401, 202413):
        page(bronze, "11110", str(ym), 1, "aptNm,floor\nA,1\n")
    run(spark, bronze, table, checkpoint)
    page(bronze, "11110", "202403", 2, "aptNm,floor\nB,2\n")
    run(spark, bronze, table, checkpoint)
    folder = "LAWD_CD=11110/DEAL_YM=202403"
    assert len(opened[0]) == 12 and opened[1:] == [[f"{folder}/page=1.csv", f"{folder}/page=2.csv"]]
    assert spark.table(table).count() == 13
    lake.drop_table(spark, table)


def test_checkpoint_folder_is_the_one_the_session_names(spark, tmp_path):
    key = "spark.checkpoint.dir"
    before = spark.conf.get(key, None)
    if before is not None:
        assert shared_checkpoint_dir(spark, f"{tmp_path}/own") == before
    else:
        assert shared_checkpoint_dir(spark, f"{tmp_path}/own")
