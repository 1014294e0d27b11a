"""Answers to landed pages: repeated, corrected, reordered, vanished and late ones, over several runs."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sources import item, xml

from hanok.operators import changes as ch, ledger as lg, worklist as wl
from hanok.plans import landing
from hanok.plans.landing import Run, land_answers
from hanok.schema import RESPONSE_SCHEMA
from hanok.sinks import lake

START = datetime(2024, 5, 1)


def answers(spark, *pages, hour=0):
    return spark.createDataFrame([(code, ym, no, START + timedelta(hours=hour, minutes=i), body) for i, (code, ym, no, body) in enumerate(pages)], RESPONSE_SCHEMA)


def page(code, ym, no, total, *names, per=2):
    return (code, ym, no, xml("".join(item(aptNm=n, floor=i) for i, n in enumerate(names)), total, rows_=per, page_no=no))


class Landing:
    def __init__(self, spark, table):
        self.spark, self.table, self.markers, self.hour = spark, table, f"{table}_markers", 0

    def land(self, *pages, **kind):
        self.hour += 1
        got = land_answers(self.spark, answers(self.spark, *pages, hour=self.hour), self.table, self.markers, ["aptNm", "floor"], **kind)
        return {(r.lawd_cd, r.deal_ym, r.page_no): r.action for r in got.collect()}

    def content(self):
        return rows(self.spark.table(self.table).select("lawd_cd", "deal_ym", "page_no", "row_no", "aptNm"))

    def marked(self):
        return rows(self.spark.table(self.markers).select("lawd_cd", "deal_ym", "total_pages"))

    def drop(self):
        for name in (self.table, self.markers, *(f"{self.table}_{x}" for x in ("index", "runs", "staged"))):
            lake.drop_table(self.spark, name)


@pytest.fixture
def landed(spark):
    made = Landing(spark, "landing_pages")
    made.drop()
    yield made
    made.drop()


def test_answers_are_landed_once_and_corrections_replace_their_page(landed):
    first, last = page("01110", "202401", 1, 3, "A", "B"), page("01110", "202401", 2, 3, "C")
    wrong = ("01110", "202402", 1, xml(code="99", msg="ERROR"))
    empty = page("22220", "202401", 1, 0)
    key = lambda p: p[:3]
    assert landed.land(first, wrong, empty) == {key(first): "created", key(empty): "skipped_empty"}
    assert landed.marked() == [("22220", "202401", 1)]
    assert landed.land(first) == {key(first): "unchanged"}
    assert landed.land(last) == {key(first): "kept", key(last): "created"}
    turned = page("01110", "202401", 1, 3, "B", "A")
    assert landed.land(turned, last) == {key(first): "updated", key(last): "unchanged"}
    assert [(r[2], r[3], r[4]) for r in landed.content()] == [(1, 0, "B"), (1, 1, "A"), (2, 0, "C")]
    assert ("01110", "202401", 2) in landed.marked()


def test_pages_above_a_shrunken_total_go(landed):
    landed.land(*[page("1", "202401", n, 6, f"a{n}", f"b{n}") for n in (1, 2, 3)], page("2", "202401", 1, 1, "x"))
    assert landed.land(page("1", "202401", 1, 2, "a1", "new")) == {("1", "202401", 1): "updated", ("1", "202401", 2): "removed", ("1", "202401", 3): "removed"}
    assert [(r[0], r[2], r[4]) for r in landed.content()] == [("1", 1, "a1"), ("1", 1, "new"), ("2", 1, "x")]
    # a page that a newer answer of the same run puts above the total is not landed
    assert landed.land(page("3", "202402", 3, 6, "late"), page("3", "202402", 1, 1, "only")) == {("3", "202402", 1): "created", ("3", "202402", 3): "stale"}
    # all rows gone: the partition goes
    landed.land(page("4", "202403", 2, 4, "p", "q"))
    assert landed.land(page("4", "202403", 1, 0)) == {("4", "202403", 1): "skipped_empty", ("4", "202403", 2): "removed"}
    assert {r[0] for r in landed.content()} == {"1", "2", "3"}
    assert landed.spark.sql(f"SHOW PARTITIONS {landed.table}").count() == 3


def test_a_gap_is_no_completion_and_is_closed_by_any_later_run(landed):
    landed.land(page("1", "202401", 1, 10, "a", "b"), page("1", "202401", 5, 10, "i", "j"))
    assert landed.marked() == []
    audit = lambda: {(r.lawd_cd, r.deal_ym): (r.finding, r.missing) for r in landing.audit(landed.spark, landed.table, landed.markers).collect()}
    assert audit() == {("1", "202401"): ("no_marker", [2, 3, 4])}
    landed.land(page("1", "202401", 4, 10, "g", "h"), page("1", "202401", 2, 10, "c", "d"))
    assert landed.marked() == []
    landed.land(page("1", "202401", 3, 10, "e", "f"))
    assert landed.marked() == [("1", "202401", 5)] and audit() == {("1", "202401"): ("complete", [])}
    landed.land(page("1", "202401", 5, 11, "i", "j"))
    assert landed.marked() == [("1", "202401", 5)] and audit()[("1", "202401")][1] == [6]


def test_a_run_that_died_finishes_its_own_plan(landed, monkeypatch):
    old, run = page("1", "202401", 1, 1, "old"), Run("r2", START, 10)
    landed.land(old, page("1", "202402", 1, 1, "other"))
    new = page("1", "202401", 1, 1, "new")
    for broken in ("_write_pages", "_write_index"):
        with monkeypatch.context() as m:
            m.setattr(landing, broken, lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
            with pytest.raises(RuntimeError):
                landed.land(new, run=run)
    for _ in range(2):
        assert landed.land(new, run=run) == {("1", "202401", 1): "updated"}
        assert [r[4] for r in landed.content()] == ["new", "other"]
        assert rows(lg.completed_in(landed.spark.table(f"{landed.table}_runs"), "r2")) == [("1", "202401")]
    assert landed.land(new) == {("1", "202401", 1): "unchanged"}


def test_write_once_leaves_pages_with_rows(landed):
    landed.land(page("1", "202401", 1, 4, "a", "b"), page("1", "202401", 2, 0))
    got = landed.land(page("1", "202401", 1, 4, "z", "b"), page("1", "202401", 2, 4, "c"), write_once=True)
    assert got == {("1", "202401", 1): "exists", ("1", "202401", 2): "created"}
    assert [r[4] for r in landed.content()] == ["a", "b", "c"]


def test_only_the_newest_good_answer_of_a_page_counts(landed):
    bad = ("1", "202401", 1, xml(code="99", msg="ERROR"))
    assert landed.land(page("1", "202401", 1, 1, "first"), page("1", "202401", 1, 1, "second"), bad) == {("1", "202401", 1): "created"}
    assert [r[4] for r in landed.content()] == ["second"]
    log = landed.spark.table(f"{landed.table}_runs")
    assert sorted(r.action for r in log.collect()) == ["created", "error", "superseded"]


def test_random_runs_leave_what_the_last_answers_say(landed):
    r, truth = random.Random(4), {}
    for _ in range(6):
        batch = []
        for part in r.sample([("1", "202401"), ("1", "202402"), ("2", "202401")], 2):
            total = r.randrange(1, 4)
            for no in r.sample(range(1, total + 1), r.randrange(1, total + 1)):
                names = [r.choice("abcd") for _ in range(2)]
                batch.append(page(*part, no, total * 2, *names))
                truth[(*part, no)] = names
            for gone in [k for k in truth if k[:2] == part and k[2] > total]:
                del truth[gone]
        landed.land(*batch)
    assert landed.content() == sorted((*k, i, n) for k, names in truth.items() for i, n in enumerate(names))
    index = {tuple(x[:3]): x.row_count for x in landed.spark.table(f"{landed.table}_index").select(*ch.PAGE_KEYS, "row_count").collect()}
    assert index == {k: 2 for k in truth}


def test_runs_fold_to_summary_manifest_and_resume_point(spark, landed):
    codes = spark.createDataFrame([("1",), ("2",)], "lawd_cd STRING")
    slots = wl.keyspace(codes, F.lit("2024-02-15").cast("date"), 2)  # (1, 202402), (2, 202402), (1, 202401), (2, 202401)
    log = lambda: spark.table(f"{landed.table}_runs")
    landed.land(page("1", "202402", 1, 3, "a", "b"), page("1", "202402", 2, 3, "c"), page("2", "202402", 1, 6, "d", "e"), ("2", "202402", 2, xml(code="9", msg="X")), run=Run("r1", START, 100))
    assert lg.resume_point(log(), slots) == ("2", "202402", 2)
    landed.land(page("2", "202402", 2, 6, "f", "g"), page("2", "202402", 3, 6, "h", "i"), page("1", "202401", 1, 0), page("2", "202401", 1, 2, "j", "k"), run=Run("r2", START + timedelta(days=1), 4))
    assert lg.resume_point(log(), slots) == ("1", "202402", 1)
    a, b = lg.run_summaries(log(), slots).orderBy("run_id").collect()
    assert (a.quota_used, a.quota_limit, a.pages_fetched, a.created, a.failed, a.partitions_completed, a.cycles_completed) == (4, 100, 3, 3, 1, 1, 0)
    assert tuple(a.cursor) == ("2", "202402", 2) and a.percent == 25.0
    assert (b.quota_used, b.pages_fetched, b.created, b.skipped_empty, b.partitions_completed, b.cycles_completed) == (4, 4, 3, 1, 3, 1)
    assert tuple(b.cursor) == ("1", "202402", 1) and b.percent == 0.0
    got = lg.manifest(log(), slots, "r2").first()
    assert [tuple(p) for p in got.completed_partitions] == [("1", "202401"), ("2", "202401"), ("2", "202402")]
    assert (got.quota_used, got.quota_limit, got.cycles_completed, got.started_at) == (4, 4, 1, "2024-05-02T00:00:00")


def test_a_manifest_with_all_fields(spark):
    done = spark.createDataFrame([("2", "202401"), ("1", "202402")], "lawd_cd STRING, deal_ym STRING")
    run = spark.sql("SELECT 't' AS ts, 's' AS started_at, 3 AS cycles_completed, named_struct('lawd_cd', '1', 'deal_ym', '202402', 'page_no', 7) AS cursor, 12.5D AS percent, 9 AS quota_used, 10 AS quota_limit")
    got = ch.run_manifest(done, run).first()
    assert (got.ts, got.cursor.page_no, got.percent, got.quota_limit) == ("t", 7, 12.5, 10)
    assert [tuple(p) for p in got.completed_partitions] == [("1", "202402"), ("2", "202401")]


def test_items_of_an_answer_are_staged_one_by_one(spark, landed):
    landed.land(page("01110", "202401", 1, 3, "A", "B"), page("01110", "202401", 2, 3, "C"), page("22220", "202401", 1, 0))
    staged = spark.table("landing_pages_staged")
    found = rows(staged.select("lawd_cd", "page_no", "row_no", "_i.aptNm"))
    assert found == [("01110", 1, 0, "A"), ("01110", 1, 1, "B"), ("01110", 2, 0, "C"), ("22220", 1, None, None)]
    assert staged.select("_answer").distinct().count() == 3
