"""The filter audit, the ranked search and the line dedup against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hanok.llm import audit, lines, search

DOCS = "doc_id LONG, text STRING"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# filter audit


def brute_steps(masks, letters):
    out, shapley = [], Counter()
    for order in itertools.permutations(range(len(letters))):
        seen = 0
        for step, i in enumerate(order, 1):
            bit = 1 << i
            removed = [sum(c[k] for m, c in masks.items() if m & bit and not m & seen) for k in range(3)]
            seen |= bit
            shapley[i] += removed[0]
            kept = sum(c[0] for m, c in masks.items() if not m & seen)
            failing = sum(c[0] for m, c in masks.items() if m & bit)
            only = sum(c[0] for m, c in masks.items() if m == bit)
            out.append(("".join(letters[j] for j in order), step, kept, removed[0], failing - removed[0], only, *removed[1:], i))
    return sorted((*r[:-1], shapley[r[-1]]) for r in out)


@pytest.mark.parametrize("n", range(1, 6))
def test_swaps_lead_through_all_orders(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for k in audit.neighbour_swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.append(tuple(order))
    assert sorted(seen) == sorted(itertools.permutations(range(n)))


@pytest.mark.parametrize("n", range(1, 6))
def test_steps_of_all_orders(n):
    r = random.Random(n)
    for some in (1, 2, 2**n):
        masks = {m: (r.randrange(1, 9), r.randrange(3), r.randrange(3)) for m in r.sample(range(2**n), min(some, 2**n))}
        assert sorted(audit.steps(masks, "ABCDE"[:n])) == brute_steps(masks, "ABCDE"[:n])


def test_swapped_diagram_is_the_one_built_in_that_order():
    r = random.Random(7)
    masks = {m: (r.randrange(3), 0, 0) for m in range(32)}
    diagram = audit.Diagram(masks, 5, 3)
    for k in (0, 3, 1, 2, 0, 3):
        diagram.swap(k)
    turned = {sum((m >> f & 1) << place for place, f in enumerate(diagram.order)): c for m, c in masks.items()}
    fresh = audit.Diagram(turned, 5, 3)
    assert [len(x) for x in diagram.levels] == [len(x) for x in fresh.levels]
    assert [s[0] for s in diagram.sums] == [s[0] for s in fresh.sums]
    assert [x[1:] for x in diagram.all_pass()] == [x[1:] for x in fresh.all_pass()]


def test_equal_branches_share_a_node():
    diagram = audit.Diagram({m: (1, 0, 0) for m in range(32)}, 5, 3)
    assert [len(x) for x in diagram.levels] == [1] * 5 and diagram.sums[0] == [(32, 0, 0)]


def test_flags_of_texts():
    words = " ".join(f"w{i}" for i in range(200))
    assert audit.text_flags(words.encode()) == (False, False, False, False)
    assert audit.text_flags(b"") == (True, False, False, False)
    assert audit.text_flags(("a " * 400).encode()) == (False, True, False, False)
    assert audit.text_flags((words + " é" * 3 + "A" * 40 + "$").encode()) == (False, False, True, True)
    assert audit.text_flags(("é" * 97 + "AAA").encode())[2] is False and audit.text_flags(("é" * 96 + "AAA").encode())[2] is True


def test_audit_of_odd_rows(spark):
    texts = ["x", None, "", "x", "x", "Long " * 30_000, "$", "x"]
    docs = spark.createDataFrame(
        [(i, t, ("en", None, "de")[i % 3], 1, "m") for i, t in enumerate(texts)] + [(3, "x", "en", 1, "m"), (None, "x", "en", 1, "m")],
        "doc_id LONG, text STRING, lang STRING, mask INT, part STRING",
    )
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (3, None, None), (6, 1, 1), (None, 1, 1)], "doc_id LONG, quality INT, toxic INT")
    got = audit.audit(docs, labels).collect()
    assert len(got) == 3 * 600 and len({(r.part, r.filter_order, r.step) for r in got}) == 1800
    step = {(r.part, r.filter_order, r.step): r for r in got}
    first = {(p, x): step[p, x + "".join(c for c in "ABCDE" if c != x), 1] for p in ("en", "", "de") for x in "ABCDE"}
    # en: 0, 3 (twice), 6 and the row without doc_id; "": 1, 4, 7; de: 2, 5
    assert [first["en", x].removed for x in "ABCDE"] == [5, 0, 0, 1, 2]  # both rows of doc 3 copy doc 0
    assert [first["", x].removed for x in "ABCDE"] == [3, 0, 0, 0, 2]
    assert [first["de", x].removed for x in "ABCDE"] == [1, 1, 1, 0, 1]  # 2 is empty as 1 is
    assert (first["en", "E"].good_lost, first["en", "E"].toxic_lost, first["en", "D"].good_lost) == (2, 2, 1)
    assert audit.audit(docs.limit(0), labels).count() == 0
    assert {r.good_lost for r in audit.audit(docs, labels.limit(0)).collect()} == {0}


def test_other_filters_and_weights(spark):
    masks = spark.createDataFrame([("p", 3, 5), ("p", 1, None), ("p", 0, 2)], "part STRING, mask INT, bytes INT")
    got = rows_of(audit.interactions(masks, "XY", {"lost": F.col("bytes")}))
    assert got == [("p", "XY", 1, 1, 2, 0, 1, 5, 3), ("p", "XY", 2, 1, 0, 1, 0, 0, 1), ("p", "YX", 1, 2, 1, 0, 0, 5, 1), ("p", "YX", 2, 1, 1, 1, 1, 0, 3)]


# ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, top=50):
    counted = [(i, Counter(brute_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(brute_terms(text))
    out = []
    for item, asked in own.items():
        scores = []
        for doc, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def random_docs(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    return [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(40)], k=r.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("at_once", [200_000, 8])
def test_search_in_small_blocks(spark, monkeypatch, at_once):
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    docs = random_docs(1, 300)
    items = [(i, " ".join(f"W{k}" for k in random.Random(i).sample(range(45), 9))) for i in range(7)]
    got = search.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, "item_id LONG, text STRING"), 10, at_once)
    assert rows_of(got) == brute_search(docs, items, 10)


def test_search_of_odd_rows(spark):
    docs = [(1, "Alpha beta"), (1, "Alpha beta"), (None, "alpha beta"), (0, "alpha beta"), (5, None), (6, ""), (7, "!?"), (8, "été " * 50_000), (9, " alpha\x1fbeta")] + [(20 + i, "gamma") for i in range(9)]
    items = [("a", "alpha, BETA alpha"), ("a", "délta"), (None, "été"), ("b", None), ("c", "!"), ("d", "absent")]
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], DOCS + ", score LONG, rank INT")
    asked = spark.createDataFrame([(*i, 3) for i in items], "item_id STRING, text STRING, doc_id INT")
    got = search.search(table, asked, 50)
    assert rows_of(got) == brute_search(docs, items) and got.count() == 6
    assert search.search(table.limit(0), asked).count() == 0 and search.search(table, asked.limit(0)).count() == 0
    assert search.search(table.where("doc_id IN (5, 6, 7)"), asked).count() == 0


def test_ties_at_the_last_rank_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 4)
    docs = [(i, "alpha beta") for i in range(30, 0, -1)] + [(100 + i, "other words") for i in range(60)]
    got = search.search(spark.createDataFrame(docs, DOCS).coalesce(2), spark.createDataFrame([(1, "alpha beta")], "item_id LONG, text STRING"), 5)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_bounds_of_pairs_hold_and_are_tighter():
    r = np.random.default_rng(3)
    n, kinds = 400, 12
    times = [{d: int(r.integers(1, 9)) for d in r.choice(n, size=20 + 25 * t, replace=False)} for t in range(kinds)]
    place = np.concatenate([np.sort(np.array(list(x))) for x in times])
    row = {
        "length": r.integers(20, 400, n), "term": np.arange(kinds), "start": np.append(0, np.cumsum([len(x) for x in times])),
        "place": place.astype(np.int16), "times": np.concatenate([[x[d] for d in sorted(x)] for x in times]),
    }
    plan = search.Plan.make({1: list(range(kinds))}, np.array([len(x) for x in times]), n, int(row["length"].sum()))
    plain = search.Block(row, plan)
    pairs, lists, tops = plain.pair_lists()
    full = search.Block(row | {"impact": plain.impact, "pair": pairs, "pair_start": np.append(0, np.cumsum([len(x) for x in lists])), "pair_place": np.concatenate(lists), "pair_top": tops}, plan)
    every, scores = np.arange(n), np.zeros(n, np.int64)
    tighter = 0
    for unit in plan.units[0]:
        added = sum(full.added(t, every) for t in unit)
        alone = sum(full.top[t] for t in unit)
        assert added.max() <= full.bound(unit) <= alone
        tighter += full.bound(unit) < alone
        scores += added
    assert tighter >= 4
    assert (full.pair_scores(0) <= scores).all() and full.pair_scores(0).any()
    for k in (1, 5, 50):
        least = int(np.sort(scores)[-k])
        places, found, candidates = full.best(0, least)
        assert dict(zip(places, found)) == {d: s for d, s in enumerate(scores) if s >= least}
        full.bound, bound = lambda unit: sum(full.top[t] for t in unit), full.bound
        assert candidates <= full.best(0, least)[2]
        full.bound = bound
    assert full.best(0, int(scores.max()) + 1)[2] < n


# line dedup


def brute_lines(docs, min_chars=40, min_docs=5):
    split, holders = [], {}
    for doc, text in docs:
        parts = [(x, x.strip(" \t\n\v\f\r").translate(LOWER)) for x in (text or "").split("\n")]
        split.append((doc, parts))
        for _, key in parts:
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(-(1 << 63) if doc is None else doc)
    out = []
    for doc, parts in split:
        kept = [x for x, key in parts if len(holders.get(key, ())) < min_docs or max(holders[key]) == (-(1 << 63) if doc is None else doc)]
        out.append((doc, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def dedup(spark, docs, **kind):
    found = lines.without_repeated(spark.createDataFrame(docs, DOCS).repartition(4), **kind)
    return rows_of(found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)))


ODD = (
    [(i, f"own line of document {i} that nobody else has, really\n  A line that Many documents hold, with blanks around it\t\r\nshort") for i in range(6)]
    + [(3, "a line that many documents hold, with blanks around it"), (3, "a line that many documents hold, with blanks around it"), (None, "A LINE that many documents hold, with blanks around it"), (None, None), (90, ""), (91, "\n\n")]
    + [(100 + i, "é" * 40 + "\n" + "é" * 39 + "\n" + " " + "x" * 39) for i in range(5)]
    + [(200, "one line of one document, five times in it\n" * 5), (300, "x" * 200_000 + "\n" + "own line of document 0 that nobody else has, really")]
    + [(400, "four documents hold this line, though one does twice")] * 2 + [(401 + i, "four documents hold this line, though one does twice") for i in range(3)]
)


def test_lines_of_odd_rows(spark):
    assert dedup(spark, ODD) == brute_lines(ODD)
    assert lines.without_repeated(spark.createDataFrame([], DOCS)).count() == 0
    clash = spark.createDataFrame([(i, "z" * 50, 1, 2, "a") for i in range(5)], "doc_id INT, text STRING, row INT, shard INT, lost STRING")
    assert [r.n_dropped for r in lines.without_repeated(clash).orderBy("doc_id").collect()] == [1, 1, 1, 1, 0]


def test_hot_lines_many_shards_and_small_buffers_change_nothing(spark, monkeypatch):
    r = random.Random(2)
    common = [f"line number {i} that some of the documents share with others" for i in range(30)]
    docs = [(i, "\n".join(r.sample(common, r.randrange(6)) + [f"a line that only document {i} has, whatever it says", common[0]])) for i in range(200)]
    want = brute_lines(docs)
    assert dedup(spark, docs) == want
    monkeypatch.setattr(lines, "SHARD_KEYS", 5)
    monkeypatch.setattr(lines, "BUFFER", 7)
    assert dedup(spark, docs) == want
    monkeypatch.setattr(lines, "HOT_LEAST", 50)
    assert dedup(spark, docs) == want
    monkeypatch.setattr(lines, "HOT_SHARE", 10)
    assert dedup(spark, docs, min_chars=20, min_docs=3) == brute_lines(docs, 20, 3)


def test_perfect_hash_numbers_keys_without_holes():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 20_000):
        high, low = r.integers(0, 1 << 63, n, np.uint64), r.integers(0, 1 << 63, n, np.uint64)
        high[: n // 2] = 7  # half of each key may be equal
        hashed = lines.PerfectHash.build(high, low)
        assert sorted(hashed.places(high, low)) == list(range(n)) and len(hashed.bits) <= 128 + 6 * n


def test_a_shard_tells_strangers_from_its_keys(spark):
    texts = [(i, "\n".join(f"line {k} of all, long enough to be counted as one" for k in range(50))) for i in range(5)]
    docs = spark.createDataFrame(texts, DOCS).withColumn("row", F.lit(0).cast("long"))
    table = lines.line_table(docs)
    shard = lines.index(table, 1).first().asDict()
    assert len(shard["prints"]) == 4 * 50 and len(shard["counts"]) == 50 and len(shard["last"]) == 8 * 50
    r = np.random.default_rng(1)
    strangers = r.integers(0, 1 << 63, 10_000, np.uint64), r.integers(0, 1 << 63, 10_000, np.uint64)
    assert not lines.look_up(shard, *strangers, 5)[0].any()
    own = lines._halves(table.first()["hashes"])
    found, holder = lines.look_up(shard, *own, 5)
    assert found.all() and (holder == 4).all()
