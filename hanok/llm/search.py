"""The best documents for every query under a BM25-like score, by MaxScore with bounds on pairs of terms.

The index consists of blocks of documents, a row each: postings of the queries' terms, and for pairs of terms the list of the documents
that hold both, with the greatest impact that the two have together in one of them. A query's terms are paired with the next in rarity,
and a pair is worth at most the greatest of its joint maximum and its two single ones, which is less than the sum of the two. These bounds
say which terms cannot lift a document into the best ones by themselves; only the postings of the others name candidates, and candidates
are dropped as soon as the bounds of what is still to come cannot save them.

Scores from the pair lists alone never exceed the true ones, so the k-th best of them over all blocks is the threshold to start from.
All arithmetic on scores is in whole numbers, so dropping is exact; ties go to the smaller doc_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hanok.llm.shared import as_bytes, map_batches, written

TOP = 50
BLOCK_DOCS = 8192  # documents of a block, numbered in 16 bits
BLOCK_BYTES = 32 << 20  # text of a block, if it has several documents
QUERY_TERMS = 200_000  # terms of the queries that go to the tasks at a time, on average
SALTS = 64

# What counts as part of a term: digits, a-z, and every byte of a character beyond ASCII. A-Z become a-z.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

BLOCK = "doc_id array<long>, length array<long>, term array<int>, start array<int>, place array<short>, times array<int>"
LISTS = "impact array<int>, pair array<int>, pair_start array<int>, pair_place array<short>, pair_top array<long>"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): the different terms of every item, those of all its rows together."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(set(terms(x))) for x in as_bytes(batch.column(1))]
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
        return pa.RecordBatch.from_arrays([ids, pa.array([t for x in found for t in x], pa.binary()).cast(pa.string())], names=["item_id", "term"])

    kind = dict(items.dtypes)[item_id]
    return map_batches(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")), f"item_id {kind}, term string", rows).distinct()


def blocks(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per block of documents: their ids and lengths, and per term of ``vocabulary`` its documents and occurrences.

    Documents without any term of the vocabulary only count in the lengths. A null doc_id is kept as null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        ids, lengths, keys, counts, size = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            key, times = np.concatenate([*keys, np.empty(0, np.int64)]), np.concatenate([*counts, np.empty(0, np.int64)])
            order = np.argsort(key, kind="stable")  # by term; documents stay in order
            key, times = key[order], times[order]
            term, start = np.unique(key >> 16, return_index=True)
            columns = [ids, lengths, term, np.append(start, len(key)), key & 0xFFFF, times]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int16(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.list_(k)) for x, k in zip(columns, kinds)], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                found = terms(text)
                own = np.fromiter(map(numbers.get, found, repeat(-1)), np.int64, len(found))
                own, times = np.unique(own[own >= 0], return_counts=True)
                keys.append((own << 16) | len(ids))
                counts.append(times)
                ids.append(doc_id)
                lengths.append(len(found))
                size += len(text)
                if len(ids) == BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield block()
                    ids, lengths, keys, counts, size = [], [], [], [], 0
        if ids:
            yield block()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCK)


@dataclass
class Plan:
    """What the tasks need of a group of queries and of the whole corpus."""

    items: list  # ids of the queries
    weights: np.ndarray  # by term
    units: list[list[tuple[int, ...]]]  # by query: its terms, paired with the next in rarity
    pairs: dict[tuple[int, int], int]
    n_docs: int
    n_terms: int

    @classmethod
    def make(cls, queries: dict, df: np.ndarray, n_docs: int, n_terms: int) -> Plan:
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        units, pairs = [], {}
        for own in queries.values():
            order = sorted((t for t in own if weights[t] > 0 and df[t] > 0), key=lambda t: (-weights[t], t))
            units.append([tuple(sorted(order[i : i + 2])) for i in range(0, len(order), 2)])
            for u in units[-1]:
                if len(u) == 2:
                    pairs.setdefault(u, len(pairs))
        return cls(list(queries), weights, units, pairs, n_docs, n_terms)


class Block:
    """Postings and pair lists of one row of the index."""

    def __init__(self, row: dict[str, np.ndarray], plan: Plan):
        self.plan, self.n = plan, len(row["length"])
        self.slot = {int(t): i for i, t in enumerate(row["term"])}
        self.start, self.place = row["start"], row["place"]
        if "impact" in row:
            self.impact = row["impact"]
            self.pair_slot = {int(p): i for i, p in enumerate(row["pair"])}
            self.pair_start, self.pair_place, self.pair_top = row["pair_start"], row["pair_place"], row["pair_top"]
        else:
            middle = 100 - 50 + (50 * row["length"] * plan.n_docs) // plan.n_terms
            times = row["times"].astype(np.int64)
            self.impact = ((1_000_000_000 * times) // (1000 * times + 20 * middle[self.place])).astype(np.int32)
        tops = np.maximum.reduceat(self.impact, self.start[:-1]) if len(self.slot) else self.impact
        self.top = {t: int(plan.weights[t]) * int(x) for t, x in zip(self.slot, tops)}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a term and what it adds to their scores."""
        i = self.slot[term]
        a, b = self.start[i], self.start[i + 1]
        return self.place[a:b], self.impact[a:b] * self.plan.weights[term]

    def added(self, term: int, places: np.ndarray) -> np.ndarray:
        """What a term adds to the scores of documents, zero where it does not occur."""
        own, scores = self.postings(term)
        at = np.minimum(np.searchsorted(own, places), len(own) - 1)
        return np.where(own[at] == places, scores[at], 0)

    def pair_lists(self) -> tuple[list[int], list[np.ndarray], list[int]]:
        """Pairs of the plan that meet in this block, the documents of each, and the greatest joint impact."""
        found, lists, tops, score = [], [], [], np.zeros(self.n, np.int64)
        for (a, b), pair in self.plan.pairs.items():
            if a in self.slot and b in self.slot:
                if len(self.postings(a)[0]) > len(self.postings(b)[0]):
                    a, b = b, a
                few, scores = self.postings(a)
                many, more = self.postings(b)
                score[many] = more
                joint = score[few]
                score[many] = 0
                both = joint > 0
                if both.any():
                    found.append(pair)
                    lists.append(few[both])
                    tops.append(int((joint + scores)[both].max()))
        return found, lists, tops

    def bound(self, unit: tuple[int, ...]) -> int:
        """The most that a pair (or a single term) adds to one document of this block."""
        single = [self.top.get(t, 0) for t in unit]
        if len(unit) == 2 and all(single):
            i = self.pair_slot.get(self.plan.pairs[unit])
            single.append(int(self.pair_top[i]) if i is not None else 0)
        return max(single)

    def pair_scores(self, query: int) -> np.ndarray:
        """Per document the sum over the query's pairs of what both terms add where they meet: never more than its score."""
        found = np.zeros(self.n, np.int64)
        for unit in self.plan.units[query]:
            i = self.pair_slot.get(self.plan.pairs.get(unit, -1))
            if i is not None:
                places = self.pair_place[self.pair_start[i] : self.pair_start[i + 1]]
                found[places] += self.added(unit[0], places) + self.added(unit[1], places)
        return found

    def best(self, query: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that score ``least`` or more, their scores, and how many were candidates."""
        units = [(self.bound(u), u) for u in self.plan.units[query]]
        units = sorted(x for x in units if x[0] > 0)
        below = np.cumsum([0, *(x[0] for x in units)])  # the most that the first k units add
        weak = int(np.searchsorted(below[1:], least))  # units that cannot reach ``least``, even together
        if weak == len(units):
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        scores = np.zeros(self.n, np.int64)
        for _, unit in units[weak:]:
            for t in unit:
                if t in self.slot:
                    places, more = self.postings(t)
                    scores[places] += more
        places = np.flatnonzero(scores)
        candidates, scores = len(places), scores[places]
        for k in range(weak - 1, -1, -1):
            alive = scores + below[k + 1] >= least
            places, scores = places[alive], scores[alive]
            for t in units[k][1]:
                if t in self.slot and len(places):
                    scores += self.added(t, places)
        alive = scores >= least
        return places[alive], scores[alive], candidates


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[dict[str, np.ndarray], pa.RecordBatch]]:
    """Every row of index batches as arrays, and as a batch of one row."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield {c: row.column(c)[0].values.to_numpy(zero_copy_only=False) for c in names}, row


def with_pairs(index: DataFrame, plan) -> DataFrame:
    """The blocks with impacts in place of occurrences, and the pair lists. ``plan`` is a broadcast ``Plan``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in _rows(batches, ["length", "term", "start", "place", "times"]):
            block = Block(row, plan.value)
            pairs, lists, tops = block.pair_lists()
            starts = np.append(0, np.cumsum([len(x) for x in lists])) if lists else np.zeros(1)
            columns = [block.impact, pairs, starts.astype(np.int64), np.concatenate([*lists, np.empty(0, np.int16)]).astype(np.int16), tops]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int16(), pa.int64()]
            added = [pa.array([x], pa.list_(k)) for x, k in zip(columns, kinds)]
            names = [c.split()[0] for c in LISTS.split(", ")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*batch.schema.names[:-1], *names])

    return index.mapInArrow(run, BLOCK.rsplit(", ", 1)[0] + ", " + LISTS)


_INDEX = ["length", "term", "start", "place", "impact", "pair", "pair_start", "pair_place", "pair_top"]


def _best_rows(found: DataFrame, by: list, top: int) -> DataFrame:
    """The first ``top`` rows of every query, with their rank; a query's rows meet in two steps."""
    salted = Window.partitionBy("query", "salt").orderBy(*by)
    some = found.withColumn("salt", F.pmod(F.xxhash64("score", "doc_id"), F.lit(SALTS))).withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("rank") <= top).drop("salt")


def thresholds(index: DataFrame, plan, top: int) -> dict[int, int]:
    """Per query the ``top``-th best sum of pairs over all documents, where so many have one: no score below it is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty(0, np.int64)] * len(plan.value.items)
        for row, _ in _rows(batches, _INDEX):
            block = Block(row, plan.value)
            for q, held in enumerate(best):
                scores = block.pair_scores(q)
                held = np.concatenate([held, scores[scores > (held.min() if len(held) == top else 0)]])
                best[q] = np.partition(held, len(held) - top)[-top:] if len(held) > top else held
        queries = np.repeat(np.arange(len(best)), [len(x) for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int32()), pa.array(np.concatenate([*best, np.empty(0, np.int64)]))], names=["query", "score"])

    found = index.select(*_INDEX).mapInArrow(run, "query int, score long").withColumn("doc_id", F.monotonically_increasing_id())
    return {r["query"]: r["score"] for r in _best_rows(found, [F.desc("score")], top).where(F.col("rank") == top).select("query", "score").collect()}


def best_documents(index: DataFrame, plan, least: dict[int, int], top: int) -> DataFrame:
    """(query, rank, doc_id, score): the ``top`` best documents with a score above zero of every query of the plan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(plan.value.items)
        scores, ids, floor = [np.empty(0, np.int64)] * n, [np.empty((0, 2), np.int64)] * n, [max(1, least.get(q, 1)) for q in range(n)]
        for row, batch in _rows(batches, _INDEX):
            block, own = Block(row, plan.value), batch.column("doc_id")[0].values
            doc = np.column_stack([own.is_null().to_numpy(zero_copy_only=False).astype(np.int64), own.fill_null(0).to_numpy()])
            for q in range(n):
                places, more, _ = block.best(q, floor[q])
                if len(places):
                    score, doc_id = np.concatenate([scores[q], more]), np.concatenate([ids[q], doc[places]])
                    order = np.lexsort((doc_id[:, 1], doc_id[:, 0], -score))[:top]
                    scores[q], ids[q] = score[order], doc_id[order]
                    if len(order) == top:
                        floor[q] = max(floor[q], int(scores[q][-1]))
        queries, all_ids = np.repeat(np.arange(n), [len(x) for x in scores]), np.concatenate([*ids, np.empty((0, 2), np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries, pa.int32()), pa.array(all_ids[:, 1].copy(), mask=all_ids[:, 0] == 1), pa.array(np.concatenate([*scores, np.empty(0, np.int64)]))],
            names=["query", "doc_id", "score"],
        )

    found = index.select("doc_id", *_INDEX).mapInArrow(run, "query int, doc_id long, score long")
    return _best_rows(found, [F.desc("score"), F.asc_nulls_last("doc_id")], top)


def prepare(docs: DataFrame, queries: dict) -> tuple[DataFrame, object] | None:
    """The index of ``docs`` for ``queries`` (item and its terms), as a written table, and the broadcast plan; None without any term."""
    spark = docs.sparkSession
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for own in queries.values() for t in own}))}
    plain = written(blocks(docs, vocabulary), "search-blocks")
    n_docs, n_terms = plain.select(F.explode("length").alias("n")).where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    sizes = F.transform("term", lambda t, i: F.struct(t.alias("term"), (F.element_at("start", i + 2) - F.element_at("start", i + 1)).alias("n")))
    for term, n in plain.select(F.explode(sizes).alias("x")).groupBy("x.term").agg(F.sum("x.n")).collect():
        df[term] = n
    plan = Plan.make({item: [vocabulary[t.encode()] for t in own] for item, own in queries.items()}, df, n_docs, n_terms)
    shared = spark.sparkContext.broadcast(plan)
    return written(with_pairs(plain, shared), "search-index"), shared


def search(docs: DataFrame, items: DataFrame, top: int = TOP, query_terms_at_once: int = QUERY_TERMS) -> DataFrame:
    """One row per item and document among its ``top`` best with a score above zero: item_id, rank (from 1), doc_id, score.

    ``docs`` has doc_id (an integer) and text, ``items`` item_id and text. Rows of one item_id are one item; items without terms, and
    null texts, have no rows. Every row of ``docs`` is a document; a null or termless text never matches and does not count. Equal scores
    go by ascending doc_id, nulls last; equal rows take a rank each. Long texts are read whole; a block may consist of one document.

    Items are dealt to groups by their id, so that a group has ``query_terms_at_once`` terms on average; each group reads all documents.
    """
    asked = written(query_terms(items), "query-terms")
    groups = max(1, math.ceil(asked.count() / query_terms_at_once))
    kind = dict(asked.dtypes)["item_id"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for group in range(groups):
        queries: dict = {}
        for item, term in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group).collect():
            queries.setdefault(item, []).append(term)
        prepared = prepare(docs, queries) if queries else None
        if prepared:
            index, plan = prepared
            found = best_documents(index, plan, thresholds(index, plan, top), top)
            names = docs.sparkSession.createDataFrame(list(enumerate(plan.value.items)), f"query int, item_id {kind}")
            out = out.union(found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    return out
