"""What each filter of a chain removes, in every order of the chain, from decision diagrams.

Spark reduces all documents to counts per part and mask, the set of filters that a document fails. A part's masks become a diagram with
one level per filter: a node's low edge leads to the documents that pass its filter, the high edge to those that fail; equal branches
are one node, and leaves hold counts. From one order of the filters to the next only two neighbouring levels are swapped. In each order
the path of low edges from the root is the chain of filters: what lies behind the high edge of its k-th node is removed in step k.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hanok.llm.shared import as_bytes, map_batches

FILTERS = "ABCDE"
FEWEST_WORDS = 200
MOST_FILTERS = 8  # all orders are written out, 40,320 of eight filters
SALTS = 16  # tasks that share the copies of one text
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_MARKS = b"#$%&*|"

Counts = tuple[int, ...]


class Diagram:
    """Counts per mask of failed filters, one level per filter in ``order``; every path passes all levels.

    ``levels[k]`` lists the nodes of level k as pairs (low, high) of places on the next level; those of the last level are places in
    ``leaves``. ``sums[k]`` has the counts below each node of level k.
    """

    def __init__(self, masks: dict[int, Counts], n: int, width: int):
        self.order = list(range(n))
        self.leaves: list[Counts] = []
        places: list[dict] = [{} for _ in range(n + 1)]

        def place(level: int, key) -> int:
            return places[level].setdefault(key, len(places[level]))

        def node(level: int, items: list[tuple[int, Counts]]) -> int:
            if level == n:
                return place(n, items[0][1] if items else (0,) * width)
            passed, failed = [x for x in items if not x[0] >> level & 1], [x for x in items if x[0] >> level & 1]
            return place(level, (node(level + 1, passed), node(level + 1, failed)))

        node(0, list(masks.items()))
        self.levels = [list(x) for x in places[:n]]
        self.leaves = list(places[n])
        self.sums: list[list[Counts]] = [[] for _ in range(n)]
        for level in range(n - 1, -1, -1):
            self._sum(level)

    def _sum(self, level: int) -> None:
        below = self.sums[level + 1] if level + 1 < len(self.levels) else self.leaves
        self.sums[level] = [tuple(map(sum, zip(below[low], below[high]))) for low, high in self.levels[level]]

    def swap(self, k: int) -> None:
        """Exchange levels k and k + 1. Nodes of level k keep their places and sums, so nothing above or below them changes."""
        places: dict[tuple[int, int], int] = {}
        upper, lower = self.levels[k], self.levels[k + 1]
        for i, (low, high) in enumerate(upper):
            (pass_pass, pass_fail), (fail_pass, fail_fail) = lower[low], lower[high]
            upper[i] = tuple(places.setdefault(x, len(places)) for x in ((pass_pass, fail_pass), (pass_fail, fail_fail)))
        self.levels[k + 1] = list(places)
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]
        self._sum(k + 1)

    def all_pass(self) -> Iterator[tuple[int, Counts, Counts]]:
        """(filter, counts kept, counts removed) of every step of the present order."""
        at = 0
        for level, letter in enumerate(self.order):
            below = self.sums[level + 1] if level + 1 < len(self.levels) else self.leaves
            low, high = self.levels[level][at]
            yield letter, below[low], below[high]
            at = low


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places k whose swaps with k + 1, one after another, lead through all orders of n things, each once."""
    if n < 2:
        return
    down = True
    for k in [*neighbour_swaps(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if k is not None:
            yield k + 1 if down else k
        down = not down


def steps(masks: dict[int, Counts], letters: str, width: int = 3) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, removed of the further counts ..., shapley) for all orders and steps.

    ``masks`` maps a set of failed filters (bit i: the i-th letter) to counts, documents first.
    """
    n = len(letters)
    diagram = Diagram(masks, n, width)
    swaps = list(neighbour_swaps(n))
    found, failing, unique, shapley = [], [0] * n, [0] * n, [0] * n
    for k in [None, *swaps]:
        if k is not None:
            diagram.swap(k)
        order = "".join(letters[i] for i in diagram.order)
        for step, (letter, kept, removed) in enumerate(diagram.all_pass(), 1):
            found.append((order, step, letter, kept[0], removed))
            shapley[letter] += removed[0]
            if step == 1:
                failing[letter] = removed[0]
            if step == n:
                unique[letter] = removed[0]
    return [(order, step, kept, removed[0], failing[i] - removed[0], unique[i], *removed[1:], shapley[i]) for order, step, i, kept, removed in found]


def text_flags(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Whether a text fails A (few words), B (few different words), C (capitals), D (marks)."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    return len(words) < FEWEST_WORDS, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * points, len(text) != len(text.translate(None, _MARKS))


def failure_masks(docs: DataFrame, part: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, mask) for every row of ``docs``: bits 0 to 4 say that it fails A to E.

    A row fails E where its whole text is that of a row with a smaller doc_id; rows without doc_id are smaller than none and fail it
    never. Copies meet by the SHA-256 of their texts, as digests with a doc_id each, and only digests of several rows are joined back, once
    for each of ``SALTS`` shares of the rows.
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(batch.column(2))
        masks = [sum(fails << i for i, fails in enumerate(text_flags(x))) for x in texts]
        digests = [hashlib.sha256(x).digest() for x in texts]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    kind = dict(docs.dtypes)[doc_id]
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    flagged = map_batches(own, f"doc_id {kind}, part string, mask int, digest binary", rows)
    copied = flagged.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copied = copied.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    flagged = flagged.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    is_copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return flagged.join(copied, ["digest", "salt"], "left").select("doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(is_copy, 4)).alias("mask"))


def interactions(masks: DataFrame, letters: str, weights: dict[str, Column]) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, the removed
    sums of ``weights`` (name and column, null counts as zero) and shapley.

    ``masks`` has part and mask (bit i: fails the i-th letter). A part's documents are summed per mask before they meet, so its diagram
    starts from one row per mask, 256 at most. An empty table has no parts.
    """
    n, names = len(letters), list(weights)
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    sums = masks.groupBy("part", "mask").agg(F.count("*").alias("n"), *[F.sum(F.coalesce(c.cast("long"), F.lit(0))).alias(f"w{i}") for i, c in enumerate(weights.values())])
    longs = ["kept", "removed", "redundant", "unique_fails", *names, "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"`{c}` long" for c in longs)

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        counts = zip(*(group.column(c).to_pylist() for c in ["n", *(f"w{i}" for i in range(len(names)))]))
        columns = list(zip(*steps(dict(zip(group.column("mask").to_pylist(), counts)), letters, len(names) + 1)))
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * len(longs)]
        return pa.table([pa.array([part] * len(columns[0])), *map(pa.array, columns, kinds)], names=["part", "filter_order", "step", *longs])

    return sums.groupBy("part").applyInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The five text filters over ``docs``, per value of ``part`` (null: empty), in all 120 orders.

    Failure conditions: A under 200 words (stretches without blanks), B fewer than half of the words differ, C more than 3 capitals A-Z
    in 100 characters, D any of ``#$%&*|``, E the same text as a smaller doc_id. Null texts are empty (A fails, no two words differ too
    little). A document counts as good or toxic where any of its ``labels`` (doc_id, quality, toxic) says 1, without a label as neither.
    Repeated rows count each, and none is a copy of its own doc_id. Whole texts are read whatever their length.
    """
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    masks = failure_masks(docs, F.col(part)).join(known, "doc_id", "left")
    return interactions(masks, FILTERS, {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})
