"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's score sees its own features and those of the lines before and behind it; the chain ties
the labels of lines that follow each other. Forward and backward sums give each line's probability of being good, and their
mean by line length is the document's quality, put on the scale of the labels by a logistic curve.

Labels belong to documents, so in fitting each line carries its document's label.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hanok.llm.shared import as_bytes, map_batches

MAX_DOCS = 4000  # labelled documents that the model is fitted to
MAX_LINES = 100  # lines in a row that each of them gives to the fit, so 400,000 lines of 48 numbers at most; scores see all lines
THRESHOLD = 0.7
SLICE = 1 << 21  # bytes of text whose features are counted at a time

# Kinds of bytes: lower case, upper case, digits, blanks, punctuation of prose, exclamation marks, bars, other signs, beyond ASCII.
LOWER, UPPER, DIGIT, BLANK, PROSE, SHOUT, BAR, SIGN, WIDE, BREAK = range(10)


def _kinds() -> np.ndarray:
    kinds = np.full(256, SIGN, np.uint8)
    kinds[:33] = BLANK
    for kind, chars in ((LOWER, bytes(range(97, 123))), (UPPER, bytes(range(65, 91))), (DIGIT, b"0123456789"), (PROSE, b".,;:?'\"()-"), (SHOUT, b"!"), (BAR, b"|")):
        kinds[list(chars)] = kind
    kinds[128:] = WIDE
    kinds[10] = BREAK
    return kinds


FEATURES = 15


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of ``texts``, bytes of each line (one at least), and lines of each text."""
    kinds, parts, weights, lines = _kinds(), [], [], []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE):
            size += len(texts[end]) + 1
            end += 1
        split = [x.split(b"\n") for x in texts[at:end]]
        data = np.frombuffer(b"\n".join(texts[at:end]) + b"\n", np.uint8)
        breaks = data == 10
        line = np.cumsum(breaks, dtype=np.int32) - breaks
        n = int(line[-1]) + 1
        count = np.zeros((n, 10))
        for a in range(0, len(data), SLICE):
            own = line[a : a + SLICE].astype(np.int64)
            first = own[0]
            part = np.bincount((own - first) * 10 + kinds[data[a : a + SLICE]], minlength=(own[-1] - first + 1) * 10)
            count[first : own[-1] + 1] += part.reshape(-1, 10)
        words, different, again, ends = [], [], [], []
        for doc in split:
            seen = Counter(doc)
            for x in doc:
                w = x.split()
                words.append(len(w))
                different.append(len(set(w)))
                again.append(seen[x] > 1)
                ends.append(x[-1:] in (b".", b"?", b'"', b")"))
        words, different = np.array(words, float), np.array(different, float)
        chars, some = count[:, :BREAK].sum(axis=1), np.maximum(words, 1)
        letters = count[:, LOWER] + count[:, UPPER] + count[:, WIDE]
        parts.append(
            np.column_stack([
                np.log1p(chars), np.log1p(words), letters / some / 10, different / some, np.array(again, float), np.array(ends, float),
                count[:, UPPER] / np.maximum(letters, 1), count[:, DIGIT] / np.maximum(chars, 1) * 10, count[:, BLANK] / np.maximum(chars, 1),
                count[:, PROSE] / some, count[:, SHOUT] / some, count[:, BAR] / some, count[:, SIGN] / some, count[:, WIDE] / np.maximum(chars, 1),
                (chars == 0).astype(float),
            ])
        )
        weights.append(np.maximum(chars, 1))
        lines += [len(doc) for doc in split]
        at = end
    if not parts:
        return np.empty((0, FEATURES)), np.empty(0), np.empty(0, np.int64)
    return np.concatenate(parts), np.concatenate(weights), np.array(lines, np.int64)


@dataclass
class Crf:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # own, previous and next line's features, first line, last line, constant
    change: np.ndarray  # 2 x 2: score of a label after another
    curve: tuple[float, float]  # of the logistic curve over the quality's log odds
    share: float | None = None  # the score of all texts where there was nothing to learn

    def inputs(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Each line's features next to those of its neighbours in the same text."""
        x = (features - self.mean) / self.scale
        start = np.cumsum(lines) - lines
        first, last = np.zeros(len(x)), np.zeros(len(x))
        first[start], last[start + lines - 1] = 1, 1
        before, behind = np.roll(x, 1, axis=0) * (1 - first)[:, None], np.roll(x, -1, axis=0) * (1 - last)[:, None]
        return np.column_stack([x, before, behind, first, last, np.ones(len(x))])

    def quality(self, features: np.ndarray, sizes: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Mean of the lines' marginals by length, per text."""
        good = marginals(self.inputs(features, lines) @ self.weights, lines, self.change)[0]
        start = np.cumsum(lines) - lines
        return np.add.reduceat(good * sizes, start) / np.add.reduceat(sizes, start)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.share is not None or not texts:
            return np.full(len(texts), self.share if self.share is not None else 0.0)
        return _curve(self.quality(*line_features(texts)), *self.curve)


def _curve(quality: np.ndarray, slope: float, shift: float) -> np.ndarray:
    q = np.clip(quality, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-(slope * np.log(q / (1 - q)) + shift)))


def marginals(scores: np.ndarray, lines: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for each line, and the expected number of each pair of labels.

    ``scores`` are the lines' scores for good (bad has 0), text after text. All texts take a step together, longest first.
    """
    by = np.argsort(-lines, kind="stable")
    start, sizes = (np.cumsum(lines) - lines)[by], lines[by]
    depth = int(sizes[0])
    active = len(sizes) - np.searchsorted(np.sort(lines), np.arange(depth), side="right")
    own = np.zeros((len(scores), 2))
    own[:, 1] = scores
    forward, backward = np.zeros_like(own), np.zeros_like(own)
    rows = start
    forward[rows] = own[rows]
    for t in range(1, depth):
        rows = start[: active[t]] + t
        step = forward[rows - 1][:, :, None] + change
        forward[rows] = np.logaddexp(step[:, 0], step[:, 1]) + own[rows]
    pairs = np.zeros((2, 2))
    for t in range(depth - 2, -1, -1):
        rows = start[: active[t + 1]] + t
        step = (own[rows + 1] + backward[rows + 1])[:, None, :] + change
        backward[rows] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        joint = forward[rows][:, :, None] + step
        joint -= np.logaddexp(forward[rows, 0] + backward[rows, 0], forward[rows, 1] + backward[rows, 1])[:, None, None]
        pairs += np.exp(joint).sum(axis=0)
    both = forward + backward
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500))), pairs


def fit(features: np.ndarray, sizes: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> Crf:
    """Maximum likelihood by Adam's steps; ``labels`` has one 0 or 1 per text."""
    mean, scale = features.mean(axis=0), features.std(axis=0)
    crf = Crf(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(3 * FEATURES + 3), np.zeros((2, 2)), (1.0, 0.0))
    x, y = crf.inputs(features, lines), np.repeat(labels, lines).astype(float)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (lines[labels == label] - 1).sum()
    sums, first, second = x.T @ y, 0.0, 0.0
    for n in range(1, rounds + 1):
        good, pairs = marginals(x @ crf.weights, lines, crf.change)
        slope = np.concatenate([x.T @ good - sums, (pairs - seen).ravel()]) / len(x)
        slope += penalty * np.concatenate([crf.weights, crf.change.ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        step = 0.1 * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-8)
        crf.weights = crf.weights - step[: len(crf.weights)]
        crf.change = crf.change - step[len(crf.weights) :].reshape(2, 2)
    q = np.clip(crf.quality(features, sizes, lines), 1e-6, 1 - 1e-6)
    odds, a, b = np.log(q / (1 - q)), 1.0, 0.0
    for _ in range(300):  # the logistic curve, by plain gradient steps on scaled odds
        gap = 1 / (1 + np.exp(-(a * odds + b))) - labels
        a, b = max(0.05, a - 0.05 * float((gap * odds).mean())), b - 0.5 * float(gap.mean())
    crf.curve = (a, b)
    return crf


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Crf:
    """Fit to at most ``max_docs`` labelled documents, taken by the hash of doc_id; a document's label is that of most of its rows.

    Of several rows of one doc_id the least text is taken, and of a document with more than ``MAX_LINES`` lines as many in a row, from a
    place that hangs on the text. So what comes to the driver has a set size, whatever the texts.

    Without documents of both labels there is nothing to tell apart: every text then scores the share of label 1, and 1 where
    no label is known.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(batch.column(1))
        features, sizes, lines = line_features(texts)
        starts = np.cumsum(lines) - lines + [zlib.crc32(x) % max(1, n - MAX_LINES + 1) for x, n in zip(texts, lines.tolist())]
        taken = [slice(a, a + n) for a, n in zip(starts.astype(int), np.minimum(lines, MAX_LINES))]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([features[x].astype(np.float32).tobytes() for x in taken], pa.binary()),
                pa.array([sizes[x].tobytes() for x in taken], pa.binary()),
            ],
            names=["label", "features", "sizes"],
        )

    found = map_batches(rows, "label int, features binary, sizes binary", run).collect()
    found.sort(key=lambda r: (bytes(r[1]), r[0]))  # the same sums whatever the order of tasks
    labels_ = np.array([r[0] for r in found], np.int64)
    if len(set(labels_.tolist())) < 2:
        return Crf(*[np.empty(0)] * 4, (1.0, 0.0), (float(labels_.sum()) + 1) / (len(labels_) + 1))
    features = [np.frombuffer(r[1], np.float32).reshape(-1, FEATURES).astype(float) for r in found]
    return fit(np.concatenate(features), np.concatenate([np.frombuffer(r[2]) for r in found]), np.array([len(f) for f in features], np.int64), labels_)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. A null or empty text is one empty line.

    Repeated rows stay repeated, and rows of one doc_id are scored each by its own text; a null doc_id is not held out. Every line of a
    text counts, however long it is. A score of just ``threshold`` is accepted.
    """
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_docs))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.scores(as_bytes(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    found = map_batches(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, score double", rows)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_docs))
    at = docs.columns.index("text")

    def good(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(shared.value.scores(as_bytes(batch.column(at))) >= threshold))

    return map_batches(docs, docs.schema, good)
