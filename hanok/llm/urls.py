"""URL verdicts: listed rules first, else words of host and path under naive Bayes.

Names that are written together are cut by Viterbi into the likeliest words under a unigram model. The model counts the words of the
pages, of the urls' paths, and the parts of host names that hyphens divide. Multinomial naive Bayes then weighs the words of host and path.
It knows three kinds of urls: those to block by name, of which the first examples are hosts with a word of the seed list and the
further ones, round by round, urls that the model itself blocks by name; those that a rule blocks; and all others. Of an example that
a rule decides, the rule's own words are left out, so that the rule is not learned as if it were a word. Each host and kind of path counts
once, however many pages it has. All counting is joined and summed by Spark over all pages; what tasks get of the model has a fixed
size, since its words share ``BUCKETS`` slots.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from hanok.llm.shared import as_texts, map_batches, written

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
# Words by which a host is a labelled example of what to block; they also are in the dictionary.
BLOCK_SEEDS = (
    "adult porn sex xxx nude escort casino bet bets betting poker gambling jackpot pills pharma viagra cialis "
    "spam malware phishing warez crack torrent ads tracker clickbait payday"
).split()
SEED_COUNT = 50  # a seed word counts as if seen so often
MAX_WORD = 63  # letters of a word in a host: as long as the DNS lets a whole label be
BUCKETS = 1 << 16
NUMBER = "#"
SMOOTHING = 20.0  # how many words of average text each kind of url is taken to have more
PRIOR = 0.1  # odds of a url to be blocked before its words are seen
ROUNDS = 4
_WORD = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands behind the first ``://``: up to ``/``, ``?``, ``#`` or the end in lower case (A-Z), then up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits host (or a domain above it) and the start of the path, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def labels_of(host: str) -> list[str]:
    """Runs of letters in a host, without its last label, port and user."""
    return [w for label in host.rsplit("@", 1)[-1].split(":")[0].split(".")[:-1] for w in _WORD.findall(label)]


def _counted_words(pages: DataFrame) -> DataFrame:
    """(word, n): words of all pages' texts, tags and attributes included, of their paths, and of the hyphened parts of their hosts."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, int] = {}
        for html, host, path in zip(*(as_texts(batch.column(i)) for i in range(3))):
            parts = [w for label in host.rsplit("@", 1)[-1].split(":")[0].split(".")[:-1] if "-" in label for w in _WORD.findall(label)]
            for w in [*re.findall(r"[a-z]+|[^\x00-\x7f]+", f"{html} {path}".lower()), *parts]:
                counts[w] = counts.get(w, 0) + 1
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return map_batches(pages.select("html", "host", "path"), "word string, n long", rows).groupBy("word").agg(F.sum("n").alias("n"))


def segment(label: str, costs: dict[str, float], unknown: float) -> list[str]:
    """The cheapest cut of ``label`` into words; a stretch that is no word costs ``unknown`` for each character and once more."""
    best, back = [0.0], [0]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            word = label[start:end]
            options.append((best[start] + costs.get(word, unknown * (1 + len(word))), start))
        cost, start = min(options)
        best.append(cost)
        back.append(start)
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented_hosts(pages: DataFrame) -> DataFrame:
    """(host, words) for every distinct host of ``pages`` (host, path, html).

    A label's possible words are joined to the dictionary by word, so the dictionary is never held whole. Each distinct label is cut
    once, whichever hosts have it.
    """
    hosts = pages.select("host").distinct()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        host, label, place = [], [], []
        for h in batch.column(0).to_pylist():
            for i, x in enumerate(labels_of(h)):
                host.append(h)
                label.append(x)
                place.append(i)
        return pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(label, pa.string()), pa.array(place, pa.int32())], names=["host", "label", "place"])

    parts = written(map_batches(hosts, "host string, label string, place int", cut), "host-labels")
    # A label may be long, its stretches many: they carry its digest only.
    labels = parts.select("label").distinct().withColumn("id", F.md5("label"))
    seeds = pages.sparkSession.createDataFrame([(w, SEED_COUNT) for w in BLOCK_SEEDS], "word string, n long")
    words = written(_counted_words(pages).union(seeds).groupBy("word").agg(F.sum("n").alias("n")).where(F.char_length("word") <= MAX_WORD), "words")
    total = words.agg(F.sum("n") + F.count("*")).first()[0] or 1
    size = F.char_length("label")
    pieces = labels.select("label", "id", F.explode(F.sequence(F.lit(1), size)).alias("start"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), size - F.col("start") + 1))
    pieces = pieces.select("id", F.explode(F.transform(lengths, lambda k: F.substring(F.col("label"), F.col("start"), k))).alias("word")).distinct()
    known = pieces.join(words, "word").groupBy("id").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def viterbi(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = []
        for label, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            costs = {k["word"]: math.log(total) - math.log(k["n"] + 1) for k in known or ()}
            done.append(segment(label, costs, math.log(total)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.list_(pa.string()))], names=["label", "words"])

    cuts = map_batches(labels.join(known, "id", "left").select("label", "known"), "label string, words array<string>", viterbi)
    placed = parts.join(cuts, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("all"))
    return written(placed.select("host", F.flatten(F.transform("all", lambda x: x["words"])).alias("words")), "host-words")


def bucket(word: str) -> int:
    return xxhash.xxh64_intdigest(word) % BUCKETS


def path_words(path: str) -> list[str]:
    """Words of a path, numbers alike."""
    return [NUMBER if w.isdecimal() else w for w in _WORD.findall(path.lower())]


def _tokens(words: list[str] | None, path: str) -> list[int]:
    """Slots of the words of host and path, which are told apart."""
    return [bucket("h " + w) for w in words or ()] + [bucket("p " + w) for w in path_words(path)]


ALLOWED, NAMED, RULED, OPEN = range(4)  # kinds of examples; the open ones count as allowed until the model blocks them


@dataclass
class Model:
    """Per slot log P(slot | named) - log P(slot | allowed) and the same for urls that rules block; which of the two there are."""

    weights: np.ndarray
    known: tuple[bool, bool]

    def score(self, slots: list[int]) -> float:
        """Log odds of block against allow."""
        found = [float(w[slots].sum()) + math.log(PRIOR) for w, some in zip(self.weights, self.known) if some]
        return float(np.logaddexp.reduce(found)) if found else math.log(PRIOR)


def fit(counts: np.ndarray) -> Model:
    """The model of ``counts``, three rows of slot counts: allowed, named, ruled."""
    sums = counts.sum(axis=1)
    usual = counts.sum(axis=0) / max(1, sums.sum())
    chance = np.log((counts + SMOOTHING * usual + 1e-300) / (sums[:, None] + SMOOTHING))
    return Model(np.where(usual > 0, chance[1:] - chance[0], 0.0), (bool(sums[1]), bool(sums[2])))


def examples(urls: DataFrame) -> DataFrame:
    """(slots, kind) of every different host, kind of path and rule; ``urls`` has words, path, rule and says, the rule's verdict."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots, kinds, seeds = [], [], set(BLOCK_SEEDS)
        for words, path, rule, says in zip(*(c.to_pylist() for c in batch.columns)):
            own = set(_tokens([w for x in (rule or "").split("/")[0].split(".") for w in _WORD.findall(x)], (rule or "").partition("/")[2]))
            slots.append(sorted(t for t in _tokens(words or [], path or "") if t not in own))
            kinds.append(NAMED if not seeds.isdisjoint(words or ()) else OPEN if says is None else RULED if says == "block" else ALLOWED)
        return pa.RecordBatch.from_arrays([pa.array(slots, pa.list_(pa.int32())), pa.array(kinds, pa.int32())], names=["slots", "kind"])

    return map_batches(urls.select("words", "path", "rule", "says"), "slots array<int>, kind int", rows).distinct()


def train(examples: DataFrame) -> Model:
    """Fit, then take the open examples that the model blocks by name for named ones and fit again, ``ROUNDS`` times.

    Slots are counted by Spark; at most 3 x ``BUCKETS`` sums come to the driver in a round.
    """
    model = None
    for _ in range(ROUNDS + 1):
        shared = examples.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            counts, model = np.zeros((3, BUCKETS), np.int64), shared.value
            for batch in batches:
                for slots, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if kind == OPEN:
                        kind = NAMED if model and model.known[0] and float(model.weights[0][slots].sum()) + math.log(PRIOR) > 0 else ALLOWED
                    np.add.at(counts[kind], slots, 1)
            kind, slot = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(slot, pa.int32()), pa.array(counts[kind, slot], pa.int64())], names=["kind", "slot", "n"])

        counts = np.zeros((3, BUCKETS))
        for kind, slot, n in examples.mapInArrow(run, "kind int, slot int, n long").groupBy("kind", "slot").agg(F.sum("n")).collect():
            counts[kind, slot] = n
        model = fit(counts)
    return model


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, words (of the host) and score (above 0: block; at 0: allow).

    ``pages`` has page_id, url, html. A url that is null or without ``://`` has empty host and path, no rule and no words, and is
    allowed. A user name, a port and the last label of a host are no words. Hosts and paths are read whole, whatever their length.
    Repeated rows stay repeated and are learned from once. Without any example to block all urls have the same score and are allowed.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    urls = pages.drop("html").join(segmented_hosts(pages), "host", "left").withColumns({"rule": rule, "says": says})
    model = train(written(examples(urls), "url-examples"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.score(_tokens(w or [], p)) for w, p in zip(batch.column(5).to_pylist(), as_texts(batch.column(2)))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=["page_id", "host", "path", "rule", "says", "words", "score"])

    kind = dict(pages.dtypes)["page_id"]
    names = "page_id", "host", "path", "rule", "says", "words"
    scored = map_batches(urls.select(*names), f"page_id {kind}, host string, path string, rule string, says string, words array<string>, score double", rows)
    verdict = F.coalesce("says", F.when((F.col("score") > 0) & (F.col("host") != ""), "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.array_join("words", " ").alias("words"), F.round("score", 6).alias("score"))
