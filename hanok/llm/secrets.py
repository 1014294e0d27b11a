"""Secrets: fixed patterns, and random strings told from identifiers by character Markov models.

A token is random where a model of random strings is so much likelier than the model of ordinary text. What is ordinary is learned
from the words too short to be tokens, then, in rounds, from the tokens that the models so far take for ordinary; random are strings of
equally likely characters, such as the fixed patterns find, or hexadecimal with dashes. Every distinct token counts once, however often it is copied, and
smoothing goes by shares of what was counted, so that neither copies nor the size of the table move the bounds.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hanok.llm.shared import as_texts, map_batches, replace_column, written

KINDS = ("assign", "access", "hex", "random")  # the order in which spans with the same start are listed
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
MIN_TOKEN = 16  # characters of a token that the models judge
PLACEHOLDER = "<secret>"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
NAMES = ("password", "passwd", "secret", "token", "api")  # no ASSIGN without one of these
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)

# Classes of characters in the models: 0 for the edge of a token, then each character that a token can have.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
_CLASS = np.zeros(256, np.int64)
_CLASS[list(ALPHABET.encode())] = np.arange(1, STATES)

# A random token is this many times likelier under a random model for each 16 characters, at least.
MIN_RATIO = 1e4
HEXADECIMAL = ("0123456789ABCDEF-", "0123456789abcdef-")  # what identifiers of random hexadecimal consist of
DECIMAL = "0123456789-"  # dates and numbers of all kinds, which are not random for being hexadecimal too
UNLIKELY = 1e-6  # of a character that a model does not have
BACKOFF = 34  # pairs that each character counts as seen by chance
SHARE = 0.1  # of an average character's pairs, which each character counts as seen by chance
EVEN = 0.2  # of those, the share that all characters have alike in ordinary text
ROUNDS = 3  # of learning ordinary tokens
_CHUNK = 1 << 20  # bytes of a text whose pairs are counted at a time


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of what the patterns find, and the places of the tokens long enough for the models.

    Access keys and hexadecimal runs lie inside such tokens, since their characters are a token's and they are no shorter.
    """
    found, tokens = [], [t.span() for t in TOKEN.finditer(text)]
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    for a, b in tokens:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= MIN_ACCESS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b) if m.end() - m.start() >= MIN_HEX]
    return sorted(found), tokens


def _free(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens that no span touches; both in order."""
    at, reach, free = 0, 0, []
    for a, b in tokens:
        while at < len(spans) and spans[at][0] < b:
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= a:
            free.append((a, b))
    return free


def _pairs(token: str) -> np.ndarray:
    c = np.zeros(len(token) + 2, np.int64)
    c[1:-1] = _CLASS[np.frombuffer(token.encode(), np.uint8)]
    return c[:-1] * STATES + c[1:]


def _random_part(text: str, span: tuple[int, int, int]) -> str:
    """The random characters of a span: behind the sign of an assignment, else all."""
    if span[1]:
        return text[span[0] : span[2]]
    m = ASSIGN.match(text, span[0], span[2])
    return m[2].replace(".", "")


def _word_pairs(text: bytes, tokens: list[str]) -> np.ndarray:
    """How often each pair of characters stands in ``text`` outside of ``tokens``, its long tokens."""
    counts = np.zeros(STATES * STATES, np.int64)
    for i in range(0, len(text) - 1, _CHUNK):
        c = _CLASS[np.frombuffer(text[i : i + _CHUNK + 1], np.uint8)]
        counts += np.bincount(c[:-1] * STATES + c[1:], minlength=STATES * STATES)
    for t in tokens:
        counts -= np.bincount(_pairs(t)[1:-1], minlength=STATES * STATES)
    return counts


def samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(label, token, pair, n): each distinct unmatched token (0) and random string of a pattern (1) once, and sums of words' pairs (2)."""

    def run(batches):
        words = np.zeros(STATES * STATES, np.int64)
        for batch in batches:
            found = set()
            for x in as_texts(batch.column(0)):
                spans, tokens = base_spans(x)
                words += _word_pairs(x.encode(), [x[a:b] for a, b in tokens])
                found.update((1, _random_part(x, s)) for s in spans)
                found.update((0, x[a:b]) for a, b in _free(tokens, spans))
            label, token = zip(*found) if found else ((), ())
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int64()), pa.array(token, pa.string()), none, none], names=["label", "token", "pair", "n"])
        (pair,) = np.nonzero(words)
        label = pa.array(np.full(len(pair), 2))
        yield pa.RecordBatch.from_arrays([label, pa.nulls(len(pair), pa.string()), pa.array(pair), pa.array(words[pair])], names=["label", "token", "pair", "n"])

    found = docs.select(text).mapInArrow(run, "label long, token string, pair long, n long")
    return found.groupBy("label", "token", "pair").agg(F.sum("n").alias("n"))


def _log_ratios(words: np.ndarray, plain: np.ndarray, random: np.ndarray) -> np.ndarray:
    even = 1 / STATES
    # Words and ordinary tokens weigh the same, whatever their numbers; few tokens weigh less.
    ordinary = words / max(words.sum(), 1) + plain / (plain.sum() + BACKOFF * STATES)
    # Behind a character seen little, an identifier has one that identifiers often have, a random string any.
    often = SHARE * (EVEN * even + (1 - EVEN) * ordinary.sum(axis=0) / ordinary.sum()) if ordinary.any() else SHARE * even
    ordinary = ordinary + often * max(ordinary.sum(), even) / STATES
    ordinary = np.log(ordinary / ordinary.sum(axis=1, keepdims=True))
    random = random + (BACKOFF + SHARE * random.sum() / STATES) * even
    random = np.log(random / random.sum(axis=1, keepdims=True))
    return np.stack([x - ordinary for x in (np.log(even), random, *map(_any_of, HEXADECIMAL), _any_of(DECIMAL))])


def _any_of(characters: str) -> np.ndarray:
    """Log probabilities of a model in which these characters, and the edge, are equally likely behind each other."""
    chance = np.full((STATES, STATES), UNLIKELY)
    chance[:, [0, *_CLASS[list(characters.encode())]]] = 1 / (len(characters) + 1)
    return np.log(chance)


def _token_pairs(tokens: DataFrame, label: int, ratios: np.ndarray | None = None) -> np.ndarray:
    """Pairs summed over the tokens with the label, without those that are random by ``ratios``; at most 68 x 68 sums reach the driver."""

    def run(batches):
        counts = np.zeros(STATES * STATES, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if ratios is None or not is_random(t, ratios):
                    counts += np.bincount(_pairs(t), minlength=STATES * STATES)
        (pair,) = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(counts[pair])], names=["pair", "n"])

    return _matrix(tokens.where(F.col("label") == label).select("token").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n")))


def _matrix(sums: DataFrame) -> np.ndarray:
    counts = np.zeros((STATES, STATES))
    for pair, n in sums.collect():
        counts[pair // STATES, pair % STATES] = n
    return counts


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """By pair of characters, the log ratios to ordinary text of equally likely characters, of the patterns' finds, of random
    hexadecimal with dashes, and of numbers with dashes."""
    found = written(samples(docs, text), "secrets")
    words = _matrix(found.where("label = 2").select("pair", "n"))
    words[0], words[:, 0] = 0, 0  # words end sooner than tokens
    random, plain = _token_pairs(found, 1), np.zeros((STATES, STATES))
    for _ in range(ROUNDS):
        plain = _token_pairs(found, 0, _log_ratios(words, plain, random))
    return _log_ratios(words, plain, random)


def _repeats(token: str) -> float:
    """How much likelier, as a logarithm, the token's characters are if each draws on those before it than if all are equally likely."""
    seen = np.bincount(_CLASS[np.frombuffer(token.encode(), np.uint8)])
    seen = seen[seen > 0]
    own = np.log(np.concatenate([np.arange(1, n + 1) for n in seen])).sum()
    return float(own - np.log1p(np.arange(len(token)) / STATES).sum())


def is_random(token: str, ratios: np.ndarray) -> bool:
    """Whether one of the random models is likelier enough than ordinary text, and the hexadecimal ones than numbers; a run of few
    characters, as of ``=``, is not random."""
    enough = np.log(MIN_RATIO) * len(token) / MIN_TOKEN
    even, random, *hexadecimal, decimal = ratios.reshape(len(ratios), -1)[:, _pairs(token)].sum(axis=1).tolist()
    return max(even, random, *(h - max(decimal, 0) for h in hexadecimal)) >= enough > _repeats(token)


def all_spans(text: str, ratios: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans and random tokens beside them, as (start, kind, end) in order."""
    spans, tokens = base_spans(text)
    if not tokens:
        return spans
    return sorted(spans + [(a, 3, b) for a, b in _free(tokens, spans) if is_random(text[a:b], ratios)])


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. A null text is an empty one.
    Repeated rows stay repeated, rows without doc_id are scanned like others, and texts of any length as a whole.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ratios = docs.sparkSession.sparkContext.broadcast(train(docs))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [all_spans(x, ratios.value) for x in as_texts(batch.column(1))]
        counts = [pa.array([sum(k == kind for _, k, _ in s) for s in found], pa.int64()) for kind in range(4)]
        base = [hashlib.sha256(listed([s for s in f if s[1] < 3]).encode()).hexdigest() for f in found]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *counts[:3], pa.array(base, pa.string()), pa.array([listed(f) for f in found], pa.string()), counts[3]],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
        )

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(docs, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long", rows)


def masked(text: str, spans: list[tuple[int, int, int]], placeholder: str = PLACEHOLDER) -> str:
    """``text`` with each stretch of touching or overlapping spans replaced once."""
    out, end = [], 0
    for a, _, b in spans:
        if a >= end:
            out += [text[end:a], placeholder]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, placeholder: str = PLACEHOLDER) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced and ``n_chars``, where there is one, brought up to date."""
    ratios = docs.sparkSession.sparkContext.broadcast(train(docs))
    at = docs.columns.index("text")
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        spans = [all_spans(x, ratios.value) if x else [] for x in texts]
        if not any(spans):
            return batch
        done = [masked(x, s, placeholder) if s else x for x, s in zip(texts, spans)]
        if length is not None:
            known = batch.column(length).to_pylist()
            sizes = pa.array([len(d) if s else n for d, s, n in zip(done, spans, known)], pa.int64())
            batch = replace_column(batch, "n_chars", sizes)
        return replace_column(batch, "text", pa.array(done, pa.string()))

    return map_batches(docs, docs.schema, rows)
