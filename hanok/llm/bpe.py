"""BPE as a streaming transducer with bounded lookahead, and its inverse.

Text comes in pieces; ids leave as soon as nothing that follows can change them. How far ahead that is follows from the merge
list alone. Take two texts with a common start. Merges run in the order of the list, so what lies behind the common start can
reach back into it only through a chain of merges, each later in the list than the one before, each taking as its left part one
token of the common start, and each with a right part that begins with the left part before. The longest such chain, in symbols,
is the lookahead: tokens that end so far before the end of what is known stay as they are.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from hanok.llm.shared import as_texts

PIECE = 1 << 16  # characters fed at a time
NEVER = 1 << 60  # rank of a pair that does not merge
SHORT = 100  # characters of a word that is merged at once
CACHE = 150_000  # words remembered in each of two generations
# Where the tokenizers library's Unicode tables are older than those of this Python: letters and numbers that it takes
# for signs, marks that it leaves in place when it composes; and capitals that it lowers and this Python does not.
LATER_LETTERS = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a "
    "11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 "
    "1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff "
    "2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
LATER_NUMBERS = "11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6"
LATER_MARKS = (
    "7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac 10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b "
    "1145e 11839-1183a 11930 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42 11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae "
    "1e2ec-1e2ef 1e4ec-1e4ef"
)
LATER_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next free one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Model:
    """A vocabulary with its ordered merges, read from a tokenizer file's JSON."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (
            model["type"] != "BPE"
            or steps != ["NFC", "Replace", "Lowercase"]
            or [s["type"] for s in splits] != ["Split", "ByteLevel"]
            or spec["normalizer"]["normalizers"][1] != {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
            or (splits[0]["behavior"], splits[0]["invert"]) != ("Removed", True)
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        ):
            raise ValueError("this tokenizer file asks for steps that are not built")
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.separator = " " if spec["decoder"] is None else ""
        self.pattern = splits[0]["pattern"]["Regex"]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.bytes = byte_alphabet()
        made: dict[str, int] = {}
        for i, (a, b) in enumerate(merges):
            if a + b in made or any(len(x.removesuffix(self.end)) > 1 and made.get(x, i) >= i for x in (a, b)):
                raise ValueError("the merges are not in an order in which every part is made before it is used")
            made[a + b] = i
        self.lookahead = lookahead(merges, self.end)
        self.window = 2 * self.lookahead + max(map(len, self.vocab))


def lookahead(merges: list[tuple[str, str]], end: str) -> int:
    """Symbols that decide about a token from behind it: the longest chain of the module's text."""
    best: dict[str, int] = {}  # by left part: the longest chain that ends with it so far
    longest = 1
    for a, b in merges:
        right = b.removesuffix(end) if end else b
        chain = len(a) + max((best.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        if chain > best.get(a, 0):
            best[a] = chain
            longest = max(longest, chain)
    return longest


def merge(model: Model, symbols: list[str]) -> list[str]:
    """All merges over a known run of symbols, in the order of the list and from left to right; ``symbols`` is used up."""
    rank, tokens = model.rank.get, symbols
    ranks = list(map(rank, zip(tokens, tokens[1:]), repeat(NEVER)))
    while ranks and (least := min(ranks)) != NEVER:
        i = ranks.index(least)
        del ranks[i]
        joined = tokens[i] = tokens[i] + tokens.pop(i + 1)
        if i:
            ranks[i - 1] = rank((tokens[i - 1], joined), NEVER)
        if i < len(ranks):
            ranks[i] = rank((joined, tokens[i + 1]), NEVER)
    return tokens


class WordTransducer:
    """Tokens of one word whose symbols come bit by bit. Between calls it holds twice the lookahead plus one token at most."""

    def __init__(self, model: Model):
        self.model = model
        self.held: list[str] = []

    def feed(self, symbols: list[str]) -> list[str]:
        window, out, at = self.model.window, [], 0
        while at < len(symbols):
            take = symbols[at : at + window + 1 - len(self.held)]
            at += len(take)
            self.held += take
            if len(self.held) > window:
                # the last symbol may be the word's last, which is another symbol: it stays out until one follows
                known, sure, end = self.held[:-1], len(self.held) - 1 - self.model.lookahead, 0
                for token in merge(self.model, known):
                    if end + len(token) > sure:
                        break
                    end += len(token)
                    out.append(token)
                self.held = self.held[end:]
        return out

    def finish(self) -> list[str]:
        """The rest, now that the word has ended."""
        tokens = self.held
        if tokens:
            tokens = merge(self.model, [*tokens[:-1], tokens[-1] + self.model.end])
        self.held = []
        return tokens


_STARTS = regex.compile(r"[^\p{M}\u1160-\u11ff\ud7b0-\ud7ff\U00016d40-\U00016d7f]", regex.REVERSE)


def open_end(text: str) -> int:
    """Where the part of ``text`` begins whose composed form may depend on what follows: at its last character that starts a new
    one. Marks, vowels and ends of Hangul syllables and the like join with what stands before them."""
    last = _STARTS.search(text)
    return last.start() if last else 0


def _class(ranges: str) -> str:
    """Ranges of code points as the inside of a character class."""
    return "".join("-".join(f"\\U{int(end, 16):08x}" for end in part.split("-")) for part in ranges.split())


_FAR = re.compile("[\u0558-\u1fff\u2070-\u20a0\ua000-\U0010ffff]")  # all that follows is there; few texts are
_LATER = re.compile(f"[{_class(LATER_MARKS)}{''.join(map(chr, LATER_CAPITALS))}]")
_LATER_SIGNS = re.compile(f"[{_class(LATER_LETTERS + ' ' + LATER_NUMBERS)}]")
_MARKS = re.compile(f"([{_class(LATER_MARKS)}])")
LETTER = rf"[\p{{L}}--[{_class(LATER_LETTERS)}]]"
DIGIT = rf"[\p{{N}}--[{_class(LATER_NUMBERS)}]]"


def normal(text: str) -> str:
    """Composed and in lower case, character by character. White space only separates words, so its kind does not matter."""
    if text.isascii():
        return text.lower()
    if not (_FAR.search(text) and _LATER.search(text)):
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
    text = "".join(unicodedata.normalize("NFC", part) for part in _MARKS.split(text))
    return text.replace("\u03a3", "\u03c3").lower().translate(LATER_CAPITALS)


class Encoder:
    """Ids of a text that comes in pieces; ``feed`` returns those that are certain, ``finish`` the rest.

    Held between calls: the end of the text whose composed form is open, the characters behind the last white space, and of a run
    of letters or signs longer than a piece only the symbols within the lookahead. Words seen lately are remembered, in two
    generations of ``CACHE``.
    """

    def __init__(self, model: Model, piece: int = PIECE):
        self.model, self.piece, self.limit = model, piece, max(piece, 16)
        pattern = model.pattern.replace(r"\s", r"\p{White_Space}")
        self.usual = regex.compile(pattern, regex.V0)  # the same for texts without later letters and numbers, and faster
        self.split = self.exact = regex.compile(pattern.replace(r"\p{L}", LETTER).replace(r"\p{N}", DIGIT), regex.V1)
        self.last_space = regex.compile(r"\p{White_Space}", regex.REVERSE)
        self.space = regex.compile(r"\p{White_Space}+")
        self.odd = re.compile("[\x1c-\x1f]")  # white space for str.split alone
        self.runs = [regex.compile(x, regex.V1) for x in (f"{LETTER}*", rf"[^\p{{White_Space}}{LETTER}{DIGIT}]*")]
        self.special = regex.compile("|".join(map(regex.escape, sorted(model.special, key=len, reverse=True))) or r"(?!)")
        self.special_hold = max(map(len, model.special), default=1) - 1
        self.special_first = {x[0] for x in model.special}
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.raw = self.open = ""
        self.long: tuple[WordTransducer, regex.Pattern] | None = None

    def feed(self, text: str) -> list[int]:
        raw, ids = self.raw + text, []
        if any(x in raw for x in self.model.special):
            while found := self.special.search(raw):
                ids += self._plain(raw[: found.start()], True)
                ids.append(self.model.special[found[0]])
                raw = raw[found.end() :]
        cut = open_end(raw)
        for first in self.special_first:  # a special token may have begun
            at = raw.find(first, max(0, len(raw) - self.special_hold))
            cut = min(cut, at) if at >= 0 else cut
        self.raw = raw[cut:]
        return ids + self._plain(raw[:cut], False)

    def finish(self) -> list[int]:
        ids = self._plain(self.raw, True)
        self.raw = ""
        return ids

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a whole text, piece by piece."""
        for at in range(0, len(text), self.piece):
            yield self.feed(text[at : at + self.piece])
        yield self.finish()

    def _plain(self, text: str, last: bool) -> list[int]:
        """Text without special tokens. Where it is cut, its words are the same on both sides: at white space, or where three more
        characters are known, which is as far as a contraction looks."""
        text, ids = self.open + normal(text), []
        self.open = ""
        self.split = self.exact if not text.isascii() and _FAR.search(text) and _LATER_SIGNS.search(text) else self.usual
        if self.long:
            transducer, run = self.long
            end = run.match(text).end()
            ids += self._ids(transducer.feed(self._symbols(text[:end])))
            text = text[end:]
            if not text and not last:
                return ids
            ids += self._ids(transducer.finish())
            self.long = None
        if not last:
            space = self.last_space.search(text)
            cut = space.end() if space else 0
            self.open, text = text[cut:], text[:cut]
        known = self.young.get
        for chunk in text.split() if self.odd.search(text) is None else self.space.split(text):
            ids += known(chunk) or self._chunk(chunk)
        if len(self.open) > self.limit:
            done = 0
            for found in self.split.finditer(self.open):
                if found.end() > len(self.open) - 3:
                    break
                ids += self._word(found[0])
                done = found.end()
            self.open = self.open[done:]
            if len(self.open) > self.limit:
                run = self.runs[0] if self.runs[0].match(self.open).end() else self.runs[1]
                self.long, text, self.open = (WordTransducer(self.model), run), self.open, ""
                ids += self._plain(text, False)
        return ids

    def _chunk(self, chunk: str) -> list[int]:
        """Ids of what stands between white space, one word or several."""
        if chunk.isalpha():
            return self._word(chunk)
        words = self.split.findall(chunk)
        if len(words) == 1:
            return self._word(chunk)
        ids = self.old.get(chunk) or [i for word in words for i in self._word(word)]
        self._remember(chunk, ids)
        return ids

    def _word(self, word: str) -> list[int]:
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None and len(word) <= SHORT:  # the transducer would hold it to its end
                symbols = list(word) if word.isascii() and word.isprintable() else self._symbols(word)
                symbols[-1] += self.model.end
                ids = list(map(self.model.vocab.__getitem__, merge(self.model, symbols)))
            elif ids is None:
                transducer = WordTransducer(self.model)
                ids = self._ids([*transducer.feed(self._symbols(word)), *transducer.finish()])
            self._remember(word, ids)
        return ids

    def _remember(self, chunk: str, ids: list[int]) -> None:
        if ids and len(chunk) <= 64:
            if len(self.young) >= CACHE:
                self.young, self.old = {}, self.young
            self.young[chunk] = ids

    def _symbols(self, text: str) -> list[str]:
        return list(map(self.model.bytes.__getitem__, text.encode()))

    def _ids(self, tokens: Iterable[str]) -> list[int]:
        return [self.model.vocab[t] for t in tokens]


class Decoder:
    """Ids to text, as they come: the bytes of the tokens go into a state machine that gives each character once it is complete and
    holds up to three bytes of one that is not.

    ``spelled`` follows a tokenizer file without a decoder: the vocabulary's spelling of each token, with blanks between. Otherwise
    tokens are the text's own bytes and the end of a word is a blank.
    """

    def __init__(self, model: Model, spelled: bool):
        byte = {c: bytes([b]) for b, c in enumerate(model.bytes)}
        self.bytes: dict[int, bytes] = {}
        for i, name in model.names.items():
            core = name.removesuffix(model.end) if model.end else name
            own = name in model.special
            self.bytes[i] = name.encode() if spelled or own else b"".join(byte[c] for c in core) + (b" " if core != name else b"")
        self.separator = model.separator.encode() if spelled else b""
        self.reset()

    def reset(self) -> None:
        self.begun = False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        out = self.separator.join(map(self.bytes.__getitem__, ids))
        out, self.begun = (self.separator + out if self.begun else out), True
        return self.machine.decode(out)

    def finish(self) -> str:
        """What is left where the ids end inside a character."""
        return self.machine.decode(b"", True)


def tokenize(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ``input_ids``.

    ``tokenizer`` is the JSON of a tokenizer file; it goes to the tasks with the job (its size is that of one vocabulary). Null
    texts are empty ones: no tokens. Repeated rows stay repeated, rows without doc_id are encoded like others.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        encoder, decoder = Encoder(model), Decoder(model, spelled=True)
        decimal = {i: str(i) for i in model.names}
        for batch in batches:
            counts, digests, every = [], ([], []), []
            for x in as_texts(batch.column(1)):
                n, hashes, kept = 0, [hashlib.sha256() for _ in digests], []
                decoder.reset()
                for ids in encoder.encode(x):
                    if ids:
                        hashes[0].update((" " * (n > 0) + " ".join(map(decimal.__getitem__, ids))).encode())
                        hashes[1].update(decoder.feed(ids).encode())
                        n += len(ids)
                        if keep_ids:
                            kept += ids
                hashes[1].update(decoder.finish().encode())
                counts.append(n)
                for out, h in zip(digests, hashes):
                    out.append(h.hexdigest())
                every.append(kept)
            columns = [batch.column(0), pa.array(counts, pa.int64()), *(pa.array(d, pa.string()) for d in digests)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns, names = [*columns, pa.array(every, pa.list_(pa.int32()))], [*names, "input_ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema + ", input_ids array<int>" * keep_ids)
