"""Operator 1: byte-pair encoding and decoding with a published vocabulary.

A word's symbols are a doubly linked list; every adjacent pair with a merge waits in a priority queue by (rank, place). The best
entry is taken; an entry whose pair has changed since is stale and skipped; a merge links the neighbours anew and queues the two new
pairs. Decoding joins the vocabulary strings of the ids, with one space between them as the file names no decoder.

Documents are independent, so there is no shuffle: each partition encodes its own texts in Arrow batches, and a worker keeps the
words it has met (bounded), since a few hundred thousand words make up most of any text.

Letters and numbers are those of the tokenizer library's own Unicode version (asked for the code points that are newer than this
Python's tables), so that every single code point is told as it does.

Defined cases: null is the empty text; an empty text has no tokens, and both digests are of the empty string; texts of any length
are encoded whole; repeated rows give repeated results; other columns of the table are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

WORD_CACHE = 500_000  # words that a worker remembers before it starts anew


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself if printable Latin-1, else the next free
    one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@functools.cache
def newer() -> str:
    """Letters and numbers of Unicode versions newer than this Python's tables, as the `regex` package knows them."""
    return "".join(regex.findall(r"[\p{L}\p{N}]", "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")))


@functools.cache
def known(of: str) -> str:
    """A class of letters or numbers as a set without the code points that the tokenizer library's own Unicode version lacks."""
    has = {x for x, _ in pre_tokenizers.Split(Regex(of), "removed", invert=True).pre_tokenize_str(newer())}
    new = [ord(c) for c in regex.findall(of, newer()) if c not in has]
    ends = [i for i, c in enumerate(new) if i + 1 == len(new) or new[i + 1] != c + 1]
    ranges = "".join(f"\\U{new[a]:08x}-\\U{new[b]:08x}" for a, b in zip([0, *(i + 1 for i in ends[:-1])], ends, strict=True)) if new else ""
    return f"[{of}--[{ranges}]]" if ranges else f"[{of}]"


@functools.cache
def newer_small() -> dict[int, str]:
    """Small letters of capitals that are newer than this Python, where the library knows them."""
    lower = normalizers.Lowercase().normalize_str
    return {ord(c): x for c in newer() if (x := lower(c)) != c.lower()}


class Learned(dict):
    """A table that asks for what it lacks."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word):
        self.learn(word)
        return self[word]


class Encoder:
    """A vocabulary file of the word-end kind: NFC, lower case, words by its own pattern, bytes, `</w>` on a word's last symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("dropout"):
            raise ValueError(f"{path}: not a plain BPE vocabulary")
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {x["content"]: x["id"] for x in file.get("added_tokens", [])}
        self.ids_all = self.ids | self.special
        self.strings = {i: s for s, i in self.ids_all.items()}
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.ranks = {self.ids[a] << 20 | self.ids[b]: rank for rank, (a, b) in reversed([*enumerate(pairs)])}  # of a pair, its earliest
        self.made = [self.ids[a + b] for a, b in pairs]
        alphabet = byte_alphabet()
        self.first = [self.ids[c] for c in alphabet]
        self.last = {self.ids[c]: self.ids[c + self.end] for c in alphabet}
        pattern = next(x["pattern"]["Regex"] for x in file["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\p{L}", known(r"\p{L}")).replace(r"\p{N}", known(r"\p{N}")), regex.V1)
        self.new_capitals = regex.compile("[" + "".join(map(chr, newer_small())) + "]") if newer_small() else regex.compile("(?!)")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.word_ids: dict[str, str] = {}
        self.word_strings = Learned(self.learn)

    def merge(self, word: str) -> list[int]:
        """Ids of one word. A queue entry is rank * n + place, so that entries compare by rank, then from left to right."""
        symbols = [self.first[b] for b in word.encode("utf-8")]
        symbols[-1] = self.last[symbols[-1]]
        n, ranks, made = len(symbols), self.ranks, self.made
        if n < 2:
            return symbols
        now = [ranks.get(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]  # rank of the pair that begins here
        queue = [r * n + i for i, r in enumerate(now) if r >= 0]
        if not queue:
            return symbols
        now.append(-1)
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            if now[i] != rank:
                continue  # stale: one of the two symbols has been merged since
            j = after[i]
            symbols[i] = new = made[rank]
            symbols[j] = now[j] = -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                now[i] = r = ranks.get(new << 20 | symbols[k], -1)
                if r >= 0:
                    heapq.heappush(queue, r * n + i)
            else:
                now[i] = -1
            h = before[i]
            if h >= 0:
                now[h] = r = ranks.get(symbols[h] << 20 | new, -1)
                if r >= 0:
                    heapq.heappush(queue, r * n + h)
        return [s for s in symbols if s >= 0]

    def learn(self, word: str) -> None:
        """Encodes a new word into both tables of words met."""
        if len(self.word_ids) >= WORD_CACHE:
            self.word_ids.clear()
            self.word_strings.clear()
        ids = self.merge(word)
        self.word_ids[word] = " ".join(map(str, ids))
        self.word_strings[word] = self.decode(ids)

    def pieces(self, text: str) -> list[str]:
        """The words of a text without special tokens in it."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # lower case is taken letter by letter: a capital sigma has one small form, whatever stands beside it
        text = text.replace("Σ", "σ").lower()
        if not text.isascii() and self.new_capitals.search(text):
            text = text.translate(newer_small())
        return self.words.findall(text)

    def parts(self, text: str | None) -> tuple[str, str]:
        """The ids of a whole text and their vocabulary strings, each joined by one space."""
        if not text:
            return "", ""
        if self.cut and any(s in text for s in self.special):
            found = [(str(self.special[x]), x) if i % 2 else self.plain(x) for i, x in enumerate(self.cut.split(text))]
            return " ".join([x for x, _ in found if x]), " ".join([x for _, x in found if x])
        return self.plain(text)

    def plain(self, text: str) -> tuple[str, str]:
        words = self.pieces(text)
        strings = " ".join(map(self.word_strings.__getitem__, words))
        try:
            return " ".join(map(self.word_ids.__getitem__, words)), strings
        except KeyError:  # the tables were cleared on the way, with more new words in one text than they hold
            ids = [str(i) for w in words for i in self.merge(w)]
            return " ".join(ids), self.decode(list(map(int, ids)))

    def encode(self, text: str | None) -> list[int]:
        return list(map(int, self.parts(text)[0].split()))

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids if i in self.strings])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker and file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_ids(text, path: str):
    """A column with the ids of a text column, as array<int>; null is the empty text."""

    def ids(texts: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([e.encode(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return F.arrow_udf(ids, "array<int>")(text)


def token_text(ids, path: str):
    """A column with the text of a column of ids; null for null."""

    def text(rows: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([None if r is None else e.decode(r) for r in rows.to_pylist()], pa.string())

    return F.arrow_udf(text, "string")(ids)


def encoded(text, path: str, with_ids: bool = True):
    """A column of struct<[token_ids,] n_tokens, ids_sha256, decoded_sha256>: a text encoded whole, and those ids decoded again."""

    def each(texts: pa.Array) -> pa.Array:
        e, tokens, n, ids, back = encoder(path), [], [], [], []
        for t in texts.to_pylist():
            own, strings = e.parts(t)
            n.append(own.count(" ") + 1 if own else 0)
            ids.append(hashlib.sha256(own.encode()).hexdigest())
            back.append(hashlib.sha256(strings.encode()).hexdigest())
            if with_ids:
                tokens.append(np.array(own.split(), np.int32))
        columns = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
        return pa.StructArray.from_arrays([pa.array(tokens, pa.list_(pa.int32()))] * with_ids + columns, ["token_ids"] * with_ids + ["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.arrow_udf(each, "token_ids array<int>, " * with_ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string")(text)


def default_path() -> str:
    """Place of the vocabulary file on this machine; the executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    return docs.select("doc_id", encoded(F.col("text"), path or default_path(), False).alias("d")).select("doc_id", "d.*")
