"""Operator 12: how the tokens of two tokenizers stand to each other, over the bytes of the same text.

A (byte-level) encodes space and text, B (pieces) the text, to which it adds the space itself. Each byte has an owner among A's tokens and one among B's
(np.repeat of the tokens' numbers by their lengths). Where both owners change after the same byte is a cut; between cuts lie the groups. The tokens
that end at a cut, one of A and one of B, are a link.

Both tokenizers begin anew at a single space between two characters that aren't white space, and between a letter or digit and one of `.,;:!?`: A's
pattern has no piece over such a place, and B's vocabulary none either (asked when it is loaded, else texts are taken whole). So a text is split there
into segments, and a worker keeps the segments that it has met, within a bound: tokens, groups and links of a segment are the same wherever it
stands. New segments are encoded, and their owners compared, for many texts at once.

Two tokens that end together hold the same bytes as far as the shorter goes, so one is the other's end: the pairs that can be linked follow from the
vocabularies alone (`Pairs`), some hundred thousand. Tasks count into an array of that size, the sums come to the driver, and the counts go to all
tasks: their bound is the vocabularies', whatever the corpus.

Defined cases: null and empty texts, and texts that A's or B's tokens don't give back byte for byte, have zeros, no groups and no links; strings of
special tokens are plain text; texts of any length are encoded whole; repeated rows count each time; other columns aren't looked at.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .shared import slices, stored

SEGMENTS = 500_000  # that a worker remembers before it starts anew
LONG = 200  # letters of a segment that is not worth remembering
SPACE = "▁"
MARKS = ".,;:!?"
PLAIN = "0-9A-Za-zÀ-ÖØ-öø-ɏ"  # letters and digits before MARKS; of others it isn't asked
#: A fixed value: the published pattern of byte-level vocabularies, by which A's library splits texts, too.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CUTS = re.compile(rf"(?<=\S)(?= \S)|(?<=[{PLAIN}])(?=[{MARKS}])")
ODD = re.compile(rf"[^{PLAIN}][{MARKS}]|\s | \s| $|\0")  # where a space or mark may be no cut

ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<int>"


def default_paths() -> tuple[str, str]:
    """Places of A's and B's files on this machine; the executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """A and B of two files, with the bytes of each token."""

    def __init__(self, path_a: str, path_b: str, ranks_a: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        n = 1 + max(self.a.get_vocab().values())
        self.bytes_a = [bytes(byte_of[c] for c in self.a.id_to_token(i) or "" if c in byte_of) for i in range(n)]
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        plain_a = [i for i in range(n) if i not in special and self.bytes_a[i]]
        plain_b = [i for i in range(len(pieces)) if not self.b.is_control(i) and not self.b.is_unknown(i) and self.bytes_b[i]]
        self.size_a, self.size_b = np.array(list(map(len, self.bytes_a))), np.array(list(map(len, self.bytes_b)))
        self.text_a, self.text_b = list(map(str, range(n))), list(map(str, range(len(pieces))))
        over = re.compile(f"[^{SPACE}]{SPACE}|[{PLAIN}][{MARKS}]")
        self.apart = not any(map(over.search, pieces))
        self.plain = ranked(path_a, ranks_a) if ranks_a else None
        self.pairs = Pairs(plain_a, plain_b, self.bytes_a, self.bytes_b)

    def split(self, text: str) -> list[str]:
        """The segments of a text with a space before it. Where every space and every mark is a cut, they are found by replacing."""
        if not text or not self.apart:
            return [f" {text}"] if text else []
        text = f" {text}"
        if ODD.search(text):
            return CUTS.split(text)
        for mark in MARKS:
            text = text.replace(mark, f"\0{mark}")
        return text.replace(" ", "\0 ").split("\0")[1:]

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of segments by A and by B. B puts a space before what it is given, so a segment that has none of its own stands behind a mark there, which
        is a segment of its own."""
        if self.plain:  # of ASCII letters, digits and marks both libraries have the same notion
            ids_a = [self.plain(x) if x.isascii() else None for x in segments]
            rest = [i for i, x in enumerate(ids_a) if x is None]
            for i, x in zip(rest, self.a.encode_batch_fast([segments[i] for i in rest], add_special_tokens=False), strict=True):
                ids_a[i] = x.ids
        else:
            ids_a = [x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        ids_b = self.b.encode([x[1:] if x[:1] == " " else f"a{x}" for x in segments], num_threads=1)
        for i, x in enumerate(segments):
            if x[:1] != " ":
                del ids_b[i][0]
        return ids_a, ids_b


def ranked(path: str, ranks: str):
    """A function that gives A's ids of a string, by the same vocabulary as ranks, which takes a fifth of the time for short strings."""
    import base64
    import json

    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        known = json.load(f)["model"]["vocab"]
    alphabet = byte_alphabet()
    if any(known.get("".join(alphabet[b] for b in raw)) != i for raw, i in table.items()):
        raise ValueError(f"{ranks}: not the vocabulary of {path}")
    return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary


class Pairs:
    """All pairs of ids of which one token's bytes are the end of the other's: a superset of what can be linked, numbered by (B id, A id)."""

    def __init__(self, plain_a, plain_b, bytes_a, bytes_b):
        keys = set()
        of_a, of_b = {}, {}
        for ids, raw, of in ((plain_a, bytes_a, of_a), (plain_b, bytes_b, of_b)):
            for i in ids:
                of.setdefault(raw[i], []).append(i)
        for x, ids in of_a.items():
            keys |= {b << 32 | a for k in range(len(x)) for b in of_b.get(x[k:], ()) for a in ids}
        for x, ids in of_b.items():
            keys |= {b << 32 | a for k in range(len(x)) for a in of_a.get(x[k:], ()) for b in ids}
        self.keys = np.array(sorted(keys), np.int64)
        self.b = self.keys >> 32

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = b.astype(np.int64) << 32 | a
        found = np.searchsorted(self.keys, keys)
        if len(keys) and not (self.keys[np.minimum(found, len(self.keys) - 1)] == keys).all():
            raise ValueError("two tokens end together, but neither is the end of the other")
        return found

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Whether a pair's count is the highest of its B id."""
        if not len(counts):
            return np.zeros(0, bool)
        starts = np.flatnonzero(np.r_[True, self.b[1:] != self.b[:-1]])
        return counts == np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.r_[starts, len(counts)]))


@functools.cache
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Both tokenizers of this worker, kept between tasks, with one thread each: Spark has a task for each core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    ranks = path_a.removesuffix(".json") + ".tiktoken"
    return Tokenizers(path_a, path_b, ranks if os.path.exists(ranks) else None)


def owners(sizes: list[np.ndarray]) -> np.ndarray:
    """The number of the token that owns each byte."""
    return np.repeat(np.arange(len(sizes)), sizes)


def aligned(t: Tokenizers, segments: list[str]) -> list[tuple | None]:
    """(n_a, n_b, n_groups, groups, numbers of the linked pairs) of each segment; None where tokens don't give the segment back."""
    out: list[tuple | None] = [None] * len(segments)
    ids_a, ids_b = t.encode(segments)
    raw = [x.encode() for x in segments]
    whole = [i for i, x in enumerate(raw) if b"".join([t.bytes_a[k] for k in ids_a[i]]) == x and b"".join([t.bytes_b[k] for k in ids_b[i]]) == x]
    if not whole:
        return out
    list_a, list_b = [k for i in whole for k in ids_a[i]], [k for i in whole for k in ids_b[i]]
    flat_a, flat_b = np.array(list_a), np.array(list_b)
    own_a, own_b = owners(t.size_a[flat_a]), owners(t.size_b[flat_b])
    # the last byte of a group: both owners change behind it (a segment's end is one: tokens don't reach over it)
    last = np.flatnonzero(np.r_[(own_a[1:] != own_a[:-1]) & (own_b[1:] != own_b[:-1]), True])
    end_a, end_b = own_a[last], own_b[last]
    links = t.pairs.numbers(flat_a[end_a], flat_b[end_b]).tolist()
    end_a, end_b = (end_a + 1).tolist(), (end_b + 1).tolist()
    text_a, text_b = [t.text_a[k] for k in list_a], [t.text_b[k] for k in list_b]
    a = b = g = 0
    for i in whole:
        stop, first, groups = a + len(ids_a[i]), g, []
        to_b = b + len(ids_b[i])
        while a < stop:
            to_a, upto_b = end_a[g], end_b[g]
            groups.append(f"{','.join(text_a[a:to_a])}|{','.join(text_b[b:upto_b])}")
            a, b, g = to_a, upto_b, g + 1
        assert b == to_b
        out[i] = (len(ids_a[i]), len(ids_b[i]), g - first, ";".join(groups), links[first:g])
    return out


class Known(dict):
    """Segments that a worker has met."""

    def __init__(self):
        super().__init__()
        self.long: list[str] = []

    def learn(self, t: Tokenizers, segments: set[str]) -> None:
        """Adds those that are new; long ones stay until the next call."""
        for x in self.long:
            self.pop(x, None)
        new = [x for x in segments if x not in self]
        if len(self) + len(new) > SEGMENTS:
            self.clear()
            new = list(segments)
        self.update(zip(new, aligned(t, new), strict=True))
        self.long = [x for x in new if len(x) > LONG]


_KNOWN: dict[tuple[str, str], Known] = {}


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """ALIGNED of each row: counts, the digest of the groups, and the number of the linked pair (see Pairs) of each group."""

    def each(batches):
        t, known = tokenizers(path_a, path_b), _KNOWN.setdefault((path_a, path_b), Known())
        for batch in batches:
            for part in slices(batch, 1):
                texts = list(map(t.split, part.column(1).to_pylist()))
                known.learn(t, set().union(*texts))
                na, nb, ng, shas, links, ends = [], [], [], [], [], [0]
                for segments in texts:
                    found = [known[x] for x in segments]
                    if None in found:
                        found = []
                    na.append(sum([x[0] for x in found]))
                    nb.append(sum([x[1] for x in found]))
                    ng.append(sum([x[2] for x in found]))
                    shas.append(hashlib.sha256(";".join([x[3] for x in found]).encode()).hexdigest() if found else "")
                    for x in found:
                        links += x[4]
                    ends.append(len(links))
                arrays = [part.column(0), *(pa.array(x, pa.int64()) for x in (na, nb, ng)), pa.array(shas, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(links, pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit(""))).mapInArrow(each, ALIGNED)


def pair_counts(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, n): how many links hold a pair, over all rows. A task adds up its own in an array as long as the list of pairs."""

    def each(batches):
        counts = np.zeros(len(tokenizers(path_a, path_b).pairs.keys), np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=len(counts))
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(counts[there], pa.int64())], ["pair", "n"])

    return rows.select("links").mapInArrow(each, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def weighed(links, counts, path_a: str, path_b: str):
    """A column of struct<n_best, count_sum> of a column of linked pairs; counts: a broadcast (pairs, counts)."""

    def each(rows: pa.Array) -> pa.Array:
        pairs = tokenizers(path_a, path_b).pairs
        if not hasattr(counts, "ready"):
            n = np.zeros(len(pairs.keys), np.int64)
            n[counts.value[0]] = counts.value[1]
            counts.ready = n, pairs.best(n)
        n, best = counts.ready
        sizes, flat = rows.value_lengths().to_numpy(zero_copy_only=False), rows.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        sums, bests = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        np.add.at(sums, row, n[flat])
        np.add.at(bests, row, best[flat])
        return pa.StructArray.from_arrays([pa.array(bests), pa.array(sums)], ["n_best", "count_sum"])

    return F.arrow_udf(each, "n_best bigint, count_sum bigint")(links)


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row."""
    path_a, path_b = path_a or default_paths()[0], path_b or default_paths()[1]
    rows = stored(align(docs, path_a, path_b), "aligned")
    found = pair_counts(rows, path_a, path_b).toPandas()  # as many rows as Pairs has at most
    counts = docs.sparkSession.sparkContext.broadcast((found["pair"].to_numpy(), found["n"].to_numpy()))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("bigint").alias("n_links"), weighed(F.col("links"), counts, path_a, path_b).alias("w"), "groups_sha256").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "w.n_best", "w.count_sum", "groups_sha256"
    )
