"""Operator 6: masked pseudo-likelihood.

A small network predicts every token of a text from the SIDE tokens on both sides: a table of embeddings for each of those places, summed, a tanh, and
a softmax in two levels, over groups of outputs and over the outputs of the token's group. A document's score is the sum of its tokens'
log-probabilities, each masked in turn.

Outputs are the most common words of the whole corpus, counted over all documents, and classes that the other words are hashed to. Both grow with
the root of the number of distinct words; the work for a token grows with its fourth root. A word of a class has the class's
log-probability and the log of its share in the class's tokens, so the probabilities of all words of the corpus add up to 1. Shares of
the KNOWN most common words are broadcast; those of all others are joined in Spark.

Training is data-parallel: in each round every partition starts from the same weights, takes steps over all windows of its own texts t,
t + EVERY, ... (in round t, so that each token of the corpus is trained in one of ROUNDS = EVERY rounds), and the partitions' weights are averaged by the number of windows,
in two levels of groups so that no task gathers more than some hundreds of them. So each part of the corpus has its share in the
model, and the driver holds one set of weights.

Defined cases: null texts and texts without words have 0 tokens, a sum of 0 and null mean and perplexity; an empty corpus gives an
empty result; repeated rows count as often as they stand; extra columns are not looked at. How rows are dealt to partitions decides which
steps are taken together, so scores differ a little from one dealing of the rows to another.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WORD_BYTES, one_thread, slices, stored

WORDS, CLASSES, SIDE, WIDTH = 192, 64, 3, 32  # words and classes at least
EVERY, ROUNDS, RATE = 2, 2, 0.1
OFFSETS = (*range(-SIDE, 0), *range(1, SIDE + 1))
STEP, SMALL_STEP = 8192, 512  # tokens of a step, and of one where there are few
KNOWN = 65_536  # words whose shares are broadcast, at most
PIECE = 8192  # weights in a row
CHUNK, BLOCK = 8192, 2048  # tokens predicted at once, and rows added up or fetched at once: these stay in a core's cache
SHORT = 64  # bytes of a word that is not long
FAR = -1e30  # bias of columns that no output has

#: What crc32 makes of a byte, by zlib's polynomial.
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = CRC >> 1 ^ (CRC & 1) * np.uint32(0xEDB88320)


@dataclass
class Net:
    vocabulary: dict[bytes, int]
    places: np.ndarray  # (tokens + 1: beyond the text) x (2 * SIDE * WIDTH): of each token its rows for each place beside the masked one
    out: np.ndarray  # WIDTH x (groups + tokens); the weights of an output stand beside each other
    bias: np.ndarray
    words: int = WORDS
    classes: int = CLASSES

    @classmethod
    def new(cls, vocabulary: dict[bytes, int], words: int = WORDS, classes: int = CLASSES, seed: int = 3) -> Net:
        r, v = np.random.default_rng(seed), words + classes
        wide = v + groups(v)[1]
        return cls(vocabulary, r.normal(0, 0.1, (v + 1, 2 * SIDE * WIDTH)).astype(np.float32), np.asfortranarray(r.normal(0, 0.1, (WIDTH, wide)).astype(np.float32)), np.zeros(wide, np.float32), words, classes)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.places.ravel(), self.out.ravel(), self.bias])

    def with_weights(self, flat: np.ndarray) -> Net:
        a, b = self.places.size, self.places.size + self.out.size
        flat = flat.astype(np.float32)
        return Net(self.vocabulary, flat[:a].reshape(self.places.shape).copy(), flat[a:b].reshape(self.out.shape).copy("F"), flat[b:].copy(), self.words, self.classes)

    def numbers(self, texts: list[bytes | None], of: Classes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tokens of all texts with SIDE paddings around each text, places of the tokens, tokens of each text)."""
        own, distinct, sizes = tokens_of(texts)
        return *self.padded((of or Classes(self.vocabulary, self.words, self.classes)).outputs(distinct)[own], sizes), sizes

    def padded(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens with SIDE paddings around each text, places of the tokens); the padding's number is that of no token."""
        at = np.arange(len(tokens)) + np.repeat(np.arange(1, len(sizes) + 1) * SIDE, sizes)
        ids = np.full(len(tokens) + SIDE * (len(sizes) + 1), self.words + self.classes, np.int32)
        ids[at] = tokens
        return ids, at

    def hidden(self, ids: np.ndarray) -> np.ndarray:
        """Of each place but the SIDE first and last, and a 1 for the bias."""
        rows, first, n = self.places.reshape(-1, WIDTH), ids.astype(np.int64) * len(OFFSETS), len(ids) - 2 * SIDE
        out, (h, fetched) = np.ones((n, WIDTH + 1), np.float32), np.empty((2, min(n, BLOCK), WIDTH), np.float32)
        for a in range(0, n, BLOCK):
            h, fetched = h[: n - a], fetched[: n - a]
            for k, o in enumerate(OFFSETS):
                b = a + SIDE + o
                np.take(rows, first[b : b + len(h)] + k, axis=0, out=fetched if k else h, mode="clip")
                if k:
                    h += fetched
            np.tanh(h, out=out[a : a + len(h), :WIDTH])
        return out

    def columns(self) -> tuple[np.ndarray, bool]:
        """(weights and bias: of the groups, then of each group's outputs, as many rows for each; whether no product with what is hidden,
        which is between -1 and 1, is so far from 0 that its exponential could be lost)."""
        size, n = groups(self.words + self.classes)
        w, wide = np.zeros((n + n * size, WIDTH + 1), np.float32), self.out.shape[1]
        w[:wide, :-1], w[:wide, -1], w[wide:, -1] = self.out.T, self.bias, FAR
        return w, bool((np.abs(w[:wide]) @ np.ones(WIDTH + 1, np.float32)).max() < 60)

    def log_probabilities(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each token at the places (in ascending order), given its neighbours."""
        out = np.empty(len(at), np.float64)
        size, n = groups(self.words + self.classes)
        w, safe = self.columns()
        for a in range(0, len(at), CHUNK):
            own = at[a : a + CHUNK]
            token = ids[own]
            order = np.argsort(small(token), kind="stable")
            h, token = np.take(self.hidden(ids[own[0] - SIDE : own[-1] + SIDE + 1]), (own - own[0])[order], axis=0), token[order]
            group, z = token // size, np.empty((len(token), size), np.float32)
            got = log_softmax(h @ w[:n].T, group, safe)
            for i, j, first in spans(group, size, n):
                np.matmul(h[i:j], w[first : first + size].T, out=z[i:j])
            out[a + order] = got + log_softmax(z, token - group * size, safe)
        return out

    def train(self, ids: np.ndarray, at: np.ndarray, squares: list[np.ndarray], rate: float) -> None:
        """One pass of steps over the places (in ascending order) with rates scaled by past gradients (squares)."""
        size, n = groups(self.words + self.classes)
        step, wide = min(STEP, max(SMALL_STEP, len(at) // 16)), self.out.shape[1]
        for a in range(0, len(at), step):
            own = at[a : a + step]
            near = ids[own[0] - SIDE : own[-1] + SIDE + 1]
            order = np.argsort(small(ids[own]), kind="stable")
            places, token = (own - own[0])[order], ids[own[order]]
            h, group, (w, safe) = np.take(self.hidden(near), places, axis=0), token // size, self.columns()
            g, z = np.zeros_like(w), np.empty((len(own), size), np.float32)
            p = off(h @ w[:n].T, group, len(own), safe)
            np.matmul(p.T, h, out=g[:n])
            back, more = p @ w[:n, :-1], np.empty((len(own), WIDTH), np.float32)
            there = list(spans(group, size, n))
            for i, j, first in there:
                np.matmul(h[i:j], w[first : first + size].T, out=z[i:j])
            p = off(z, token - group * size, len(own), safe)
            for i, j, first in there:
                np.matmul(p[i:j].T, h[i:j], out=g[first : first + size])
                np.matmul(p[i:j], w[first : first + size, :-1], out=more[i:j])
            back += more
            back *= 1 - h[:, :-1] ** 2
            adapt(self.out, g[:wide, :-1].T, squares[0], rate)
            adapt(self.bias, g[:wide, -1], squares[1], rate)
            # a neighbour's row gets what comes back from the places around it
            beside = np.zeros((len(near) + 2 * SIDE, WIDTH), np.float32)
            beside[2 * SIDE + places] = back
            which, g = summed(near, beside, around=tuple(SIDE - o for o in OFFSETS))
            x, s = np.empty((2, min(len(which), BLOCK // 8), g.shape[1]), np.float32)
            for b in range(0, len(which), BLOCK // 8):
                k = which[b : b + BLOCK // 8]
                x, s = x[: len(k)], s[: len(k)]
                np.take(self.places, k, axis=0, out=x, mode="clip")
                np.take(squares[2], k, axis=0, out=s, mode="clip")
                adapt(x, g[b : b + len(k)], s, rate)
                self.places[k], squares[2][k] = x, s


def adapt(x: np.ndarray, g: np.ndarray, squares: np.ndarray, rate: float) -> None:
    """Moves x against the gradient g, by a rate scaled by past gradients."""
    by = g * g
    squares += by
    np.add(squares, np.float32(1e-8), out=by)
    np.sqrt(by, out=by)
    np.divide(g, by, out=by)
    by *= np.float32(rate)
    x -= by


def summed(ids: np.ndarray, rows: np.ndarray, around: tuple[int, ...] = (0,), most: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids in order, sums of their rows; beside each other those at each distance `around` an id's place). An id's rows are cut into lots
    of `most` rows and a rest; to the first rows of all lots are added the second ones of those that have them, and so on. The sums of an id's
    lots are summed in the same way."""
    order = np.argsort(small(ids), kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))[: len(ids)]
    count = np.diff(np.append(first, len(ids)))
    start = np.flatnonzero((np.arange(len(ids)) - np.repeat(first, count)) % most == 0)
    length = np.diff(np.append(start, len(ids)))
    longest = np.argsort(-length, kind="stable")  # lots with as many rows or more stand before any other
    have = np.searchsorted(-length[longest], -np.arange(length.max(initial=0)))  # lots with more than 0, 1, 2, ... rows
    start, at = start[longest], np.empty(len(start), np.int64)
    at[longest] = np.arange(len(start))
    wide = len(around) * rows.shape[1]
    got, fetched = np.empty((2, len(start), wide), rows.dtype)
    for k, n in enumerate(have.tolist()):
        for a in range(0, n, BLOCK):
            place = order[start[a : min(n, a + BLOCK)] + k]
            to = fetched[: len(place)] if k else got[a : a + len(place)]
            np.take(rows, place[:, None] + np.array(around), axis=0, out=to.reshape(len(place), len(around), -1), mode="clip")
            if k:
                got[a : a + len(place)] += to
    lots = -(-count // most)
    head = np.cumsum(lots) - lots
    many = np.flatnonzero(np.repeat(lots > 1, lots))
    if len(many):
        own, sums = summed(np.repeat(np.arange(len(lots)), lots)[many], got[at[many]], most=most)
        got[at[head[own]]] = sums
    return ids[first], np.take(got, at[head], axis=0)


def small(ids: np.ndarray) -> np.ndarray:
    """Numbers in 16 bits where these hold them: such are sorted by digits."""
    return ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids


def groups(outputs: int) -> tuple[int, int]:
    """(outputs of a group, groups)."""
    size = math.isqrt(outputs - 1) + 1
    return size, -(-outputs // size)


def spans(group: np.ndarray, size: int, n: int):
    """(first row, row after the last, first column) of each group that has rows, which stand in the order of groups."""
    edges = np.searchsorted(group, np.arange(n + 1))
    for k in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        yield int(edges[k]), int(edges[k + 1]), n + k * size


def powers(z: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials, their sum in each row), in the place of z; unless it is safe, of z less the largest of its row."""
    if not safe:
        z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], np.float32)


def log_softmax(z: np.ndarray, true: np.ndarray, safe: bool) -> np.ndarray:
    """Log-probability of one column of each row."""
    if not safe:
        z -= z.max(1, keepdims=True)
    own = z[np.arange(len(z)), true].astype(np.float64)
    return own - np.log(powers(z, True)[1])


def off(z: np.ndarray, true: np.ndarray, of: int, safe: bool) -> np.ndarray:
    """Gradient of the mean loss, over `of` tokens, by the columns."""
    z, total = powers(z, safe)
    z *= (1 / (of * total))[:, None]
    z[np.arange(len(z)), true] -= np.float32(1 / of)
    return z


def split_words(texts: list[bytes | None]) -> tuple[pa.BinaryArray, np.ndarray]:
    """(the words of all texts, as words_of has them, words of each text), without an object for each word."""
    raw = np.frombuffer(b" ".join([b"", *(t or b"" for t in texts), b""]).translate(WORD_BYTES), np.uint8)
    inside = raw != 32
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.zeros(len(turns) // 2 + 1, np.int32)
    np.cumsum(turns[1::2] - turns[::2], out=edges[1:])
    words = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw[inside])])
    ends = np.cumsum([1, *(len(t or b"") + 1 for t in texts)])
    return words, np.diff(np.searchsorted(turns[::2], ends))


def tokens_of(texts: list[bytes | None]) -> tuple[np.ndarray, pa.BinaryArray, np.ndarray]:
    """(number of each word among the distinct ones, the distinct words, words of each text)."""
    words, sizes = split_words(texts)
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, sizes


def found(words: pa.BinaryArray, among: pa.BinaryArray) -> np.ndarray:
    """Place of each word among others; -1 if it is not there."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy()


class Classes(dict):
    """Numbers of words; a word outside the vocabulary gets a class by its hash."""

    def __init__(self, vocabulary: dict[bytes, int], words: int = WORDS, classes: int = CLASSES):
        super().__init__(vocabulary)
        self.words, self.classes = words, classes
        self.vocabulary, self.own = pa.array(list(vocabulary), pa.binary()), np.fromiter(vocabulary.values(), np.int32, len(vocabulary))

    def __missing__(self, word: bytes) -> int:
        return self.words + zlib.crc32(word) % self.classes

    def outputs(self, words: pa.BinaryArray) -> np.ndarray:
        return known_or_class(words, found(words, self.vocabulary), self.own, self.words, self.classes)


def known_or_class(words: pa.BinaryArray, place: np.ndarray, own: np.ndarray, first: int, classes: int) -> np.ndarray:
    """Outputs of words: `own` at the word's place, and the class, from `first` on, of a word without one."""
    out = np.empty(len(words), np.int32)
    there = place >= 0
    out[there] = own[place[there]]
    other = words.filter(pa.array(~there))
    out[~there] = crc32(other) % classes + first
    return out


def crc32(words: pa.BinaryArray) -> np.ndarray:
    """zlib.crc32 of each word: of the first bytes of all words, then of the second ones of those that have them, and so on; long words one by one."""
    edges, raw = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1], np.frombuffer(words.buffers()[2] or b"", np.uint8)
    size, out = np.diff(edges), np.empty(len(words), np.int64)
    for k in np.flatnonzero(size > SHORT).tolist():
        out[k] = zlib.crc32(raw[edges[k] : edges[k + 1]])
    own = np.flatnonzero(size <= SHORT)
    own = own[np.argsort(SHORT - size[own].astype(np.uint8), kind="stable")]
    start, crc = edges[own], np.full(len(own), 0xFFFFFFFF, np.uint32)
    have = np.cumsum(np.bincount(size[own], minlength=SHORT + 1)[::-1])[::-1]  # words of at least 0, 1, 2, ... bytes
    for k, n in enumerate(have[1:].tolist()):
        c = crc[:n]
        crc[:n] = CRC[(c ^ raw[start[:n] + k]) & 255] ^ (c >> 8)
    out[own] = ~crc
    return out


@dataclass
class Shares:
    """What is known of the corpus's words besides the weights: the vocabulary's and other common words, in this order, and
    the output and the log share of its class of each."""

    words: pa.BinaryArray
    output: np.ndarray
    share: np.ndarray
    totals: np.ndarray  # tokens of each class


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; a batch sums its own words before anything is shuffled."""

    def each(batches):
        for batch in batches:
            parts = [split_words(part.column(0).cast(pa.binary()).to_pylist())[0] for part in slices(batch, 0)]
            n = pa.chunked_array(parts, pa.binary()).value_counts()
            yield pa.RecordBatch.from_arrays([n.field(0), n.field(1)], ["word", "n"])

    return docs.select("text").mapInArrow(each, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def sizes_for(distinct: int) -> tuple[int, int]:
    """(words, classes) of the outputs for a corpus of so many distinct words."""
    words = max(WORDS, 2 * math.isqrt(distinct))
    return words, max(CLASSES, words // 3)


def common_from(counts: DataFrame, known: int) -> tuple[int, int | None]:
    """(number of words, least count such that at most `known` words have it or more; null if already the highest counts have more words).
    Counts are told by their ten leading bits, so the driver gets some thirty thousand rows at most, whatever the corpus."""
    low = "greatest(length(bin(n)) - 10, 0)"
    rows = counts.groupBy(F.expr(f"shiftleft(shiftright(n, {low}), {low})").alias("n")).agg(F.count("*").alias("k")).collect()
    least, room = None, known
    for n, k in sorted(((r["n"], r["k"]) for r in rows), reverse=True):
        if k > room:
            break
        least, room = n, room - k
    return sum(r["k"] for r in rows), least


def shares_of(counts: DataFrame, known: int = KNOWN) -> tuple[Net, Shares]:
    """A new net for the words counted, and their shares. To the driver come the words of the vocabulary, `known` words at most, and a row for
    each class."""
    distinct, least = common_from(counts, known)
    words, classes = sizes_for(distinct)
    top = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]
    total = np.zeros(classes, np.int64)
    for r in counts.groupBy((F.crc32("word") % classes).alias("c")).agg(F.sum("n").alias("n")).collect():
        total[r["c"]] = r["n"]
    for w, n in top:
        total[zlib.crc32(w) % classes] -= n
    vocabulary = {w: i for i, (w, _) in enumerate(top)}
    common = [(bytes(r["word"]), r["n"]) for r in counts.where(F.col("n") >= least).collect()] if least is not None else []
    common = [(w, n) for w, n in common if w not in vocabulary]
    of = [zlib.crc32(w) % classes for w, _ in common]
    output = np.array([*range(len(top)), *(words + c for c in of)], np.int32)
    share = np.array([0.0] * len(top) + [math.log(n / total[c]) for (_, n), c in zip(common, of, strict=True)])
    known_words = pa.array([*vocabulary, *(w for w, _ in common)], pa.binary())
    return Net.new(vocabulary, words, classes), Shares(known_words, output, share, total)


def averaged(parts: DataFrame, groups: int = 997) -> DataFrame:
    """(piece, n, weights) of each piece from those of the tasks: means weighted by n, over groups of tasks first, then over the groups."""

    def mean(t: pa.Table) -> pa.Table:
        n = t.column("n").to_numpy().astype(np.float64)
        w = t.column("weights").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
        return pa.table({"piece": t.column("piece").slice(0, 1), "n": pa.array([int(n.sum())], pa.int64()), "weights": pa.ListArray.from_arrays(pa.array([0, w.shape[1]], pa.int32()), pa.array((n @ w / n.sum()).astype(np.float32)))})

    for of in (groups, 1):
        own = parts.withColumn("own", F.pmod(F.hash("weights"), F.lit(of)))
        parts = own.groupBy("piece", "own").applyInArrow(mean, "piece int, n bigint, weights array<float>")
    return parts


def of_round(docs: DataFrame, turn: int, every: int) -> DataFrame:
    """The texts of a round, counted from each partition's first; those of other rounds don't go to Python."""
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return docs.select("text", number.alias("number")).where(F.col("number") % every == turn % every).select("text")


def learn(docs: DataFrame, net: Net, rounds: int = ROUNDS, every: int = EVERY) -> Net:
    spark = docs.sparkSession
    for turn in range(rounds):
        held = spark.sparkContext.broadcast(net)  # 225 weights for each output

        def each(batches, turn=turn, held=held):
            one_thread()
            own = held.value.with_weights(held.value.flat())
            squares = [np.zeros_like(own.out), np.zeros_like(own.bias), np.zeros_like(own.places)]
            n = 0
            of = Classes(own.vocabulary, own.words, own.classes)
            for batch in batches:
                for part in slices(batch, 0):
                    ids, at, _ = own.numbers(part.column(0).cast(pa.binary()).to_pylist(), of)
                    own.train(ids, at, squares, RATE / (1 + turn))
                    n += len(at)
            if n:
                flat = own.flat()
                edges = np.append(np.arange(0, len(flat), PIECE), len(flat)).astype(np.int32)
                pieces = len(edges) - 1
                yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([n] * pieces, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))], ["piece", "n", "weights"])

        parts = stored(of_round(docs, turn, every).mapInArrow(each, "piece int, n bigint, weights array<float>"), "weights")
        rows = averaged(parts).select("piece", "weights").toArrow().sort_by("piece")  # one set of weights
        if not rows.num_rows:
            break
        net = net.with_weights(rows.column("weights").combine_chunks().flatten().to_numpy())
    return net


SCORED = "doc_id {}, n bigint, s double, words array<binary>, times array<int>"


def score_documents(docs: DataFrame, rounds: int = ROUNDS, every: int = EVERY, known: int = KNOWN) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log_likelihood, perplexity of each document."""
    spark = docs.sparkSession
    counts = stored(word_counts(docs), "words")
    start, shares = shares_of(counts, known)
    held, also = spark.sparkContext.broadcast(learn(docs, start, rounds, every)), spark.sparkContext.broadcast(shares)

    def score(batches):
        """Scores with the shares of known words, and the other words with how often each stands in the text."""
        one_thread()
        net, of = held.value, also.value
        for batch in batches:
            for part in slices(batch, 1):
                own, distinct, sizes = tokens_of(part.column(1).cast(pa.binary()).to_pylist())
                place = found(distinct, of.words)
                output = known_or_class(distinct, place, of.output, net.words, net.classes)
                share = np.append(of.share, 0.0)[place]  # of a word that is not known, the last
                edges = np.concatenate([[0], np.cumsum(sizes)])
                ends = np.concatenate([[0.0], np.cumsum(net.log_probabilities(*net.padded(output[own], sizes)) + share[own])])
                there, k = np.flatnonzero((place < 0)[own]), max(1, len(distinct))
                pair, times = np.unique(np.repeat(np.arange(len(sizes)), sizes)[there] * k + own[there], return_counts=True)
                bounds = pa.array(np.searchsorted(pair, np.arange(len(sizes) + 1) * k).astype(np.int32))
                words = distinct.take(pa.array(pair % k))
                lists = [pa.ListArray.from_arrays(bounds, words), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(ends[edges[1:]] - ends[edges[:-1]]), *lists], ["doc_id", "n", "s", "words", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # rows are numbered once, as they are written: ids may be null or repeated
    scored = stored(docs.select("doc_id", "text").mapInArrow(score, SCORED.format(kind)).withColumn("row", F.monotonically_increasing_id()), "scored")
    other = scored.where(F.size("words") > 0).select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    totals = spark.createDataFrame([(i, int(n)) for i, n in enumerate(shares.totals)], "class int, total bigint")  # a row for each class
    share = counts.select("word", "n", (F.crc32("word") % len(shares.totals)).cast("int").alias("class")).join(F.broadcast(totals), "class").select("word", F.log(F.col("n") / F.col("total")).alias("share"))
    more = other.join(share, "word").select("row", F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("bigint").alias("n"), (F.col("times") * F.col("share")).alias("s"))
    out = scored.select("row", "doc_id", "n", "s").union(more).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    mean = F.when(F.col("n") > 0, F.col("s") / F.col("n"))
    return out.select("doc_id", F.col("n").alias("n_tokens"), F.col("s").alias("log_likelihood"), mean.alias("mean_log_likelihood"), F.exp(-mean).alias("perplexity"))
