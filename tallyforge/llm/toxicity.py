"""Operator 3: toxicity by a weighted lexicon.

A text is folded (case, full-width forms, look-alike letters of other scripts, digits written for letters), then an Aho-Corasick
automaton finds every entry of the lexicon: whole words, and beginnings of words. Exception phrases cancel the hits within them. The hits'
weights, normalised by the length of the text, become a score by a logistic curve.

Entries and weights come from labelled documents outside the held-out fold: words and word beginnings, weighted by the log odds of
toxic documents, chosen one after another while each explains toxic documents that those before it don't (so that a group of copies
can't flood the lexicon). Exception phrases are a short fixed list and those learned: a hit with the word before or after it, in FEW clean
documents at least and in no toxic one. A short seed list stands in where there are no labels. The fit sees a sample of at most about `most`
labelled documents (whole texts, of equal folded texts one, with the larger label); candidates and phrases are all of that sample's.
Scoring sees every document, in Arrow batches, without a shuffle.

Defined cases: null and empty texts score as a text without hits; labels that are null, other than 0 or 1, or of null ids count for
nothing; without labelled documents of both kinds the seed list and fixed curve are used; repeated rows give repeated rows; other
columns of the tables are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fold as fold_of
from .shared import labelled_sample, release, stored

THRESHOLD = 0.3
MOST_LABELLED = 12_000  # labelled documents to learn from, about
FEW = 3  # documents that an entry or an exception phrase stands in, at least
STEMS = (4, 5, 6, 7, 8)  # lengths of word beginnings considered

#: Letters of other scripts that look like Latin ones, and what they are read as. Fixed values.
LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝкмтвнαεορυικντιοɑɡｏ", "aeopcyxijshdqwkmtbhaeopyikvtioago", strict=True))
#: Digits and signs written for letters. Fixed values.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
INVISIBLE = dict.fromkeys("­​‌‍⁠﻿", "")
FOLDS = str.maketrans(LOOKALIKES | DIGITS | INVISIBLE | {chr(c): chr(c - 0xFEE0).lower() for c in range(0xFF21, 0xFF5B)})
#: Entries to begin with, of weight SEED_WEIGHT, and phrases in which an entry is harmless. Fixed values.
SEEDS = ["idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "imbecile", "scumbag"]
SEED_WEIGHT = 4.0
EXCEPTIONS = ["trash can", "trash bin", "pond scum", "soap scum", "clown fish", "sore loser board", "stupid mistake of mine"]
GAP = re.compile(r"[\W_]+")


def folded(text: str | None) -> str:
    """Words of a text in folded letters, with one space before each and after the last."""
    return GAP.sub(" ", f" {text.lower().translate(FOLDS)} ") if text else " "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-3.0, 1.2, 1.0)  # constant, of log weight, of log weight a word

    def __post_init__(self):
        self.machine = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "machine": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for w, x in self.weights.items():
                self.machine.add_word(f" {w}", (len(w) + 1, x))
            for w in self.exceptions:
                # a phrase may be an entry, too: then it cancels itself
                self.machine.add_word(f" {w} ", (len(w) + 2, -1.0))
            self.machine.make_automaton()
        return self.machine

    def hits(self, at: str) -> dict[int, float]:
        """Place and weight of the hits in a folded text: of entries that begin at one place the heaviest, less those within exceptions."""
        best: dict[int, float] = {}
        harmless = []
        if self.weights:
            for end, (n, x) in self.automaton().iter(at):
                start = end - n + 1
                if x < 0:
                    harmless.append((start, end))
                elif x > best.get(start, 0):
                    best[start] = x
        if harmless:
            harmless.sort()
            left, k, covered = {}, 0, -1
            for s in sorted(best):
                while k < len(harmless) and harmless[k][0] <= s:
                    covered = max(covered, harmless[k][1])
                    k += 1
                if s >= covered:
                    left[s] = best[s]
            best = left
        return best

    def features(self, text: str | None) -> tuple[float, float, int]:
        """(log weight of the hits, log weight a thousand words, hits) of a text."""
        return self.measured(folded(text))

    def measured(self, at: str) -> tuple[float, float, int]:
        best = self.hits(at)
        total = sum(best.values())
        return math.log1p(total), math.log1p(1000 * total / max(20, at.count(" "))), len(best)

    def phrases(self, at: str) -> set[str]:
        """Each hit's word with the word before it, and with the word after it."""
        out = set()
        for s in self.hits(at):
            end = at.index(" ", s + 1)
            before, after = at.rfind(" ", 0, s) if s else -1, at.find(" ", end + 1)
            out |= {at[a + 1 : b] for a, b in ((before, end), (s, after)) if a >= 0 and b >= 0}
        return out

    def score(self, text: str | None) -> float:
        a, b, n = self.features(text)
        if not n:
            return 0.0
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def grams(words: set[str]) -> set[str]:
    """Words of 3 to 24 letters, each closed by a space, and beginnings of words."""
    out = {f"{w} " for w in words if 3 <= len(w) <= 24}
    for n in STEMS:
        out |= {w[:n] for w in words if len(w) > n}
    return out


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Lexicon:
    """A lexicon from the labels outside the held-out fold. What comes to the driver is bounded by the sample of `most` documents."""
    raw = labelled_sample(docs, labels, "toxic", most)

    def to_folded(batches):
        for batch in batches:
            own = [folded(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in own], pa.binary()), pa.array(own, pa.string()), batch.column(1)], ["same", "folded", "label"])

    # of equal texts one, so that copies don't outvote the rest
    rows = raw.select("text", "label").mapInArrow(to_folded, "same binary, folded string, label int").groupBy("same").agg(F.first("folded").alias("folded"), F.max("label").alias("label"))
    sample = stored(rows.select("folded", "label"), "folded")
    release(raw)

    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Lexicon({w: SEED_WEIGHT for w in SEEDS}, EXCEPTIONS)
    counts = counted(sample, lambda t: grams(set(t.split())))
    # at least as often in toxic documents as four to one, were both labels equally common
    share = totals[1] / totals[0]
    wanted = counts.where((F.col("toxic") >= FEW) & (F.col("toxic") >= 4 * share * F.col("clean"))).collect()
    weight = {r["gram"]: math.log((r["toxic"] + 0.5) / (totals[1] + 1)) - math.log((r["clean"] + 0.5) / (totals[0] + 1)) for r in wanted}
    toxic_share = {r["gram"]: r["toxic"] / (r["toxic"] + r["clean"]) for r in wanted}
    lexicon = Lexicon({w: SEED_WEIGHT for w in SEEDS} | {w: weight[w] for w in chosen(sample, weight, toxic_share)}, EXCEPTIONS)
    harmless = counted(sample, lexicon.phrases).where((F.col("clean") >= FEW) & (F.col("toxic") == 0)).collect()
    lexicon = Lexicon(lexicon.weights, sorted({*EXCEPTIONS, *(r["gram"] for r in harmless)}))
    return Lexicon(lexicon.weights, lexicon.exceptions, curve(sample, lexicon))


def counted(sample: DataFrame, of) -> DataFrame:
    """(gram, toxic, clean): documents of either label that hold a gram, for the grams that `of` finds in a folded text. A batch sums its own."""

    def each(batches):
        for batch in batches:
            toxic: dict[str, int] = {}
            clean: dict[str, int] = {}
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                to = toxic if label else clean
                for g in of(text):
                    to[g] = to.get(g, 0) + 1
            kept = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([toxic.get(g, 0) for g in kept], pa.int64()), pa.array([clean.get(g, 0) for g in kept], pa.int64())], ["gram", "toxic", "clean"])

    return sample.select("folded", "label").mapInArrow(each, "gram string, toxic bigint, clean bigint").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def chosen(sample: DataFrame, weight: dict[str, float], pure: dict[str, float]) -> list[str]:
    """Candidates that explain toxic documents which no better candidate has explained: the one of most such documents first (of
    equal ones the purest, then the longest), until the next would explain fewer than FEW."""
    names = sorted(weight)
    index = {g: i for i, g in enumerate(names)}

    def found(batches):
        for batch in batches:
            rows = [sorted(index[g] for g in grams(set(t.split())) if g in index) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["found"])

    of: dict[int, set[int]] = {}
    for d, r in enumerate(sample.where("label = 1").select("folded").mapInArrow(found, "found array<int>").where(F.size("found") > 0).toLocalIterator()):
        for g in r["found"]:
            of.setdefault(g, set()).add(d)
    # a candidate never explains more than it did before, so one that is still first when it is counted anew is the best
    order = lambda g: (-len(of[g]), -pure[names[g]], -len(names[g]), -g)
    waiting = [(order(g), g) for g in of]
    heapq.heapify(waiting)
    out, explained = [], set()
    while waiting:
        was, g = heapq.heappop(waiting)
        of[g] -= explained
        if (now := order(g)) != was:
            heapq.heappush(waiting, (now, g))
        elif len(of[g]) < FEW:
            break
        else:
            out.append(names[g])
            explained |= of[g]
    return out


def curve(sample: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic regression of the label on the two features, over the sample's documents with hits; ridge on the slopes."""

    def measured(batches):
        for batch in batches:
            rows = [(*lexicon.measured(t), y) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = [r for r in rows if r[2]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.float64()) for i in (0, 1, 3)], ["a", "b", "y"])

    rows = sample.select("folded", "label").mapInArrow(measured, "a double, b double, y double").collect()
    if not rows:
        return Lexicon().curve
    x, y = np.array([[1.0, r["a"], r["b"]] for r in rows]), np.array([r["y"] for r in rows])
    w = np.zeros(3)
    # two rows of either label on top, so that labels that are all alike still give a curve
    x, y = np.vstack([x, [[1, 0, 0], [1, 0, 0], [1, 3, 4], [1, 3, 4]]]), np.concatenate([y, [0, 0, 1, 1]])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-3, 1e-1, 1e-1])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def scorer(spark, lexicon: Lexicon):
    held = spark.sparkContext.broadcast(lexicon)  # entries that explain the sample one after another: fewer than its documents

    def scores(texts: pa.Array) -> pa.Array:
        own = held.value
        return pa.array([own.score(t) for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(scores, "double")


def score_documents(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    score = scorer(docs.sparkSession, learn(docs, labels, most))
    rows = docs.select("doc_id", F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """docs without those predicted toxic, with their own columns."""
    return docs.where(scorer(docs.sparkSession, learn(docs, labels, most))(F.col("text")) < THRESHOLD)
