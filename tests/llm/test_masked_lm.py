"""Operator 6: words without an object for each, what a step holds, sums of rows, weights so large that exponentials would be lost."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyforge.llm import masked_lm
from tallyforge.llm.shared import words_of

from .test_operators import ODD, documents


def net_of(outputs_like, seed=1):
    words, classes = masked_lm.sizes_for(outputs_like)
    return masked_lm.Net.new({b"w%d" % i: i for i in range(words)}, words, classes, seed)


def peak(f) -> int:
    tracemalloc.start()
    f()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_steps_hold_no_row_of_all_places_for_each_token():
    """A row of all places beside a token, for each token of a step, was most of the time of an operator over its budget."""
    net, r = net_of(40_000), np.random.default_rng(2)
    tokens = r.zipf(1.3, 16 * masked_lm.STEP) % (net.words + net.classes)  # the largest steps
    ids, at = net.padded(tokens, np.array([len(tokens)]))
    squares = [np.zeros_like(net.out), np.zeros_like(net.bias), np.zeros_like(net.places)]
    row = 2 * masked_lm.SIDE * masked_lm.WIDTH * 4
    assert peak(lambda: net.train(ids, at, squares, 0.1)) < 2 * masked_lm.STEP * row
    assert peak(lambda: net.log_probabilities(ids, at)) < 2 * masked_lm.STEP * row


def test_words_are_those_of_each_text():
    r = random.Random(3)
    texts = ["", None, " ", "a", " a", "a ", "A\tb\x0bc\x00d", "it's 3.14\r\n", "Ünï ÇÖDE x", "日本語。日本", *("".join(r.choices("aB9 .\n-é ", k=r.randint(0, 60))) for _ in range(200))]
    raw = [None if t is None else t.encode() for t in texts]
    for part in (raw, raw[:2], []):
        words, sizes = masked_lm.split_words(part)
        assert sizes.tolist() == [len(words_of(t)) for t in part] and words.to_pylist() == [w for t in part for w in words_of(t)]
    net = masked_lm.Net.new({b"a": 0, b"b": 1})
    of = masked_lm.Classes(net.vocabulary)
    ids, at, _ = net.numbers(raw)
    assert ids[at].tolist() == [of[w] for t in raw for w in words_of(t)]
    assert set(np.delete(ids, at).tolist()) == {net.words + net.classes}


def test_counts_are_those_of_all_documents(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choices("one Two three, four é", k=1) * r.randint(0, 3)) + f" w{i % 70}") for i in range(1200)] + [*ODD]
    want = Counter(w for _, t in rows for w in words_of((t or "").encode()))
    assert {bytes(g["word"]): g["n"] for g in masked_lm.word_counts(documents(spark, rows)).collect()} == want


def test_sums_of_rows_of_ids_that_are_very_frequent():
    r = np.random.default_rng(5)
    for ids in (np.repeat([7, 3, 70_000, 9], [5000, 1, 2047, 64]), np.zeros(1, np.int64), np.zeros(0, np.int64), r.zipf(1.2, 3000) % 500):
        ids = r.permutation(ids)
        rows = r.integers(-8, 9, (len(ids), 3)).astype(np.float32)
        which, g = masked_lm.summed(ids, rows)
        assert which.tolist() == sorted(set(ids.tolist())) and all((rows[ids == k].sum(0) == x).all() for k, x in zip(which, g, strict=True))


def test_large_weights_lose_no_probability():
    net = net_of(100)
    net.out *= 3000
    ids, at = net.padded(np.random.default_rng(6).integers(0, net.words + net.classes, 50), np.array([50]))
    size, n = masked_lm.groups(net.words + net.classes)
    got, want = net.log_probabilities(ids, at), []
    for i in at.tolist():
        h = np.tanh(sum(net.places[ids[i + o]].reshape(-1, masked_lm.WIDTH)[k].astype(float) for k, o in enumerate(masked_lm.OFFSETS)))
        z, group = h @ net.out.astype(float) + net.bias, ids[i] // size
        lo = lambda z, j: z[j] - z.max() - math.log(np.exp(z - z.max()).sum())
        want.append(lo(z[:n], group) + lo(z[n + group * size : min(n + (group + 1) * size, len(z))], ids[i] % size))
    assert min(want) < -200 and np.allclose(got, want, rtol=1e-3, atol=1e-2)
    squares = [np.zeros_like(net.out), np.zeros_like(net.bias), np.zeros_like(net.places)]
    net.train(ids, at, squares, 0.1)
    assert np.isfinite(net.flat()).all()


def test_a_round_sends_its_own_texts_to_python(spark):
    """Each round had all texts in Python and left out those of the others there."""
    docs = documents(spark, [(i, f"t{i}") for i in range(101)], 3)
    parts = {}
    for q in docs.select("text", F.spark_partition_id().alias("p")).collect():
        parts.setdefault(q["p"], []).append(q["text"])
    assert len(parts) == 3
    for every in (1, 2, 3):
        for turn in range(every + 1):
            got = [r["text"] for r in masked_lm.of_round(docs, turn, every).collect()]
            assert sorted(got) == sorted(t for own in parts.values() for t in own[turn % every :: every])


def test_sums_of_the_rows_around_places():
    r = np.random.default_rng(7)
    ids, rows = r.zipf(1.3, 3000) % 200, r.integers(-8, 9, (3006, 4)).astype(np.float32)
    which, g = masked_lm.summed(ids, rows, around=(6, 4, 0))
    assert which.tolist() == sorted(set(ids.tolist()))
    for k, x in zip(which, g, strict=True):
        at = np.flatnonzero(ids == k)
        assert x.tolist() == np.concatenate([rows[at + d].sum(0) for d in (6, 4, 0)]).tolist()


def test_hashes_of_words_are_those_of_each_word():
    r = random.Random(9)
    words = [r.randbytes(r.randint(0, 70)) for _ in range(2000)] + [b"", b"x" * 64, b"x" * 65, b"y" * 300_000]
    for part in (words, words[:1], []):
        assert masked_lm.crc32(pa.array(part, pa.binary())).tolist() == [zlib.crc32(w) for w in part]
    assert masked_lm.crc32(pa.array(words, pa.binary())[7:90]).tolist() == [zlib.crc32(w) for w in words[7:90]]
