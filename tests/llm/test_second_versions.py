"""Whole queries of the learned operators against second, plain versions of all their steps: sample, fit and scores."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import dartminhash, language_id, masked_lm, quality, toxicity, warc
from tallyforge.llm.shared import words_of

from .test_operators import ODD, documents, labelled, languages, plain_grams, plain_hits, words  # noqa: F401


def known_labels(labels, column):
    """Of each id outside the held-out fold the largest label."""
    out = {}
    for r in labels.collect():
        if r["doc_id"] is not None and r[column] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            out[r["doc_id"]] = max(r[column], out.get(r["doc_id"], 0))
    return out


def same_scores(got, want, within):
    """Rows (doc_id, score) against scores by (doc_id, text); repeated rows are alike."""
    assert len(got) == len(want)
    key = lambda x: (str(x[0]), x[1])
    for (i, a), (j, b) in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert i == j and a == pytest.approx(b, abs=within)


# -- 8 -------------------------------------------------------------------------------------------------------------------------------------


def plain_statistics(text):
    raw = (text or "").encode()
    w = re.findall(rb"[0-9A-Za-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw))
    share = lambda p: math.sqrt(len(re.findall(p, raw)) / max(1, len(raw)))
    most = max((w.count(x) for x in set(w)), default=0)
    same = sum(w[i] == w[i - 1] for i in range(1, len(w)))
    few = quality.FEW
    return [share(rb"[A-Z]"), share(rb"[#$%&*+/<=>@\[\\\]^_`{|}~]"), share(rb"!"), share(rb"\|"), math.log((len(set(w)) + few) / (len(w) + few)), math.sqrt(same / (len(w) + 2 * few)), math.sqrt(most / (len(w) + 2 * few))]


def test_quality_query_equals_a_plain_version(spark, words):  # noqa: F811
    docs, labels = labelled(spark, words, 300)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    truth = known_labels(labels, "quality")
    fit = [(plain_statistics(t), truth[i]) for i, t in rows if i in truth]
    x, y = np.array([a for a, _ in fit]), np.array([b for _, b in fit])
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    logs = []
    every = (np.array([plain_statistics(t) for _, t in rows]) - centre) / scale
    for k in (0, 1):
        own = (x[y == k] - centre) / scale
        s = sum(np.outer(v - own.mean(0), v - own.mean(0)) for v in own) / len(own)
        s = (1 - quality.SHRINK) * s + quality.SHRINK * np.diag(np.diag(s)) + quality.FLOOR**2 * np.eye(7)
        off = every - own.mean(0)
        logs.append(np.log(len(own) / len(x)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(s), off))
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -40, 40)))
    got = [(r["doc_id"], r["score"]) for r in quality.score_documents(docs, labels).collect()]
    same_scores(got, [(i, p) for (i, _), p in zip(rows, want.tolist(), strict=True)], 1e-7)


# -- 3 -------------------------------------------------------------------------------------------------------------------------------------


def plain_lexicon(rows, truth):
    """Entries and exceptions by counting every gram of every text, and by looking through all candidates for each entry."""
    texts = {}
    for i, t in rows:
        if i in truth:
            at = toxicity.folded(t)
            texts[at] = max(truth[i], texts.get(at, 0))
    total = [sum(y == k for y in texts.values()) for k in (0, 1)]
    grams = {at: {w + " " for w in at.split() if 3 <= len(w) <= 24} | {w[:n] for w in at.split() for n in toxicity.STEMS if len(w) > n} for at in texts}
    count = {}
    for at, y in texts.items():
        for g in grams[at]:
            count.setdefault(g, [0, 0])[y] += 1
    weight = {g: math.log((t + 0.5) / (total[1] + 1)) - math.log((c + 0.5) / (total[0] + 1)) for g, (c, t) in count.items() if t >= toxicity.FEW and t * total[0] >= 4 * c * total[1]}
    left, entries = [at for at, y in texts.items() if y], {w: toxicity.SEED_WEIGHT for w in toxicity.SEEDS}
    while True:
        best = max(weight, key=lambda g: (sum(g in grams[at] for at in left), count[g][1] / sum(count[g]), len(g), g), default=None)
        if best is None or sum(best in grams[at] for at in left) < toxicity.FEW:
            break
        entries[best] = weight[best]
        left = [at for at in left if best not in grams[at]]
    first = toxicity.Lexicon(entries, toxicity.EXCEPTIONS)
    phrases = {}
    for at, y in texts.items():
        own, starts = at.split(), [m.start() for m in re.finditer(r" (?=\S)", at)]
        hits = {starts.index(s) for s in plain_hits(first, at)}
        for p in {" ".join(own[a : a + 2]) for k in hits for a in (k - 1, k) if a >= 0 and a + 2 <= len(own)}:
            phrases.setdefault(p, [0, 0])[y] += 1
    return toxicity.Lexicon(entries, [*toxicity.EXCEPTIONS, *(p for p, (c, t) in phrases.items() if c >= toxicity.FEW and not t)]), texts


def plain_measures(lexicon, text):
    total = sum(plain_hits(lexicon, text).values())
    return total, [1.0, math.log1p(total), math.log1p(1000 * total / max(20, toxicity.folded(text).count(" ")))]


def test_toxicity_query_equals_a_plain_version(spark, words):  # noqa: F811
    docs, labels = labelled(spark, words, 240)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lexicon, texts = plain_lexicon(rows, known_labels(labels, "toxic"))
    fit = [(x, y) for at, y in texts.items() for total, x in [plain_measures(lexicon, at)] if total]
    x, y = np.array([a for a, _ in fit] + [[1, 0, 0], [1, 0, 0], [1, 3, 4], [1, 3, 4]]), np.array([b for _, b in fit] + [0, 0, 1, 1])
    ridge = np.array([1e-3, 1e-1, 1e-1])
    # a step by a bound of the curvature never passes the best weights
    w, bound = np.zeros(3), np.linalg.inv(0.25 * x.T @ x + np.diag(ridge))
    for _ in range(100_000):
        step = bound @ (x.T @ (y - 1 / (1 + np.exp(-x @ w))) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-10:
            break
    want = []
    for i, t in rows:
        total, own = plain_measures(lexicon, t)
        want.append((i, 1 / (1 + math.exp(-float(np.clip(own @ w, -50, 50)))) if total else 0.0))
    assert len(lexicon.weights) > len(toxicity.SEEDS)
    got = [(r["doc_id"], r["score"]) for r in toxicity.score_documents(docs, labels).collect()]
    same_scores(got, want, 1e-4)


# -- 5 -------------------------------------------------------------------------------------------------------------------------------------


def letters(text):
    return ["".join(map(chr, p.tolist())) for p in language_id.stretches(text)]


def test_language_query_equals_a_plain_version(spark):
    """Sets of n-grams in place of numbers, and least squares over all stretches in place of sums of products."""
    docs = documents(spark, [*languages(150), (801, "çé " * 900, "cc"), *[(*o, None) for o in ODD]])
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    fit = [(k, p) for i, t, k in rows if i is not None and k and zlib.crc32(str(i).encode()) % 5 for p in letters(t)]
    names = sorted({k for k, _ in fit})
    marks = []
    for k in names:
        hashed = {(zlib.crc32(np.array([ord(c) for c in p], np.uint64).tobytes()), p) for n, p in fit if n == k}
        marks += [plain_grams(p) for _, p in sorted(hashed)[: language_id.LANDMARKS // len(names)]]
    kernel = lambda g: [len(g & m) / math.sqrt(len(g) * len(m)) for m in marks]
    values, vectors = np.linalg.eigh(np.array([kernel(m) for m in marks]))
    root = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    features = lambda p: np.append(np.array(kernel(plain_grams(p))) @ root, 1.0)
    f, of = np.array([features(p) for _, p in fit]), np.array([names.index(k) for k, _ in fit])
    weight = np.sqrt(1 / np.bincount(of))[of][:, None]  # languages count alike
    sides = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    size = f.shape[1]
    w = np.linalg.lstsq(np.vstack([f * weight, math.sqrt(1e-5) * np.eye(size)]), np.vstack([sides * weight, np.zeros((size, len(names)))]), rcond=None)[0]
    want, langs = [], {}
    for i, t, _ in rows:
        own = letters(t)
        means = np.mean([features(p) @ w for p in own], axis=0) if own else np.zeros(len(names))
        want.append((i, float(np.exp(3 * means.max()) / np.exp(3 * means).sum()) if own else 0.0))
        langs[i] = names[int(means.argmax())] if own else "und"
    got = language_id.identify(docs).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == langs
    same_scores([(r["doc_id"], r["score"]) for r in got], want, 1e-3)


# -- 6 -------------------------------------------------------------------------------------------------------------------------------------


class PlainNet:
    """The network in double precision, one window at a time, every output of a level at once."""

    def __init__(self, net):
        self.places, self.out, self.bias = (x.astype(float) for x in (net.places, net.out, net.bias))
        self.beyond = net.words + net.classes
        self.size, self.n = masked_lm.groups(self.beyond)
        self.blocks = [slice(k * masked_lm.WIDTH, (k + 1) * masked_lm.WIDTH) for k in range(len(masked_lm.OFFSETS))]

    def near(self, text, i):
        return [text[i + o] if 0 <= i + o < len(text) else self.beyond for o in masked_lm.OFFSETS]

    def levels(self, h, token):
        """(columns, place of the true one among them, probabilities) of each level."""
        group = token // self.size
        for columns, true in ((np.arange(self.n), group), (np.arange(self.n + group * self.size, min(self.n + (group + 1) * self.size, self.n + self.beyond)), token % self.size)):
            z = h @ self.out[:, columns] + self.bias[columns]
            p = np.exp(z - z.max())
            yield columns, true, p / p.sum()

    def hidden(self, near):
        return np.tanh(sum(self.places[t, b] for t, b in zip(near, self.blocks, strict=True)))

    def log(self, text, i):
        return sum(math.log(p[true]) for _, true, p in self.levels(self.hidden(self.near(text, i)), text[i]))

    def train(self, texts, rate):
        windows = [(t, i) for t in texts for i in range(len(t))]
        held = (self.places, self.out, self.bias)
        squares = [np.zeros_like(x) for x in held]
        step = min(masked_lm.STEP, max(masked_lm.SMALL_STEP, len(windows) // 16))
        for a in range(0, len(windows), step):
            own, grads = windows[a : a + step], [np.zeros_like(x) for x in held]
            for t, i in own:
                near = self.near(t, i)
                h, back = self.hidden(near), np.zeros(masked_lm.WIDTH)
                for columns, true, p in self.levels(h, t[i]):
                    p[true] -= 1
                    grads[1][:, columns] += np.outer(h, p) / len(own)
                    grads[2][columns] += p / len(own)
                    back += self.out[:, columns] @ p / len(own)
                for token, b in zip(near, self.blocks, strict=True):
                    grads[0][token, b] += back * (1 - h * h)
            for x, g, s in zip(held, grads, squares, strict=True):
                s += g * g
                x -= rate * g / np.sqrt(s + 1e-8)
        return len(windows)


def test_masked_lm_query_equals_a_plain_version(spark, words, tmp_path):  # noqa: F811
    """Vocabulary, shares, steps of each partition, averages and scores."""
    r = random.Random(8)
    rows = [(i, " ".join(r.choices(words[:320], [1 / (k + 1) for k in range(320)], k=r.randint(1, 40)))) for i in range(60)]
    documents(spark, [*rows, *ODD[1:4], *[(2000 + i, w) for i, w in enumerate(words[:320])]], 2).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    parts = {}
    for q in docs.select("doc_id", "text", F.spark_partition_id().alias("p")).collect():
        parts.setdefault(q["p"], []).append((q["doc_id"], words_of((q["text"] or "").encode())))
    assert len(parts) > 1
    count = {}
    for _, w in (x for own in parts.values() for x in own):
        for v in w:
            count[v] = count.get(v, 0) + 1
    n_words, classes = masked_lm.sizes_for(len(count))
    top = sorted(count, key=lambda v: (-count[v], v))[:n_words]
    of = {v: top.index(v) if v in top else n_words + zlib.crc32(v) % classes for v in count}
    total = {}
    for v in set(count) - set(top):
        total[of[v]] = total.get(of[v], 0) + count[v]
    assert total
    net = PlainNet(masked_lm.Net.new({v: i for i, v in enumerate(top)}, n_words, classes))
    for turn in range(masked_lm.ROUNDS):
        done = []
        for own in parts.values():
            each = PlainNet.__new__(PlainNet)
            each.__dict__ = {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in net.__dict__.items()}
            n = each.train([[of[v] for v in w] for i, (_, w) in enumerate(own) if i % masked_lm.EVERY == turn % masked_lm.EVERY], masked_lm.RATE / (1 + turn))
            done.append((n, each))
        every = sum(n for n, _ in done)
        net.places, net.out, net.bias = (sum(n * getattr(x, name) for n, x in done) / every for name in ("places", "out", "bias"))
    want = {}
    for i, w in (x for own in parts.values() for x in own):
        text = [of[v] for v in w]
        want[i] = (len(text), sum(net.log(text, k) + (math.log(count[w[k]] / total[text[k]]) if w[k] not in top else 0.0) for k in range(len(text))))
    for known in (0, masked_lm.KNOWN):
        for g in masked_lm.score_documents(docs, known=known).collect():
            n, s = want[g["doc_id"]]
            assert g["n_tokens"] == n and g["log_likelihood"] == pytest.approx(s, abs=0.01 + 0.002 * n)


def test_masked_lm_common_words_are_told_by_a_bounded_number_of_counts(spark):
    r = random.Random(2)
    counts = [r.choice([1, 2, 3, 1023, 1024, 5000, 123_456_789, 1 << 40]) + r.randint(0, 3) for _ in range(400)]
    df = spark.createDataFrame([(str(i).encode(), n) for i, n in enumerate(counts)], "word binary, n bigint")
    assert masked_lm.common_from(df, 0) == (400, None) and masked_lm.common_from(df.limit(0), 5) == (0, None)
    for known in (60, 150, 399, 400, 10_000):
        _, least = masked_lm.common_from(df, known)
        there = sum(n >= least for n in counts)
        assert there <= known
        below = max((n for n in counts if n < least), default=None)
        # the next counts, with all that share their ten leading bits, would be too many
        assert below is None or sum(n >= below >> max(0, below.bit_length() - 10) << max(0, below.bit_length() - 10) for n in counts) > known


# -- very long texts ----------------------------------------------------------------------------------------------------------------------------------


def long_text(words, n, seed):  # noqa: F811
    r = random.Random(seed)
    return " ".join(r.choices(words, k=n))


def test_masked_lm_of_a_very_long_text(spark, words):  # noqa: F811
    long = long_text(words, 250_000, 1)
    got = {g["doc_id"]: g for g in masked_lm.score_documents(documents(spark, [(1, long), (2, "one two"), (3, None)])).collect()}
    assert got[1]["n_tokens"] == 250_000 and got[2]["n_tokens"] == 2 and got[3]["n_tokens"] == 0
    assert math.isfinite(got[1]["log_likelihood"]) and got[1]["perplexity"] < 2 * len(words)


def test_near_duplicates_of_very_long_texts(spark, words):  # noqa: F811
    long = long_text(words, 250_000, 2).split(" ")
    near, far = long.copy(), long.copy()
    near[1000:9000] = long_text(words, 8000, 3).split(" ")
    far[:60_000] = long_text(words, 60_000, 4).split(" ")
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(long).upper()), (5, "a short one")]
    got = {g["doc_id"]: (g["component_id"], g["kept"], g["n_copies"]) for g in dartminhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: (1, True, 2), 2: (1, False, 1), 3: (3, True, 1), 4: (1, False, 2), 5: (5, True, 1)}


def test_pipeline_with_very_long_texts(spark, words, tmp_path):  # noqa: F811
    """Of two near copies one stays; a passage of the benchmark at the end of a long text counts by its share of the words."""
    long, item = long_text(words, 120_000, 5), long_text(words, 8000, 6)
    documents(spark, [(1, long), (2, long + " and some more"), (3, long_text(words, 100_000, 7) + " " + item), (4, long_text(words, 170_000, 8) + " " + item)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()) == [1, 4]


def test_warc_of_long_pages_in_one_batch(spark, monkeypatch):
    """Records leave a task after so many bytes of pages; each is that of its page alone."""
    monkeypatch.setattr(warc, "HELD", 300_000)
    pages = [(i, f"http://a/{i}", "<p>" + f"word {i} " * (1 if i % 3 else 40_000) + "</p>") for i in range(12)]
    got = {(r["page_id"], r["record_type"]): r["block"] for r in warc.derivatives(spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1)).collect()}
    assert len(got) == 24
    for i, url, page in pages:
        for (headers, block) in warc.derived(*warc.response(i, url, page)):
            assert got[i, dict(headers)["WARC-Type"]] == block
    batch = pa.RecordBatch.from_pylist([{"html": p} for _, _, p in pages])
    assert [x.num_rows for x in warc.slices(batch, 0, 256, 300_000)] == [3, 3, 3, 3]  # 280,000 bytes and two short pages, four times
