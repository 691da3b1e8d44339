"""Operators 11 to 13 against plain versions, with nulls, empty and long texts, repeats, ties, empty tables and odd columns."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tallyforge.llm import line_runs, phrases, token_alignment

from .test_operators import DOCS, ODD, documents


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# -- 11 ----------------------------------------------------------------------------------------------------------------------------------


def plain_lines(rows):
    def key(line):
        k = small(line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 20 else None

    holders = collections.defaultdict(set)
    for i, text, *_ in rows:
        for x in (text or "").split("\n"):
            holders[key(x)] |= {i} - {None}
    common = {k: max(v) for k, v in holders.items() if k and len(v) >= 3}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common or common[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_equals_a_plain_version(spark):
    r = random.Random(4)
    lines = [f"a line of some length, number {i}" for i in range(60)] + ["é" * 19, "é" * 20, "É" * 20, "short", "", "  \t", "x" * 19, "Y" * 20, "y" * 20, " \x0b" + "Y" * 20 + "\r", "日本語" * 7, "\xa0" + "z" * 19, "\xa0" + "z" * 18]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 12)))) for i in range(120)]
    rows += [*ODD, (7, rows[7][1]), (None, "y" * 20 + "\n" + "no id"), (None, lines[0]), (5000, "\n".join(lines * 400)), (-3, "Y" * 20 + "\n\n"), (905, "\n"), (906, "one line\r\n" + "y" * 20)]
    got = sorted((tuple(x) for x in line_runs.report(documents(spark, rows)).collect()), key=str)
    assert got == plain_lines(rows)
    assert sum(x[2] for x in got) > 100


def test_line_dedup_of_an_empty_table(spark):
    df = line_runs.report(spark.createDataFrame([], DOCS))
    assert df.collect() == [] and df.dtypes == [("doc_id", "bigint"), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")]


def test_runs_tell_fresh_lines_and_stay_few(spark):
    """Batch after batch: what no earlier batch had is fresh, each key is unseen in one run alone, and counts add up over compactions."""
    r = random.Random(9)
    runs, met, counts = line_runs.LineRuns(spark, buckets=3), set(), collections.Counter()
    for b in range(7):
        rows = [(b * 100 + i, "\n".join(f"line with the number {r.randint(0, 150)} of the batch" for _ in range(3))) for i in range(10)]
        got = {(x["doc_id"], x["key"]) for x in line_runs.fresh_lines(documents(spark, rows), runs).collect()}
        keys = {(i, line_runs.key_of(x.encode())) for i, t in rows for x in t.split("\n")}
        assert got == {(i, k) for i, k in keys if k not in met}
        met |= {k for _, k in keys}
        counts.update(k for _, k in keys)
        assert len(runs.runs()) <= 4
    rows = [x for name in runs.runs() for x in spark.table(name).collect()]
    assert collections.Counter(x["key"] for x in rows if not x["seen"]) == collections.Counter(met)
    assert {x["key"] for x in runs.shared(3).collect()} == {k for k, n in counts.items() if n >= 3}
    plan = runs.spark.table(runs.runs()[0]).join(runs.spark.table(runs.runs()[1]), "key")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan or "BroadcastExchange" in plan
    runs.drop(*runs.runs())


# -- 12 ----------------------------------------------------------------------------------------------------------------------------------


def plain_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(c): c for c in visible} | {chr(0x100 + i): c for i, c in enumerate(c for c in range(256) if c not in visible)}
    found, counts = [], collections.Counter()
    for i, text, *_ in rows:
        whole = f" {text}".encode()
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(x)) for x in ids_a]
        pieces = [b.id_to_piece(x) for x in ids_b]
        raw_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            found.append((i, [], [], [], []))
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, raw_a))), list(itertools.accumulate(map(len, raw_b)))
        groups, p, q = [], 0, 0
        at_a, at_b = {e: k + 1 for k, e in enumerate(ends_a)}, {e: k + 1 for k, e in enumerate(ends_b)}
        links = [(ids_a[at_a[e] - 1], ids_b[at_b[e] - 1]) for e in at_a if e in at_b]
        for e in sorted(at_a.keys() & at_b.keys()):
            groups.append(f"{','.join(map(str, ids_a[p : at_a[e]]))}|{','.join(map(str, ids_b[q : at_b[e]]))}")
            p, q = at_a[e], at_b[e]
        counts.update(links)
        found.append((i, ids_a, ids_b, groups, links))
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        (
            (i, len(x), len(y), len(g), len(ls), sum(counts[k] == best[k[1]] for k in ls), sum(counts[k] for k in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
            for i, x, y, g, ls in found
        ),
        key=str,
    )


def texts_of_all_kinds(n):
    r = random.Random(2)
    parts = [" ", " ", " ", ", ", ". ", "  ", "\n", "\t", "a", "b", "the", "The", "'s", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>", "é", "日本", "　", "\xa0", "1", "23", ".", "!", "?", ":", "...", "\x00", "😀", "\x1c", " \n ", "hello", "Wörter", "año", "__.", "²"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 30))) for _ in range(n)]


def test_alignment_equals_encodings_of_whole_texts(spark):
    texts = texts_of_all_kinds(600)
    rows = [*enumerate(texts), *ODD, (3, texts[3]), (2000, "▁ stands here"), (2001, "x" * 3000), (2002, "word, and more. " * 3000), (2003, " lead"), (2004, "trail "), (2005, "\udc80".encode("utf-8", "ignore").decode())]
    got = sorted((tuple(x) for x in token_alignment.report(documents(spark, rows)).collect()), key=str)
    assert got == plain_alignment(rows)
    assert sum(x[3] > 0 for x in got) > 500


def test_alignment_with_a_small_memory_and_without_cuts(monkeypatch):
    t = token_alignment.tokenizers(*token_alignment.default_paths())
    texts = texts_of_all_kinds(200)
    want = [token_alignment.aligned(t, [f" {x}"])[0] for x in texts]
    monkeypatch.setattr(token_alignment, "SEGMENTS", 40)
    known = token_alignment.Known()
    for x, w in zip(texts, want, strict=True):
        parts = t.split(x)
        known.learn(t, set(parts))
        found = [known[p] for p in parts]
        if w is None:
            assert None in found
        else:
            assert (sum(p[0] for p in found), sum(p[1] for p in found), ";".join(p[3] for p in found), [k for p in found for k in p[4]]) == (w[0], w[1], w[3], w[4])


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.report(spark.createDataFrame([], DOCS)).collect() == []


# -- 13 ----------------------------------------------------------------------------------------------------------------------------------


def plain_phrases(rows, least, first, longest=5):
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", small(text or "")):
            w = re.findall(r"[^ \t]+", piece)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        candidates = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        hidden = {k[i:j] for k, v in candidates.items() for i in range(len(k)) for j in range(i + 2, len(k) + 1) if j - i < len(k) and 100 * v >= 100 * f[k[i:j]]}
        kept = []
        for k, a in candidates.items():
            if k not in hidden:
                score, cut = min((1000 * a * n // (f[k[:c]] * f[k[c:]]), c) for c in range(1, len(k)))
                kept.append((-score, -a, " ".join(k).encode(), f[k[:cut]], f[k[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(kept)[:first])]
    return sorted(out)


@pytest.mark.parametrize(("least", "first", "size"), [(2, 10_000, 50), (3, 25, 700), (100, 2000, phrases.SHARD)])
def test_phrases_equal_a_plain_version(spark, least, first, size):
    r = random.Random(5)
    words = ["the", "of", "New", "York", "city", "É", "é", "日本", "a'b", "\x1cx", "\x00", "x y", "of"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None, "und"])) for i in range(80)]
    rows += [(x[0], x[1], None) for x in ODD] + [(1, rows[1][1], "en"), (999, "new york city. " * 4000, "en"), (1000, "a b c d e f g " * 300, "fr")]
    got = sorted(tuple(x) for x in phrases.collocations(documents(spark, rows), least, first, size=size).collect())
    assert got == plain_phrases(rows, least, first)
    assert got


def test_phrases_hold_with_a_filter_that_lets_all_pass(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(phrases.Filter, "has", lambda self, hashes: np.ones(len(hashes), bool))
    rows = [(i, f"one two three {i % 3} four five six {i % 5}", "en") for i in range(60)]
    single = phrases.Filter(1 << 15, [])
    got = {(n, p.as_py()): f for b in phrases.shard_counts([b".", b"a", b"b"], np.array([1, 2, 1, 2, 0], np.int32), "en", 1, 5, single, single) for n, p, f in zip(b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True)}
    assert got == {(1, "a"): 2, (1, "b"): 2, (2, "a b"): 2, (2, "b a"): 1, (3, "a b a"): 1, (3, "b a b"): 1, (4, "a b a b"): 1}
    assert sorted(tuple(x) for x in phrases.collocations(documents(spark, rows), 5, 50).collect()) == plain_phrases(rows, 5, 50)


def test_suffix_array_equals_sorting_suffixes():
    r = np.random.default_rng(1)
    for depth in (1, 2, 3, 5, 8):
        ids = r.integers(0, 4, 300).astype(np.int32)
        padded = [*ids.tolist(), *[0] * 8]
        order = phrases.suffix_array(ids, depth)
        found = [tuple(padded[i : i + depth]) for i in order]
        assert sorted(order.tolist()) == list(range(300)) and found == sorted(found)


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 9_000_000_000_123, 80_000_000_000_000_017, 9_000_000_000_124, 9_000_000_000_999
    exact = spark.createDataFrame([(a, n, left, right)], "a bigint, n bigint, l bigint, r bigint").selectExpr(phrases.EXACT).collect()[0][0]
    assert exact == 1000 * a * n // (left * right)


def test_phrases_of_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert phrases.collocations(documents(spark, [(1, None), (2, ""), (3, " .")])).collect() == []
