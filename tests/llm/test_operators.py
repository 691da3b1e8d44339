"""Each operator on small tables: against a brute-force version or the public library, and with nulls, empty texts, repeats and odd columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import bpe, dartminhash, decontaminate, graph, language_id, license_join, masked_lm, quality, toxicity, vector_dedup, warc
from tallyforge.llm.shared import words_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, hits string"


def documents(spark, rows, parts=3):
    """Rows of (doc_id, text[, lang]) with columns whose names operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", 0, 1.0, "x") for r in rows], DOCS).repartition(parts)


def rows_of(df, key):
    return sorted(df.collect(), key=lambda r: tuple((r[k] is None, r[k]) for k in key))


@pytest.fixture(scope="module")
def words():
    r = random.Random(1)
    return ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 7))) for _ in range(400)]


ODD = [(None, "no id here at all"), (900, None), (901, ""), (902, " \n\t"), (903, "!!! ... ###"), (904, "one"), (904, "one")]


# -- 1 -----------------------------------------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    texts = ["I'm the DON'T they'll we've 12ab", "<|startoftext|>hi<|endoftext|> <|end", "ΟΔΟΣ Σ İstanbul ÉTÉ é", "a" * 5000 + " " + "ab" * 4000, "日本語 テキスト 123", " x y\x00z\x1c", "###$$$ &&&%%% !!", "", "naïve – “quotes”…"]
    r = random.Random(3)
    texts += ["".join(chr(r.choice([*range(32, 127), *range(160, 0x250), *range(0x400, 0x460), 0x301, 0x1F600])) for _ in range(60)) for _ in range(60)]
    e = bpe.Encoder(path)
    for x in texts:
        want = t.encode(x, add_special_tokens=False).ids
        assert e.encode(x) == want
        assert e.decode(want) == t.decode(want, skip_special_tokens=False)
    rows = [*enumerate(texts), *ODD]
    got = bpe.encode_documents(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert all((g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) == want[g["doc_id"]] for g in got)


def test_bpe_tells_every_code_point_as_the_library_does():
    from tokenizers import Tokenizer

    path = bpe.default_path()
    t, e = Tokenizer.from_file(path), bpe.Encoder(path)
    t.no_truncation()
    t.no_padding()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 50_000):
        texts = [f"x{c}y1 {c}{c}a" for c in points[a : a + 50_000]]
        assert [e.encode(x) for x in texts] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_bpe_columns_round_trip_and_a_full_cache(spark, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    e = bpe.Encoder(bpe.default_path())
    text = "one two three four five one two three four five"
    assert e.decode(e.encode(text)).replace("</w>", "") == text
    df = documents(spark, [(1, text), (2, None)]).select("doc_id", bpe.token_ids("text", bpe.default_path()).alias("ids"))
    back = {r["doc_id"]: r["t"] for r in df.select("doc_id", bpe.token_text("ids", bpe.default_path()).alias("t")).collect()}
    assert back[1].replace("</w>", "") == text and back[2] == ""


# -- 2 -----------------------------------------------------------------------------------------------------------------------------------


def brute_hits(text, items, window=13):
    w = words_of((text or "").encode())
    hit, names = set(), set()
    for name, t in items:
        own = words_of((t or "").encode())
        n = min(window, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def brute_matches(text, items, window=13):
    """Maximal verbatim matches of a window's length, by comparing all places."""
    w, out = words_of((text or "").encode()), []
    for name, t in items:
        own = words_of((t or "").encode())
        for i in range(len(w)):
            for j in range(len(own)):
                if w[i] == own[j] and not (i and j and w[i - 1] == own[j - 1]):
                    n = next((k for k in range(min(len(w) - i, len(own) - j)) if w[i + k] != own[j + k]), min(len(w) - i, len(own) - j))
                    if n >= min(window, len(own)):
                        out.append((i, str(name), j, n))
    return sorted(out)


def test_decontamination_equals_brute_force(spark, words):
    r = random.Random(5)
    items = [(i, " ".join(r.choices(words, k=r.choice([3, 8, 13, 20, 40])))) for i in range(12)] + [(20, None), (21, " . "), (3, "a second text of three " + " ".join(words[:9]))]
    docs = []
    for d in range(60):
        w = r.choices(words, k=r.randint(0, 80))
        for _ in range(r.randint(0, 3)):
            own = items[r.randrange(12)][1].split()
            a = r.randint(0, max(0, len(own) - 13))
            w[r.randint(0, len(w)) : 0] = own[a : a + r.randint(10, 20)]
        docs.append((d, ", ".join(w).upper() if d % 2 else "\n".join(w)))
    docs.append((99, " ".join(items[4][1].split() * 300)))
    bench = spark.createDataFrame([*items, (None, "nothing to name")], "item_id bigint, text string")
    for block in (1_000_000, 60):
        got = decontaminate.hits(documents(spark, [*docs, *ODD]), bench, "h", block_words=block).select("doc_id", "text", "h").collect()
        assert len(got) == len(docs) + len(ODD)
        for g in got:
            n, hit, names = brute_hits(g["text"], items)
            assert (g["h"]["n_words"], len(g["h"]["hit"]), sorted(g["h"]["items"])) == (n, hit, names)
            assert sorted((m["doc_word"], m["item_id"], m["item_word"], m["n_words"]) for m in g["h"]["matches"]) == brute_matches(g["text"], items)
    out = decontaminate.report(documents(spark, [*docs, *ODD]), bench)
    for g in out.collect():
        n, hit, names = brute_hits(dict([*docs, *ODD])[g["doc_id"]], items)
        assert g["contaminated"] == (hit > 0 and 20 * hit >= n) and g["n_items"] == len(names)
        longest = min(((-m[3], m[0]) for m in brute_matches(dict([*docs, *ODD])[g["doc_id"]], items)), default=(0, None))
        assert (g["longest_match"], g["longest_at"]) == (-longest[0], longest[1])
        assert g["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
    kept = decontaminate.decontaminate(documents(spark, [*docs, *ODD]), bench)
    assert kept.columns == [x.split()[0] for x in DOCS.split(", ")]
    assert kept.count() == out.where("not contaminated").count()


def test_longest_matches(spark, words):
    item = " ".join(words[:30])
    docs = documents(spark, [(1, "x y " + " ".join(words[4:28]) + " z"), (2, "nothing")])
    got = decontaminate.longest_matches(docs, spark.createDataFrame([(7, item)], "item_id bigint, text string")).orderBy("item_word").collect()
    assert (got[0]["doc_id"], got[0]["doc_word"], got[0]["item_id"], got[0]["item_word"], got[0]["n_words"]) == (1, 2, "7", 4, 24)


def test_decontamination_of_one_very_common_word(spark):
    docs = documents(spark, [(1, "the " * 300_000), (2, "a b " * 50_000 + "the")])
    bench = spark.createDataFrame([(7, "the"), (8, " ".join(f"w{i}" for i in range(5000)))], "item_id bigint, text string")
    got = {g["doc_id"]: (g["n_hit"], g["longest_match"]) for g in decontaminate.report(docs, bench).collect()}
    assert got == {1: (300_000, 1), 2: (1, 1)}
    long = documents(spark, [(1, "x " + " ".join(f"w{i}" for i in range(4990)))])
    assert decontaminate.longest_matches(long, bench).collect()[0]["n_words"] == 4990


def test_decontamination_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.report(documents(spark, [(1, "a b c")]), bench).collect()[0]["n_hit"] == 0
    assert decontaminate.report(documents(spark, []), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")).count() == 0


# -- 3, 8 ----------------------------------------------------------------------------------------------------------------------------------


def labelled(spark, words, n=700):
    r = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        w, toxic, good = r.choices(words, k=r.randint(20, 90)), r.random() < 0.15, r.random() > 0.15
        if toxic:
            for _ in range(3):
                w.insert(r.randint(0, len(w)), "grumbel" + r.choice(words) if i % 2 else r.choice(["snark", "5n@rk", "ѕnark"]))
        if not good:
            w = [x + r.choice(["###", "$$$", "&&&"]) for x in w] if i % 2 else [x for x in w[:6] for _ in range(12)]
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic)))
    return documents(spark, [*docs, *ODD]), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (901, 5, 7)], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("operator,column,threshold", [(toxicity, "toxic", 0.3), (quality, "quality", 0.7)])
def test_classifiers_hold_out_and_find(spark, words, operator, column, threshold):
    docs, labels = labelled(spark, words)
    got = operator.score_documents(docs, labels).collect()
    assert len(got) == 707
    truth = {r["doc_id"]: r[column] for r in labels.collect() if r[column] in (0, 1)}
    for g in got:
        assert g["held_out"] == (g["doc_id"] is not None and zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2)
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= threshold)
    held = [g for g in got if g["held_out"] and g["doc_id"] in truth]
    assert sum(g["predicted"] == truth[g["doc_id"]] for g in held) >= 0.95 * len(held)


def test_classifiers_do_not_learn_from_the_held_out(spark, words):
    docs, labels = labelled(spark, words)
    other = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    for operator in (toxicity, quality):
        a, b = (rows_of(operator.score_documents(docs, x), ["doc_id"]) for x in (labels, other))
        assert all(math.isclose(x["score"], y["score"], abs_tol=1e-9) for x, y in zip(a, b, strict=True))


def test_classifiers_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, [(1, "you idiot and 1d10t"), (2, "a calm day"), (3, None)])
    toxic = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, none).collect()}
    assert toxic == {1: 1, 2: 0, 3: 0}
    assert {r["score"] for r in quality.score_documents(docs, none).collect()} == {0.5}
    assert toxicity.keep_clean(docs, none).columns == docs.columns and toxicity.keep_clean(docs, none).count() == 2
    assert quality.score_documents(documents(spark, []), none).count() == 0


def test_quality_scores_are_those_of_two_normal_densities():
    r = np.random.default_rng(6)
    y = (r.random(300) < 0.7).astype(int)
    x = r.normal(size=(300, 7)) @ r.normal(size=(7, 7)) + y[:, None] * r.normal(size=7)
    model = quality.Discriminant.fit(x, y)
    z = (x - x.mean(0)) / x.std(0)
    logs = []
    for k in (0, 1):
        own = z[y == k]
        s = sum(np.outer(v - own.mean(0), v - own.mean(0)) for v in own) / len(own)
        s = (1 - quality.SHRINK) * s + quality.SHRINK * np.diag(np.diag(s)) + quality.FLOOR**2 * np.eye(7)
        off = z - own.mean(0)
        logs.append(np.log(len(own) / len(z)) - 0.5 * np.linalg.slogdet(2 * np.pi * s)[1] - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(s), off))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-9)


def test_quality_statistics_by_hand():
    got = dict(zip(quality.NAMES, quality.statistics("Go GO go! a|b"), strict=True))
    n = 13
    assert got["capitals"] == pytest.approx(math.sqrt(3 / n)) and got["exclamations"] == pytest.approx(math.sqrt(1 / n)) and got["bars"] == pytest.approx(math.sqrt(1 / n))
    assert got["distinct words"] == pytest.approx(math.log((3 + quality.FEW) / (5 + quality.FEW))) and got["words as the last"] == pytest.approx(math.sqrt(2 / (5 + 2 * quality.FEW)))
    assert quality.statistics(None) == quality.statistics("") and len(quality.statistics("x" * 2_000_000)) == len(quality.NAMES)


def test_toxicity_folds_and_exceptions():
    x = toxicity.Lexicon({"idiot": 3.0, "trash": 2.0}, ["trash can"])
    assert x.features("ＩＤＩОＴ")[2] == 1 and x.features("1d10t")[2] == 1 and x.features("i​diot")[2] == 1
    assert x.features("a trash can here")[2] == 0 and x.features("trash, candid")[2] == 1 and x.features("videotrash")[2] == 0
    assert toxicity.Lexicon({"ass ": 3.0}).features("assemble the ass")[2] == 1
    long = "calm " * 5000
    assert x.score("idiot " + long) < x.score("idiot " * 30 + long)


def plain_hits(lexicon, text):
    """Hits by trying every entry and exception at every place."""
    at = toxicity.folded(text)
    best = {i: max(x for w, x in lexicon.weights.items() if at.startswith(f" {w}", i)) for i in range(len(at)) if any(at.startswith(f" {w}", i) for w in lexicon.weights)}
    covered = [(i, i + len(w) + 1) for w in lexicon.exceptions for i in range(len(at)) if at.startswith(f" {w} ", i)]
    return {i: x for i, x in best.items() if not any(a <= i < b for a, b in covered)}


def test_toxicity_equals_a_plain_matcher():
    r = random.Random(12)
    for _ in range(60):
        words = ["".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(12)]
        lexicon = toxicity.Lexicon({w + r.choice(["", " "]): r.uniform(1, 3) for w in words[:5]}, [" ".join(r.choices(words, k=2)) for _ in range(3)])
        text = " ".join(r.choices(words, k=80))
        hits = plain_hits(lexicon, text)
        total = sum(hits.values())
        assert lexicon.hits(toxicity.folded(text)) == pytest.approx(hits)
        assert lexicon.features(text) == pytest.approx((math.log1p(total), math.log1p(1000 * total / 81), len(hits)))
        z = lexicon.curve[0] + lexicon.curve[1] * math.log1p(total) + lexicon.curve[2] * math.log1p(1000 * total / 81)
        assert lexicon.score(text) == pytest.approx(1 / (1 + math.exp(-z)) if hits else 0.0)


def test_toxicity_of_a_very_long_text_takes_time_in_proportion():
    import time

    lexicon = toxicity.Lexicon({"scum": 3.0}, ["pond scum"])
    t = time.time()
    assert lexicon.features("pond scum " * 100_000 + "scum")[2] == 1
    assert time.time() - t < 5


def test_toxicity_does_not_depend_on_how_rows_are_dealt(spark, words):
    docs, labels = labelled(spark, words)
    docs = docs.union(docs.where("doc_id % 3 = 0"))  # copies
    a, b = (toxicity.learn(docs.repartition(n), labels) for n in (1, 7))
    assert a.weights == b.weights and a.exceptions == b.exceptions and a.curve == pytest.approx(b.curve)


def test_exception_phrases_are_learned(spark, words):
    r = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        w, toxic = r.choices(words, k=30), i % 4 == 0
        if toxic:
            w[5:5] = [r.choice(words), "grotch", r.choice(words)]
        elif i % 4 == 1 and i % 8 != 5:
            w[9:9] = ["garden", "grotch"]
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    lexicon = toxicity.learn(documents(spark, docs), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert "garden grotch" in lexicon.exceptions and lexicon.features("a garden grotch here")[2] == 0 and lexicon.features("you grotch here")[2] == 1


# -- 4 -----------------------------------------------------------------------------------------------------------------------------------------


def test_warc_derivatives(spark):
    page = '<html lang="fr"><head><title>A &amp; B</title><style>x{}</style></head><body><p>One <b>two</b></p><script>no()</script><!-- no --><a href="/x?a=1&amp;b=2">three</a><br>&eacute;</body></html>'
    pages = spark.createDataFrame([(1, "http://a/", page, "x"), (2, None, None, "y"), (3, "http://b/", "", "z"), (1, "http://a/", page, "x")], "page_id bigint, url string, html string, record_id string")
    rows = warc.derivatives(pages).collect()
    assert len(rows) == 8
    by = {(r["page_id"], r["record_type"]): r for r in rows}
    text = by[1, "conversion"]
    assert text["block"].decode() == "One two\nthree\né"
    assert text["refers_to"] == by[1, "metadata"]["refers_to"] == dict(warc.response(1, "http://a/", page)[0])["WARC-Record-ID"]
    assert text["source_payload_digest"] == warc.digest(page.encode()) and text["block_digest"] == warc.digest(text["block"])
    fields = by[1, "metadata"]["block"].decode()
    assert "title: A & B\r\n" in fields and "outlink: /x?a=1&b=2 L a/@href\r\n" in fields and "language: fr" in fields and warc.digest(page.encode()) in fields
    assert by[2, "conversion"]["content_length"] == 0 and by[2, "conversion"]["target_uri"] is None
    assert len({r["record_id"] for r in rows}) == 6


def test_warc_files_round_trip(spark, tmp_path):
    import gzip

    headers, block = warc.response(5, "http://c/", "<p>hi</p>")
    raw = warc.rendered([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x>")], b"software: y\r\n") + warc.rendered(headers, block)
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw))
    rows = warc.from_files(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert sorted(r["record_type"] for r in rows) == ["conversion", "conversion", "metadata", "metadata"]
    again = list(warc.parsed(rows[0]["record"]))
    assert again[0][1] == rows[0]["block"] and dict(again[0][0])["WARC-Refers-To"] == dict(headers)["WARC-Record-ID"]


def test_warc_of_pages_built_from_known_text():
    """Pages are written from a list of blocks, so text and links are known without a parser."""
    r = random.Random(11)
    for _ in range(60):
        page, lines, links = [], [], []
        for _ in range(r.randint(1, 12)):
            words = [r.choice(["one", "two", "drei", "&amp;", "é", "&lt;x&gt;"]) for _ in range(r.randint(1, 8))]
            text = " ".join(words).replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
            inner = f" {r.choice(['b', 'i', 'span'])}".join(["", ""]) + " ".join(f"<b>{w}</b>" if r.random() < 0.3 else w for w in words)
            inner = inner.removeprefix(" b").removeprefix(" i").removeprefix(" span")
            kind = r.random()
            if kind < 0.2:
                inner += '<script src="s.js">if (a < b) { "</p>" }</script >'
                links.append("s.js E script/@src")
            elif kind < 0.4:
                inner = f"<a class=x href='/q?{len(page)}'>{inner}</a><!-- <a href=no> -->"
                links.append(f"/q?{len(page)} L a/@href")
            elif kind < 0.5:
                inner += "<svg><a href=no>hidden</a></svg>"
            elif kind < 0.6:
                inner += "<svg/><img src=i.png>"
                links.append("i.png E img/@src")
            page.append(f"<{r.choice(['p', 'div', 'LI'])} x=1>{inner}\n")
            lines.append(text)
        text, fields = warc.scanned("<!DOCTYPE html><html lang=de><head><title>T &amp; t</title><style>p {}</style></head><body>" + "".join(page))
        assert text == "\n".join(lines)
        assert fields == [("title", "T & t"), ("language", "de"), *(("outlink", x) for x in links)]


def test_warc_of_odd_pages():
    assert warc.scanned("a <noscript>b <p>c <svg/> d <template> e")[0] == "a b\nc d e"
    assert warc.scanned("a <!-- b <p>c")[0] == "a <!-- b\nc" and warc.scanned("x < y <3 <")[0] == "x < y <3 <"
    assert warc.scanned("a <script> b </p> c")[0] == "a" and warc.scanned("<head> a <p>b")[0] == "a\nb"
    assert warc.scanned("a <p <b> c")[0] == "a\nc" and warc.scanned("a <b")[0] == "a <b"


@pytest.mark.parametrize("part", ["<a ", "<!--", "<title>", "<head>", "<svg>", "<noscript><", "<script", "</svg", '<a "', "<meta <", "&#", "<a href=", "<p\n"])
def test_warc_of_a_very_long_page_takes_time_in_proportion(part):
    import time

    t = time.time()
    warc.scanned(part * (1_000_000 // len(part)))
    warc.scanned(part * (1_000_000 // len(part)) + ">")
    assert time.time() - t < 20


def test_warc_encodings(spark, tmp_path):
    import gzip
    import zlib as z

    page = '<html><head><meta charset="windows-1252"></head><p>caf\u00e9 \u201cx\u201d</p></html>'
    raw = page.encode("cp1252")
    chunks = lambda b: b"".join(b"%x;ext=1\r\n%s\r\n" % (len(b[i : i + 7]), b[i : i + 7]) for i in range(0, len(b), 7)) + b"0\r\n\r\n"
    cases = [("", raw), ("Content-Encoding: gzip", gzip.compress(raw)), ("Content-Encoding: deflate", z.compress(raw)), ("Content-Encoding: deflate", z.compress(raw)[2:-4]), ("Transfer-Encoding: chunked", chunks(raw)), ("Transfer-Encoding: chunked\r\nContent-Encoding: gzip", chunks(gzip.compress(raw))), ("Content-Type: text/html; charset=cp1252", raw), ("Content-Encoding: gzip", raw)]
    file = b""
    for k, (header, body) in enumerate(cases):
        block = f"HTTP/1.1 200 OK\r\n{header}\r\n\r\n".replace("\r\n\r\n\r\n", "\r\n\r\n").encode() + body
        file += warc.rendered([("warc-type", "response"), ("Warc-Record-Id", f"<urn:{k}>")], block)
    file += b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nlost\r\n\r\n" + warc.rendered([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:last>")], b"HTTP/1.1 200 OK\r\n\r\nend")
    (tmp_path / "a.warc").write_bytes(file)
    rows = [r for r in warc.from_files(spark.read.format("binaryFile").load(str(tmp_path))).collect() if r["record_type"] == "conversion"]
    got = {r["refers_to"]: r["block"].decode() for r in rows}
    assert [got[f"<urn:{k}>"] for k in range(len(cases))] == ["caf\u00e9 \u201cx\u201d"] * len(cases) and got["<urn:last>"] == "end"
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.report(empty).count() == 0


# -- 5, 6 ------------------------------------------------------------------------------------------------------------------------------------------


def languages(n=240):
    r = random.Random(4)
    syllables = {"aa": ["ka", "to", "mi", "ne"], "bb": ["sch", "ung", "ber", "tz"], "cc": ["çé", "ou", "eau", "è"]}
    return [(i, " ".join("".join(r.choices(syllables[k], k=r.randint(1, 4))) for _ in range(r.randint(3, 60))), k) for i in range(n) for k in [r.choice(sorted(syllables))]]


def test_language_id(spark):
    rows = languages()
    long = (800, " ".join(x[1] for x in rows if x[2] == "bb") * 20, "bb")
    docs = documents(spark, [*rows, long, *[(*o, None) for o in ODD], (905, "123 456", "aa")])
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows) + len(ODD) + 2
    by = {g["doc_id"]: g for g in got}
    held = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    assert held and all(by[i]["held_out"] for i, _, _ in held)
    assert sum(by[i]["lang_pred"] == k for i, _, k in held) >= 0.97 * len(held)
    assert by[800]["lang_pred"] == "bb"
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (900, 901, 902, 903, 905))
    assert all(0 <= g["score"] <= 1 for g in got)
    nothing = language_id.identify(documents(spark, [(1, "some text", None)])).collect()
    assert nothing[0]["lang_pred"] == "und"


def plain_grams(text):
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = "".join(c for i, c in enumerate(t) if c != " " or i == 0 or t[i - 1] != " ")
    return {t[i : i + n] for n in language_id.GRAMS for i in range(len(t) - n + 1)}


def test_language_kernel_is_that_of_sets_of_n_grams():
    r = random.Random(5)
    marks = ["ab ba", "ab abab", "çé ou eau", "日本語 テキスト"]
    grams = language_id.Grams([p for t in marks for p in language_id.stretches(t)])
    texts = [*marks, "x", "a b", "mixed ab 日本 eau", *("".join(r.choice("abç é日x") for _ in range(40)) + "a" for _ in range(20))]
    got = grams.kernels([p for t in texts for p in language_id.stretches(t)])
    for i, t in enumerate(texts):
        for j, m in enumerate(marks):
            a, b = plain_grams(t), plain_grams(m)
            assert got[i, j] == pytest.approx(len(a & b) / math.sqrt(len(a) * len(b)), abs=1e-6)
    # scores through folded weights are those of kernels by weights
    w = np.random.default_rng(1).normal(size=(4, 3))
    model = language_id.Languages(["a", "b", "c"], grams, ((grams.presence / np.sqrt(grams.sizes)[None, :]) @ w).astype(np.float32), np.zeros(3))
    parts = [p for t in texts for p in language_id.stretches(t)]
    assert np.allclose(model.scores(parts), got @ w, atol=1e-5)


def test_languages_in_blocks(spark):
    rows = languages()
    docs = documents(spark, [*rows, *[(*o, None) for o in ODD]])
    got = {g["doc_id"]: g for g in language_id.identify(docs, languages=2).collect() if g["doc_id"] is not None}
    held = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    assert sum(got[i]["lang_pred"] == k for i, _, k in held) >= 0.95 * len(held) and got[900]["lang_pred"] == "und" and all(0 <= g["score"] <= 1 for g in got.values())
    assert language_id.identify(documents(spark, [])).count() == 0


def test_masked_lm(spark):
    r = random.Random(2)
    lines = ["the cat sat on the mat", "a dog ran in the park", "birds fly over the lake at dawn"]
    docs = [(i, " ".join(r.choices(lines, k=30))) for i in range(60)]
    shuffled = docs[0][1].split()
    r.shuffle(shuffled)
    docs += [(500, " ".join(shuffled)), *ODD]
    got = masked_lm.score_documents(documents(spark, docs), rounds=3, every=1).collect()
    assert len(got) == len(docs)
    by = {g["doc_id"]: g for g in got}
    assert by[500]["n_tokens"] == by[0]["n_tokens"] and by[500]["log_likelihood"] < by[0]["log_likelihood"]
    assert by[900]["n_tokens"] == 0 and by[900]["log_likelihood"] == 0 and by[900]["perplexity"] is None
    assert all(g["log_likelihood"] <= 0 for g in got)
    assert masked_lm.score_documents(documents(spark, [])).count() == 0


def test_masked_lm_probabilities_add_up():
    net = masked_lm.Net.new({b"a": 0, b"b": 1})
    ids, at, sizes = net.numbers([b"a b a", None, b"b"])
    assert sizes.tolist() == [3, 0, 1] and len(at) == 4
    total = 0.0
    for token in range(masked_lm.WORDS + masked_lm.CLASSES):
        other = ids.copy()
        other[at[1]] = token
        total += math.exp(net.log_probabilities(other, at)[1])
    assert abs(total - 1) < 1e-4
    loss = lambda: -net.log_probabilities(ids, at).mean()
    before, squares = loss(), [np.zeros_like(net.out), np.zeros_like(net.bias), np.zeros_like(net.places)]
    for _ in range(30):
        net.train(ids, at, squares, 0.1)
    assert loss() < before / 3


def test_masked_lm_tells_the_words_of_a_class_apart(spark):
    """Texts of one word have the same neighbours, so the probabilities of all words of the corpus add up to 1, however they are found."""
    n = {f"w{i}": 1 + 600 // (i + 1) % 7 for i in range(700)}
    docs = documents(spark, [(i, w) for i, (w, k) in enumerate(n.items()) for _ in range(k)])
    for known in (0, 500, masked_lm.KNOWN):
        by = {g["doc_id"]: g["log_likelihood"] for g in masked_lm.score_documents(docs, known=known).collect()}
        assert len(by) == 700 and abs(sum(math.exp(x) for x in by.values()) - 1) < 1e-4
        own = {bytes(r["word"]).decode() for r in masked_lm.word_counts(docs).orderBy("n", "word").collect()[-masked_lm.sizes_for(700)[0] :]}
        same: dict[int, list[int]] = {}
        for i, w in enumerate(n):
            if w not in own and n[w] == 1:
                same.setdefault(zlib.crc32(w.encode()) % masked_lm.sizes_for(700)[1], []).append(i)
        assert all(abs(by[a[0]] - by[b]) < 1e-6 for a in same.values() for b in a)


def test_masked_lm_scores_are_those_of_a_plain_loop(spark):
    net = masked_lm.Net.new({b"a": 0, b"b": 1, b"c": 2}, seed=5)
    net.bias[:] = np.random.default_rng(4).normal(0, 1, len(net.bias))
    texts = [b"a b zz c a b", None, b"yy", b"c " * 40]
    ids, at, sizes = net.numbers(texts)
    got, size, beyond = net.log_probabilities(ids, at), *masked_lm.groups(net.words + net.classes)[:1], net.words + net.classes
    n, want = masked_lm.groups(beyond)[1], []
    of = masked_lm.Classes(net.vocabulary)
    for t in texts:
        own = [of[w] for w in words_of(t)]
        for i, token in enumerate(own):
            h = np.zeros(masked_lm.WIDTH)
            for k, o in enumerate(masked_lm.OFFSETS):
                h += net.places[own[i + o] if 0 <= i + o < len(own) else beyond][k * masked_lm.WIDTH : (k + 1) * masked_lm.WIDTH].astype(float)
            z = np.tanh(h) @ net.out.astype(float) + net.bias
            lo = lambda z, j: z[j] - math.log(np.exp(z).sum())
            want.append(lo(z[:n], token // size) + lo(z[n + token // size * size : min(n + (token // size + 1) * size, len(z))], token % size))
    assert np.allclose(got, want, atol=1e-4)


def test_masked_lm_gradients_are_those_of_differences():
    net = masked_lm.Net.new({b"a": 0, b"b": 1}, seed=1)
    ids, at, _ = net.numbers([b"a b a a zz b", b"b b a"])
    loss = lambda: -net.log_probabilities(ids, at).mean()
    start, squares = net.flat().copy(), [np.zeros_like(net.out), np.zeros_like(net.bias), np.zeros_like(net.places)]
    net.train(ids, at, squares, 0.1)
    slopes = np.concatenate([np.sqrt(squares[2]).ravel(), np.sqrt(squares[0]).ravel(), np.sqrt(squares[1])])
    for x in np.argsort(slopes)[-40::5]:
        around = []
        for d in (1e-2, -1e-2):
            flat = start.copy()
            flat[x] += d
            net = net.with_weights(flat)
            around.append(loss())
        assert abs(around[0] - around[1]) / 2e-2 == pytest.approx(slopes[x], rel=0.02, abs=1e-4)
    r = np.random.default_rng(0)
    near, rows = r.integers(0, 9, 300), r.normal(size=(300, 5)).astype(np.float32)
    which, g = masked_lm.summed(near, rows)
    assert which.tolist() == sorted(set(near.tolist())) and all(np.allclose(x, rows[near == k].sum(0), atol=1e-4) for k, x in zip(which, g, strict=True))


def test_masked_lm_covers_every_text_and_grows():
    rows = list(range(101))
    for cut in ([101], [40, 61], [1] * 101):  # batches of a partition
        seen, got = 0, [[] for _ in range(masked_lm.ROUNDS)]
        for n in cut:
            for turn in range(masked_lm.ROUNDS):
                got[turn] += rows[seen : seen + n][(turn - seen) % masked_lm.EVERY :: masked_lm.EVERY]
            seen += n
        assert sorted(sum(got, [])) == rows and got[0] == rows[0 :: masked_lm.EVERY]
    assert masked_lm.sizes_for(100) == (masked_lm.WORDS, masked_lm.CLASSES)
    assert masked_lm.sizes_for(4_000_000)[0] > 1.9 * masked_lm.sizes_for(1_000_000)[0]


# -- 7 -------------------------------------------------------------------------------------------------------------------------------------------------


def brute_groups(docs, similar=0.8):
    sets = {}
    for i, t in docs:
        w = words_of((t or "").encode())
        if w and i is not None:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    best = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]) - 1e-9]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(best[a], best[b])
            changed |= best[a] != m or best[b] != m
            best[a] = best[b] = m
    return best


def near_copies(words, seed=6):
    r = random.Random(seed)
    docs = [(i, " ".join(r.choices(words, k=r.randint(1, 120)))) for i in range(120)]
    for i in range(120, 200):
        w = docs[r.randrange(i)][1].split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice(words)
        docs.append((i, " ".join(w)))
    base = r.choices(words, k=150)
    for i in range(200, 280):  # a chain: each a little further from the first
        base[r.randrange(len(base))] = r.choice(words)
        docs.append((i, (" " if i % 2 else ", ").join(base)))
    return docs


@pytest.mark.parametrize("hot", [256, 1])
def test_near_duplicates_equal_brute_force(spark, words, monkeypatch, hot):
    monkeypatch.setattr(dartminhash, "HOT", hot)
    docs = near_copies(words)
    got = dartminhash.near_duplicates(documents(spark, [*docs, *ODD])).collect()
    want = brute_groups(docs)
    assert len(got) == len(docs) + len(ODD)
    assert all(g["component_id"] == want[g["doc_id"]] for g in got if g["doc_id"] in want)
    odd = [g for g in got if g["doc_id"] is None or g["doc_id"] >= 900]
    assert all(g["kept"] for g in odd) and {g["component_id"] for g in odd if g["doc_id"]} == {900, 901, 902, 903, 904}
    kept = dartminhash.keep_one(documents(spark, [*docs, *ODD]))
    assert kept.columns == [x.split()[0] for x in DOCS.split(", ")]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({*want.values(), 900, 901, 902, 903, 904})
    assert dartminhash.near_duplicates(documents(spark, [])).count() == 0


def test_an_id_on_several_texts_is_a_document_of_each(spark, words):
    a, b = words[:80], words[100:180]
    near = lambda t: " ".join([*t[:40], "zz", *t[41:]])
    docs = documents(spark, [(1, " ".join(a)), (9, " ".join(b)), (5, near(a)), (5, near(b)), (7, "two plain words"), (7, "and quite another text of its own"), (7, "two plain words")])
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in dartminhash.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (5, 1, False), (9, 5, False), (5, 5, True), (7, 7, True)}
    kept = sorted((r["doc_id"], r["text"]) for r in dartminhash.keep_one(docs).collect())
    assert kept == sorted([(1, " ".join(a)), (5, near(b)), (7, "two plain words"), (7, "and quite another text of its own")])
    same = documents(spark, [(3, " ".join(a)), (3, near(a)), (3, " ".join(b))])
    assert len(dartminhash.keep_one(same).collect()) == 2


def test_counts_weigh(spark, words):
    line = " ".join(words[:9])
    docs = documents(spark, [(1, f"{line} " * 10 + " ".join(words[20:30])), (2, f"{line} " * 2 + " ".join(words[20:30])), (3, f"{line} " * 9 + " ".join(words[20:30]))])
    groups = lambda w: {r["doc_id"]: r["component_id"] for r in dartminhash.near_duplicates(docs, weights=w).collect()}
    assert groups("set") == {1: 1, 2: 1, 3: 1} and groups("count") == {1: 1, 2: 2, 3: 1}


def test_one_text_near_to_very_many(spark, words, monkeypatch):
    monkeypatch.setattr(dartminhash, "HOT", 5)
    base = words[:100]
    docs = [(0, " ".join(base))] + [(i, " ".join([*base[:i], f"n{i}", *base[i + 1 :]])) for i in range(1, 90)]
    assert {r["component_id"] for r in dartminhash.near_duplicates(documents(spark, docs)).collect()} == {0}


def test_hot_keys_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(dartminhash, "HOT", 10)
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    values = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (7, "d"), (99, "e")], "k long, v string")
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = dartminhash.dealt(rows, values, "k", "x", sizes)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(values, "k").collect()))
    assert dartminhash.dealt(rows.limit(0), values, "k", "x", sizes.limit(0)).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(8)
    elements = r.integers(0, 2**63, 60).astype(np.uint64)
    a, b = r.uniform(0.2, 9, 60), r.uniform(0.2, 9, 60)
    a[:15], b[45:] = 0, 0
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    k, same = 256, []
    for seed in range(12):
        doc = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        s = dartminhash.signatures(doc, np.concatenate([elements[a > 0], elements[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, k, seed)
        same.append((s[0] == s[1]).mean())
    assert abs(np.mean(same) - want) < 4 * math.sqrt(want * (1 - want) / (k * 12))
    alone = dartminhash.signatures(np.zeros(1, int), elements[:1], np.array([0.001]), 1, 140)
    assert (alone != 0).all()


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(50)} == {1000} and len(got) == 111
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- 9 ---------------------------------------------------------------------------------------------------------------------------------------------------


def brute_licences(text):
    w = [x.decode() for x in words_of((text or "").encode())]
    base = sorted((i, name) for p, name in license_join.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    hits: dict[tuple, set] = {}
    for label, texts in license_join.TEMPLATES.items():
        for t in texts:
            tokens = set(t.split())
            if len(tokens & set(w)) < license_join.needed(len(tokens), 0.8):
                continue
            for i in range(len(w)):
                n = len(tokens & set(w[i : i + license_join.width(t)])) if w[i] in tokens else 0
                if n >= license_join.needed(len(tokens), 0.8):
                    hits.setdefault((i // license_join.STRIDE, license_join.FAMILIES.get(label, label)), set()).add((n / len(tokens), len(tokens), label))
    best = [h for own in hits.values() for h in own if h[:2] == max(own)[:2]]
    labels = {n for _, n in base} | {h[2] for h in best}
    return len(w), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({n for _, n in base})), ",".join(sorted(labels)), 1.0 if base else max((h[0] for h in best), default=0.0)


def test_licences_equal_brute_force(spark, words):
    r = random.Random(7)
    every = [t for own in license_join.TEMPLATES.values() for t in own]
    docs = [(i, None) for i in range(2)] + [(2, "MIT License mit license, MIT-license"), (3, "The GNU\nGeneral Public\nLicense"), (4, "É mit licenses summit license"), (5, "mit license"), (6, "CC BY cc-by")]
    for i in range(10, 90):
        lines = []
        for _ in range(r.randint(1, 6)):
            w = r.choices(words, k=r.randint(0, 12))
            if r.random() < 0.6:
                own = r.choice(every).split()
                for _ in range(r.randint(0, 4)):
                    own.pop(r.randrange(len(own))) if len(own) > 2 else None
                w[r.randint(0, len(w)) : 0] = own
            lines.append(" ".join(w).title() if i % 3 else ", ".join(w))
        docs.append((i, "\n".join(lines)))
    docs.append((95, "filler text " * 30_000 + "\nAll rights reserved.\n" + "x " * 1000 + "apache license"))
    got = license_join.scan(documents(spark, [*docs, *ODD])).collect()
    assert len(got) == len(docs) + len(ODD)
    texts = dict([*docs, *ODD])
    for g in got:
        assert tuple(g[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")) == brute_licences(texts[g["doc_id"]])[:6]
        assert abs(g["score"] - brute_licences(texts[g["doc_id"]])[6]) < 1e-12
    assert license_join.scan(documents(spark, [])).count() == 0


def test_licences_in_wrapped_and_in_long_lines(spark):
    mit = "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files"
    bsd = "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public\nLicense"
    apart = " ".join(f"{w} {'filler ' * 300}" for w in license_join.TEMPLATES["mit"][1].split())
    mit = license_join.TEMPLATES["mit"][1].title().replace("A Copy ", "A Copy\n# ").replace("Merge ", "Merge,\n * ")
    gpl += " as published by the Free Software Foundation"
    docs = [(1, f"{'word ' * 500}{mit}{' word' * 500}"), (2, bsd), (3, gpl), (4, apart), (5, f"{'filler ' * 900}{mit} {'filler ' * 900}".replace("\n", " ")), (6, "all\nrights\n\nreserved")]
    by = {g["doc_id"]: (g["labels"], g["score"]) for g in license_join.scan(documents(spark, docs)).collect()}
    assert by == {1: ("mit", 1.0), 2: ("bsd", 1.0), 3: ("gpl", 1.0), 4: ("", 0.0), 5: ("mit", 1.0), 6: ("reserved", 1.0)}
    cc = [(1, "Licensed under CC BY 4.0."), (2, "Licensed under CC BY-NC 4.0."), (3, "This work is licensed under a Creative Commons Attribution 4.0 International License"), (4, "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0\nInternational License"), (5, "Released under the Apache License"), (6, "license " * 50_000 + "mit")]
    assert {g["doc_id"]: g["labels"] for g in license_join.scan(documents(spark, cc)).collect()} == {1: "cc-by", 2: "cc-by,cc-by-nc", 3: "cc-by", 4: "cc-by-nc", 5: "apache", 6: ""}


def test_licence_plan_has_no_python(spark, words):
    plan = license_join.scan(documents(spark, [(1, "mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- 10 ----------------------------------------------------------------------------------------------------------------------------------------------------


def brute_vectors(rows, similar=0.95):
    ok = {k: np.array(v, float) / np.linalg.norm(np.array(v, float)) for k, (_, v) in enumerate(rows) if v is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(v)}
    links = {k: [j for j, y in ok.items() if j != k and len(x) == len(y) and x @ y >= similar] for k, x in ok.items()}
    of = {k: rows[k][0] for k in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for k, near in links.items():
            for j in near:
                if of[j] < of[k]:
                    of[k], changed = of[j], True
    return sorted((rows[k][0], len(links.get(k, [])), of[k]) for k in range(len(rows)))


@pytest.mark.parametrize("kind,pivots,block,sides", [("float", (1,), 4096, 200), ("float", (8,), 20, 200), ("double", (1, 4), 16, 200), ("double", (1,), 4, 2), ("float", (3,), 3, 4)])
def test_vectors_equal_brute_force(spark, kind, pivots, block, sides):
    r = np.random.default_rng(3)
    centres = r.normal(size=(9, 6))
    rows = [(i, (centres[i % 9] + r.normal(0, 0.25, 6)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(150 + i, rows[i][1]) for i in range(20)] + [(180 + i, (3 * r.normal(size=4)).astype(np.float32).tolist()) for i in range(10)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6), (205, [float("inf")] + [0.0] * 5), (206, [1e-30] * 6), (207, [2e-30] * 6)]
    df = spark.createDataFrame([(i, v, i % 3, 1) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, label int, n_links int").repartition(4)
    got = vector_dedup.near_duplicates(df, pivots=pivots, block=block, sides=sides).collect()
    assert sorted((g["vec_id"], g["n_links"], g["component_id"]) for g in got) == brute_vectors(rows)
    assert all(g["kept"] == (g["vec_id"] == g["component_id"]) for g in got)


def test_vectors_of_empty_tables_and_bounds(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vector_dedup.near_duplicates(empty).count() == 0
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, lost = vector_dedup.quantised(x)
    assert (np.linalg.norm(x - q * s[:, None], axis=1) <= lost).all() and lost.max() < 0.03
    x = np.vstack([x, x[:50] + r.normal(0, 0.03, (50, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for similar in (0.1, 0.3, 0.95):
        pairs = [p for i, j in vector_dedup.linked(x, x, similar) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert sorted(pairs) == sorted(zip(*map(np.ndarray.tolist, np.nonzero(np.einsum("ik,jk->ij", x, x) >= similar)), strict=True))


@pytest.mark.parametrize("pivots,block", [((1,), 4096), ((3,), 2)])
def test_vectors_at_exactly_the_threshold(spark, pivots, block):
    """(19, 6, 1, 1, 1) has length 20, so its cosine with an axis is 19/20, which links; a little less doesn't."""
    at, below, above = [19.0, 6, 1, 1, 1], [19.0, 6, 1, 1, 1.001], [19.0, 6, 1, 1, 0.999]
    rows = [(1, [1.0, 0, 0, 0, 0]), (2, at), (3, [0.0, 1, 0, 0, 0]), (4, [below[i] for i in (1, 0, 2, 3, 4)]), (5, [0.0, 0, 1, 0, 0]), (6, [above[i] for i in (1, 2, 0, 3, 4)])]
    rows += [(7, [-1.0, 0, 0, 0, 0]), (8, [0.0, 0, 0, 8, 0]), (9, [2 * at[i] for i in (1, 2, 3, 0, 4)])]
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], "vec_id bigint, embedding array<double>").repartition(3)
    got = sorted((g["vec_id"], g["n_links"], g["component_id"]) for g in vector_dedup.near_duplicates(df, pivots=pivots, block=block).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, 1, 5), (7, 0, 7), (8, 1, 8), (9, 1, 8)]


def test_components_of_a_tile():
    r = np.random.default_rng(2)
    chain = np.eye(300, dtype=bool) | np.eye(300, k=1, dtype=bool)
    assert set(vector_dedup.spread(chain)) == {0}
    for _ in range(20):
        link = r.random((30, 40)) < 0.03
        got, want = vector_dedup.spread(link), np.arange(70)
        for _ in range(70):
            for i, j in zip(*np.nonzero(link), strict=True):
                want[i] = want[30 + j] = min(want[i], want[30 + j])
        assert (got == want).all()


def test_copies_of_a_vector_are_one_class(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(500 + i, [1.0, 2.0, 3.0 + 0.01 * i]) for i in range(1, 4)] + [(900, [-1.0, 0.0, 0.0])]
    got = {g["vec_id"]: (g["n_links"], g["component_id"]) for g in vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)).collect()}
    assert got.pop(900) == (0, 900) and set(got.values()) == {(502, 0)} and len(got) == 503


# -- all ---------------------------------------------------------------------------------------------------------------------------------------------------


def test_empty_documents(spark):
    none = documents(spark, [])
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert bpe.encode_documents(none).count() == 0
    for operator in (toxicity, quality):
        assert operator.score_documents(none, labels).count() == 0


def test_labels_and_benchmarks_with_clashing_columns(spark, words):
    docs, labels = labelled(spark, words, 200)
    more = ["'x' as text", "'y' as label", "1 as score", "2 as held_out", "'z' as folded", "3 as doc"]
    for operator in (toxicity, quality):
        a, b = (rows_of(operator.score_documents(docs, x), ["doc_id"]) for x in (labels, labels.selectExpr("*", *more)))
        assert all(math.isclose(x["score"], y["score"], abs_tol=1e-9) for x, y in zip(a, b, strict=True))
    bench = spark.createDataFrame([(1, " ".join(words[:20]))], "item_id bigint, text string")
    docs = documents(spark, [(1, " ".join(words[:25]))])
    got = decontaminate.report(docs, bench.selectExpr("*", "'i' as i", "0 as block", "'h' as hits", "5 as doc_id")).first()
    assert (got["n_hit"], got["n_items"], got["longest_match"]) == (20, 1, 20)
