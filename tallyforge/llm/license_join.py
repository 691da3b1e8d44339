"""Operator 9: licence scan by an exact set-similarity join, in DataFrame functions alone.

Documents are joined with notices (TEMPLATES). A text block is as many consecutive words as a notice has and a quarter more, wherever lines
break; it is one of a notice if it holds `need` of the notice's distinct tokens at least: SHARE of them, or all where the notice has fewer
than SHORT, as one word makes a short notice another. Tokens are ordered by how many documents hold them, rarest first, counted over all
documents. The join:

- a document's words are cut into stretches of STRIDE words, each with the words that a block beginning in it can reach; stretches that
  hold a token of some prefix are exploded, and then those tokens;
- prefix: a block that lacks none too many of a notice's m tokens holds one of its first m - need + 1 in that order, so stretches are
  joined with notices on prefix tokens alone (a broadcast hash join: notices are a fixed table of this file, a row for each prefix token);
- length: the stretch has `need` distinct words at least;
- position: if the joined token, the p-th of the notice, is the first that a block shares, then only tokens from p on can be shared;
  those of them that the stretch has must be `need` at least;
- what is left is verified: each block that begins in the stretch with a token of the notice (no other holds more).

Of rival notices (a family: those of one licence and its variants) the one that a stretch's blocks hold the largest share of counts, of
equal shares the longest: the text of a variant holds most of the plain licence's words. Besides, base phrases are counted where their words
stand consecutively.

Rows of one document meet again by a row number made before the explode; what is shuffled for that is a short row for each document and hit,
never its words.

Defined cases: null is the empty text; documents without words have no places, no labels and score 0; repeated rows give repeated rows;
the text is read whole, whatever its length; extra columns are not looked at.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE, SHORT = 0.8, 10
STRIDE = 512

#: Phrases and their labels, of the contract. Fixed values.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices by label. The words of well-known licence texts and notices, in lower case without signs.
TEMPLATES = {
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        "you should have received a copy of the gnu general public license along with this program",
    ],
    "lgpl": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        "you should have received a copy of the gnu lesser general public license along with this library",
    ],
    "agpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        "you should have received a copy of the gnu affero general public license along with this program",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution license", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc-by-nc-sa": ["licensed under cc by nc sa 4 0", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"],
    "zlib": ["this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"],
    "reserved": ["all rights reserved"],
}
#: Labels of rival notices. Fixed values.
FAMILIES = {"gpl": "gnu", "lgpl": "gnu", "agpl": "gnu"} | {x: "cc" for x in TEMPLATES if x.startswith("cc-by")}

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def needed(tokens: int, share: float) -> int:
    """Tokens that a block must share with a notice of so many."""
    return tokens if tokens < SHORT else -int(-(share * tokens - 1e-9) // 1)


def width(text: str) -> int:
    """Words of a block of a notice."""
    return -(-5 * len(text.split()) // 4)


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL)


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, norm: the text's words in small letters with a space before, between and after)."""
    return docs.select("doc_id", F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered(F.col("text")), BETWEEN, " ")), F.lit(" ")).alias("norm"))


def token_order(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(token, n): documents that hold each token of the vocabulary, over all documents; a row for every token."""
    spark = docs.sparkSession
    held = F.array_intersect(F.split(F.trim("norm"), " "), F.array(*map(F.lit, vocabulary)))
    counted = prepared(docs).select(F.explode(held).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    all_ = spark.createDataFrame([(w,) for w in vocabulary], "token string")
    return all_.join(F.broadcast(counted), "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(spark, order: list[tuple[str, int]], share: float, notices: dict[str, list[str]]) -> DataFrame:
    """(token, p, label, family, tokens: rarest first, m, need, width): a row for each token of each notice's prefix."""
    place = {w: i for i, (w, _) in enumerate(sorted(order, key=lambda x: (x[1], x[0])))}
    rows = []
    for label, texts in notices.items():
        for text in texts:
            tokens = sorted(set(text.split()), key=place.__getitem__)
            need = needed(len(tokens), share)
            rows += [(tokens[p], p, label, FAMILIES.get(label, label), tokens, len(tokens), need, width(text)) for p in range(len(tokens) - need + 1)]
    return spark.createDataFrame(rows, "token string, p int, label string, family string, tokens array<string>, m int, need int, width int")


def any_of(words: list[str]) -> str:
    """A pattern for some words, by their first letters."""
    return "|".join(f"{a}(?:{'|'.join(w[1:] for w in own)})" for a, own in groupby(sorted(words), key=lambda w: w[0]))


def candidates(rows: DataFrame, joined: DataFrame, first: list[str], reach: int) -> DataFrame:
    """rows (with `norm`, which goes) joined with notices: a row for each stretch, prefix token in it and notice that passes the filters, with the
    columns block, words, and those of the notice; one row with nulls where there is none."""
    some = F.array(*map(F.lit, first))
    words = F.when(F.col("norm").rlike(f" (?:{any_of(first)}) "), F.split(F.trim("norm"), " ")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("words", words).drop("norm")
    starts = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1, F.lit(STRIDE))).otherwise(F.array().cast("array<int>"))
    cut = F.transform(starts, lambda a: F.struct(a.alias("block"), F.slice("words", a + 1, STRIDE + reach - 1).alias("words")))
    held = F.filter(cut, lambda c: F.arrays_overlap(c["words"], some))
    rows = rows.withColumn("cut", F.explode_outer(held)).drop("words").select("*", "cut.block", "cut.words").drop("cut")
    rows = rows.withColumn("token", F.explode_outer(F.array_intersect("words", some)))
    rows = rows.join(F.broadcast(joined), "token", "left")
    length = F.size(F.array_distinct("words")) >= F.col("need")
    position = F.size(F.array_intersect(F.expr("slice(tokens, p + 1, m)"), "words")) >= F.col("need")
    return rows.withColumn("passed", F.coalesce(length & position, F.lit(False)))


def best_share() -> Column:
    """The largest share of a notice that a block beginning in the stretch holds."""
    begins = F.filter(F.sequence(F.lit(1), F.least(F.size("words"), F.lit(STRIDE))), lambda j: F.array_contains("tokens", F.element_at("words", j)))
    shared = F.array_max(F.transform(begins, lambda j: F.size(F.array_intersect("tokens", F.slice("words", j, F.col("width"))))))
    return F.when(F.col("passed") & (shared >= F.col("need")), shared / F.col("m").cast("double"))


def scan(docs: DataFrame, share: float = SHARE, notices: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each document.

    score is the largest share of a notice that a block holds, or 1 where there is a base phrase."""
    spark = docs.sparkSession
    vocabulary = sorted({w for own in notices.values() for t in own for w in t.split()})
    order = [(r["token"], r["n"]) for r in token_order(docs, vocabulary).collect()]  # a row for each token of the notices
    joined = prefixes(spark, order, share, notices)
    first = sorted(r[0] for r in joined.select("token").distinct().collect())
    phrase = f"(?<= )(?:{'|'.join(PHRASES)})(?= )"
    words_before = lambda s: (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("bigint")
    rows = prepared(docs).withColumn("n_base", F.regexp_count("norm", F.lit(phrase)).cast("bigint"))
    some = F.col("n_base") > 0
    named = F.array(*[F.when(F.contains("norm", F.lit(f" {p} ")), F.lit(name)) for p, name in sorted(PHRASES.items(), key=lambda x: x[1])])
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.when(F.col("norm") == "  ", F.lit(0)).otherwise(words_before(F.col("norm")) - 1).cast("bigint").alias("n_words"),
        "n_base",
        F.when(some, words_before(F.regexp_extract("norm", f"(?s)^(.*?){phrase}", 1)) - 1).alias("first_word"),
        F.when(some, words_before(F.regexp_extract("norm", f"(?s)^(.*){phrase}", 1)) - 1).alias("last_word"),
        F.when(some, F.array_compact(named)).otherwise(F.array().cast("array<string>")).alias("base"),
        "norm",
    )
    own = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    found = candidates(rows, joined, first, max(width(t) for texts in notices.values() for t in texts))
    found = found.select(*own, "block", "family", "label", "m", best_share().alias("share"))
    hit = F.when(F.col("share").isNotNull(), F.struct("family", "label", "share", "m"))
    # by document at once, so that neither grouping moves rows again
    blocks = found.repartition("row").groupBy(*own, "block").agg(F.collect_set(hit).alias("hits"))
    nearest = F.filter("hits", lambda h: ~F.exists("hits", lambda g: (g["family"] == h["family"]) & ((g["share"] > h["share"]) | ((g["share"] == h["share"]) & (g["m"] > h["m"])))))
    out = blocks.select(*own, nearest.alias("hits")).groupBy(*own).agg(F.array_distinct(F.flatten(F.collect_list(F.transform("hits", lambda h: h["label"])))).alias("more"), F.max(F.array_max(F.transform("hits", lambda h: h["share"]))).alias("share"))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.when(some, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def oracle(share: float = SHARE, notices: dict[str, list[str]] = TEMPLATES) -> str:
    """The same rows by comparing every block that begins with a word of a notice with that notice."""
    texts = [(label, t) for label, own in notices.items() for t in own]
    rows = ", ".join(f"({i}, '{label}', '{FAMILIES.get(label, label)}', {len(set(t.split()))}, {needed(len(set(t.split())), share)}, {width(t)})" for i, (label, t) in enumerate(texts))
    tokens = ", ".join(f"({i}, '{w}')" for i, (_, t) in enumerate(texts) for w in sorted(set(t.split())))
    phrases = ", ".join(f"('{name}', {p.split()})" for p, name in PHRASES.items())
    words = r"regexp_extract_all(translate(coalesce(text, ''), '" + CAPITALS + "', '" + SMALL + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH t(id, label, family, m, need, width) AS (VALUES {rows}), tt(id, x) AS (VALUES {tokens}), p(label, w) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS k, doc_id, {words} AS w FROM documents),
base AS (SELECT k, label, i - 1 AS pos FROM d, p, LATERAL (SELECT unnest(range(1, len(d.w) - len(p.w) + 2)) AS i) WHERE len(d.w) >= len(p.w) AND d.w[i] = p.w[1] AND list_slice(d.w, i, i + len(p.w) - 1) = p.w),
word AS (SELECT k, unnest(range(0, len(w))) AS i, unnest(w) AS x FROM d),
occ AS (SELECT k, id, i, x FROM word JOIN tt USING (x)),
few AS (SELECT k, id FROM occ JOIN t USING (id) GROUP BY k, id, need HAVING count(DISTINCT x) >= need),
near AS (SELECT k, id, i, x FROM occ SEMI JOIN few USING (k, id)),
win AS (SELECT a.k, a.id, a.i, count(DISTINCT b.x) AS n FROM near a JOIN t ON t.id = a.id JOIN near b ON a.k = b.k AND a.id = b.id AND b.i >= a.i AND b.i < a.i + t.width GROUP BY a.k, a.id, a.i),
hit AS (SELECT k, label, family, m, i // {STRIDE} AS block, CAST(n AS DOUBLE) / m AS share FROM win JOIN t USING (id) WHERE n >= need),
best AS (SELECT k, label, share FROM (SELECT *, rank() OVER (PARTITION BY k, block, family ORDER BY share DESC, m DESC) AS r FROM hit) WHERE r = 1),
b AS (SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM base GROUP BY k),
every AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS l, max(share) AS s FROM (SELECT k, label, 1.0 AS share FROM base UNION ALL SELECT k, label, share FROM best) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
  coalesce(b.l, '') AS base_labels, coalesce(every.l, '') AS labels, CAST(coalesce(every.s, 0.0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (k) LEFT JOIN every USING (k)
"""
