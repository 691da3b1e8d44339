"""The pipeline against a plain version: its classifiers' own predictions, then brute force over what is left."""

import hashlib

import corpus_pipeline
from tallyforge.llm import bpe, quality, toxicity

from .test_operators import ODD, brute_groups, brute_hits, documents, labelled, near_copies, words  # noqa: F401


def test_pipeline_equals_a_plain_version(spark, words, tmp_path):  # noqa: F811
    docs, labels = labelled(spark, words, 500)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    extra = [(2000 + i, t) for i, t in near_copies(words)]
    item = " ".join(words[100:140])
    extra += [(3000, "before " + item + " after"), (3001, " ".join(words[200:260])), (3002, item[:60])]
    docs = docs.unionByName(documents(spark, extra))
    rows |= dict(extra)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, item), (2, "and none of this one here")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    clean = {r["doc_id"] for r in toxicity.score_documents(docs, labels).where("predicted = 0").collect()}
    left = docs.where(docs["doc_id"].isin([i for i in clean if i is not None]) | docs["doc_id"].isNull())
    good = {r["doc_id"] for r in quality.score_documents(left, labels).where("predicted = 1").collect()}
    of = brute_groups([(i, rows[i]) for i in good])
    kept = {i for i in good if of.get(i, i) == i}
    pure = set()
    for i in kept:
        n, hit, _ = brute_hits(rows[i], items)
        if not (hit and 20 * hit >= n):
            pure.add(i)
    assert 3000 not in pure and 3001 in pure and len(pure) < len(kept) < len(good) < len(clean) < len(rows)

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted(pure, key=str)
    e = bpe.Encoder(bpe.default_path())
    for r in got:
        assert r["token_ids"] == e.encode(rows[r["doc_id"]]) and r["n_tokens"] == len(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(e.decode(r["token_ids"]).encode()).hexdigest()


def test_stages_keep_the_columns(spark, words, tmp_path):  # noqa: F811
    docs = documents(spark, ODD)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).count() == len(ODD) - 1
    assert corpus_pipeline.encode(spark, docs, str(tmp_path)).count() == len(ODD)


def test_quality_stage_keeps_all_without_labels_to_learn_from(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "doc_id bigint, text string")
    for name, rows in (("none", []), ("poor", [(i, 0, 0) for i in range(20)]), ("good", [(i, 1, 0) for i in range(20)])):
        spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.drop_poor(spark, docs, f"{tmp_path}/{name}").count() == 20


def test_pipeline_of_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
