"""One query for each operator, over its whole table with production parameters, and the SQL that gives the same rows where there is any."""

from __future__ import annotations

from . import bpe, dartminhash, decontaminate, language_id, license_join, line_runs, masked_lm, phrases, quality, token_alignment, toxicity, vector_dedup, warc
from .shared import table


def op1_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark, sf_dir):
    return warc.report(table(spark, sf_dir, "pages"))


def op5_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_masked_lm(spark, sf_dir):
    return masked_lm.score_documents(table(spark, sf_dir, "documents"))


def op7_dartminhash(spark, sf_dir):
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_join(spark, sf_dir):
    return license_join.scan(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark, sf_dir):
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_line_dedup(spark, sf_dir):
    return line_runs.report(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    return token_alignment.report(table(spark, sf_dir, "documents"))


def op13_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_decontamination, op3_toxicity, op4_warc, op5_language_id, op6_masked_lm, op7_dartminhash, op8_quality, op9_license_join, op10_vector_dedup, op11_line_dedup, op12_token_alignment, op13_phrases,
    )
}
ORACLES = {"op2_decontamination": decontaminate.ORACLE, "op7_dartminhash": dartminhash.ORACLE, "op9_license_join": license_join.oracle(), "op10_vector_dedup": vector_dedup.ORACLE, "op11_line_dedup": line_runs.ORACLE, "op13_phrases": phrases.ORACLE}
