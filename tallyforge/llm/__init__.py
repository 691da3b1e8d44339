"""Operators for large text corpora: tokens, contamination, toxicity, derivatives, languages, likelihoods, duplicates, quality, licences, vectors."""
