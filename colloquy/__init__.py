"""Dialogue corpora on Spark: prepare, mix, tokenize, prompt and post-process."""
