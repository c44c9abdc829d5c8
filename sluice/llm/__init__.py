"""Operators that prepare text corpora for language models; nothing outside this package imports it."""
