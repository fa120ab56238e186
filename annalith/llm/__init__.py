"""Operators for text corpora and record fusion; nothing outside this subpackage imports it."""
