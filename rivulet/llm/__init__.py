"""Operators for preparing text corpora: dedup, classifiers, language, packing, mixing, scans, rules."""
