"""Operators for training-data pipelines (extraction, search, near-dedup, classifiers, PII, mixing,
packing, chat formatting). Nothing else in the library imports this subpackage."""
