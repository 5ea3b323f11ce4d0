"""Operators for training-data pipelines: near duplicates, classifiers, tokens, shards, packing, archives, search."""
