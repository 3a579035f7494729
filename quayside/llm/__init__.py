"""Operators for preparing large text corpora: packing, link graphs, archives, models, near copies."""
