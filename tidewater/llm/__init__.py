"""Training-data operators: packing, token counts, decontamination, quality
rules, substring dedup, sharding, secret scans, language-model scores,
toxicity scores and near-duplicate classes.

Nothing else in the library imports this subpackage.
"""
