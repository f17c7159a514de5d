"""Operators for preparing training data at scale: sharding, URL filters, quality scores, fingerprints, token files,
vector search, packing, near-duplicate joins, subword regularization and removal of repeated passages."""
