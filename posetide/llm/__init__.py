"""Training-data operators: quality rules, fingerprints, scoring, packing,
URL filters, sub-word encoding, sharding, secret scans, near-duplicate and
repeated-passage removal.

Nothing else in the library imports this subpackage.
"""
