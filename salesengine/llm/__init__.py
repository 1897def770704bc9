"""Training-data operators on Spark: fingerprints, archives, filters, formatting, scoring, packing.

Each module is one operator with a general interface; ``queries`` holds the thin
registered queries over the given tables. Nothing outside this subpackage imports it.
"""
