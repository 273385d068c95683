"""Training-data operators: language ID, mixing, deduplication, search, scoring, scanning, packing.

Nothing outside this folder imports it, so it can be removed without loss to the rest.
"""
