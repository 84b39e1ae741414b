"""Operators of a training-data pipeline: search, filtering, deduplication, packing, archives.

Nothing outside this subpackage imports it.  Each module holds one operator with
a general interface; ``queries`` registers the thin ``opN_*`` queries over the
driver's tables.
"""
