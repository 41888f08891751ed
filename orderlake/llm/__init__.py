"""Training-data operators: tokens, search, sharding, near-duplicates, filters, packing.

Nothing outside this package imports it. Each module holds one operator; every
operator takes DataFrames with named columns, drops nothing silently and states
in its docstring what nulls, empty and very long texts, ties and repeated rows
give. ``queries`` registers the ``opN_*`` queries.
"""
