"""Training-data operators: quality rules, URL filters, token counts, binary
token files, mixing, near and exact dedup, packing.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing else in the package imports this subpackage.
"""
