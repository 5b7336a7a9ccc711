"""Training-data operators: filters, counts, near-duplicate joins, packing.

Nothing outside this subpackage imports it.  ``queries.py`` holds the
registered queries and their oracle SQL; every other module is one operator
with its own general interface.
"""
