"""Training-data operators: ten whole-table operators and their queries.

Nothing else in the library imports this subpackage.
"""
