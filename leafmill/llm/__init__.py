"""Operators for training data: one module per problem, queries and SQL in `queries`.

Nothing outside this subpackage imports it.
"""
