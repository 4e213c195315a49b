"""Operators of a large-scale training-data pipeline (text and vectors).

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries, one module per operator holds the operator itself.
"""
