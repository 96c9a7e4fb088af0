"""Operators of a training-data pipeline (one module each).

Nothing outside this subpackage imports it; ``queries.py`` registers the
``opN_`` queries and their SQL twins.
"""
