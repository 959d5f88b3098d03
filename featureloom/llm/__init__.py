"""Operators of a training-data pipeline (tokenise, dedup, scan, classify, search).

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and their SQL.
"""
