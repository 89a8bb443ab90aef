"""Operators of a training-data pipeline, their queries and their oracle SQL.

Nothing outside this subpackage imports it.
"""
