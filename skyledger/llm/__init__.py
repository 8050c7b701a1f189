"""Operators for large text corpora, as a large training-data pipeline needs them.

Nothing outside this folder imports it; ``skyledger.llm.queries`` holds the registered queries.
"""
