"""Operators for preparing training text: deduplication, scoring, filtering, encoding.

Nothing outside this folder imports it; ``parquill.llm.queries`` lists its queries.
"""
