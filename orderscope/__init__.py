"""orderscope: retail order analytics as plain Spark DataFrame jobs.

Raw orders are cleaned (mean and constant null fill, validity filter,
derived columns), summarised into five grouped reports with exact-decimal
money, and served as parameterised questions and chart-ready tables. A
hash-based generator produces order rows in the reference domains at any
scale, and chat transcripts are assembled per conversation.
"""

from orderscope.session import get_session

__all__ = ["get_session"]
