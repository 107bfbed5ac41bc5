"""Training-data operators. ``queries()`` and ``oracle_sql()`` hand them to the driver contract."""

from riskloom.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
