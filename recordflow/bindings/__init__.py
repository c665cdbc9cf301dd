"""The operators bound to the driver's test tables, each with its reference SQL.

Every query reads the whole tables it names. ``sql`` is plain SQL over the same
tables for an independent engine; it is absent where SQL cannot say the same.
"""

from recordflow.bindings.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
