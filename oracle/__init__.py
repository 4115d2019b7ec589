"""Independent SQL answers for the registered queries (run by DuckDB)."""

from oracle.statements import ORACLE

__all__ = ["ORACLE"]
