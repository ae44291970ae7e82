"""Every operator as a query over the given tables, with its SQL counterpart."""

from ontime.queries import learning, tables
from ontime.queries.oracle import ORACLE

QUERIES = {**tables.QUERIES, **learning.QUERIES}

__all__ = ["ORACLE", "QUERIES"]
