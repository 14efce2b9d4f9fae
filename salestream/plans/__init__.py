"""Ready-made queries over the given tables, and the same answers in plain SQL."""

from salestream.plans.catalogue import QUERIES
from salestream.plans.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
