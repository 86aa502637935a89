"""The engine's operators on the star-schema test tables, with SQL to compare against."""

from tripledger.workload.oracle import oracle_sql
from tripledger.workload.catalog import queries

__all__ = ["oracle_sql", "queries"]
