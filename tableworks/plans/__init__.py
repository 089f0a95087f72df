"""Registered queries over the test tables, their oracle SQL, and plan checks."""

from tableworks.plans.workloads import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
