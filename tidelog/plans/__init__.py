"""Every registered query of the change-log engine."""

from tidelog.plans import capture_queries, decode_queries, doctor_queries, render_queries, replay_queries, state_queries, transaction_queries, type_queries  # noqa: F401
from tidelog.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
