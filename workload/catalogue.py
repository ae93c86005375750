"""All registered queries."""

from workload import q_assertions, q_columns, q_profiles, q_reconcile, q_suites, q_tables  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
