"""All registered queries, by name."""

from __future__ import annotations

from checks import cleaning_queries, feature_queries, learning_queries, report_queries, wider_queries
from checks.spec import Check

CHECKS: dict[str, Check] = {
    **feature_queries.CHECKS,
    **cleaning_queries.CHECKS,
    **report_queries.CHECKS,
    **learning_queries.CHECKS,
    **wider_queries.CHECKS,
}
