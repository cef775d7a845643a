"""fieldmark: point-in-time policy-risk analytics as plain Spark jobs."""

from fieldmark.session import get_session

__all__ = ["get_session"]
