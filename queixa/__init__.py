"""Complaint analytics as plain Spark DataFrame programs."""

from queixa.session import build_session

__all__ = ["build_session"]
