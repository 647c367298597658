"""Spark-native data work around tabular machine learning."""

from tablewright.session import build_session

__all__ = ["build_session"]
