"""Spark-native operators and ready plans for layered tables and streams."""

from strata.session import build_session, run_folder, streaming_session

__all__ = ["build_session", "run_folder", "streaming_session"]
