"""wayspan: travel-time analytics over route readings, as lazy Spark DataFrames."""

from wayspan.session import build_session

__all__ = ["build_session"]
