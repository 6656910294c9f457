"""paytide: payments analytics written as Spark DataFrame and Structured Streaming jobs."""

from paytide.session import build_session, prepare, workspace

__all__ = ["build_session", "prepare", "workspace"]
