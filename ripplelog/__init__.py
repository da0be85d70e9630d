"""Change-event pipeline and analytics written as Spark DataFrame and stream operators."""

from ripplelog.session import configure, session, workspace

__all__ = ["configure", "session", "workspace"]
