"""Yieldmill: manufacturing-lakehouse operators written for PySpark.

Every operator takes DataFrames and returns DataFrames.  The plant, the load
window and the as-of time are arguments, so the daily run, the rerun, the
back-fill and the stream share one code path.
"""

from yieldmill.session import build_session, shared_folder

__all__ = ["build_session", "shared_folder"]
