"""Lakemart: lakehouse analytics operators on the Spark DataFrame API.

Layers: ``sources`` (ingest / sinks / audit), ``functions`` (column
expressions), ``operators`` (conform, relational, ranking, time series,
sales, leads, transit, quality, merge, star), ``plans`` (the registered
queries over the driver tables) and ``streaming`` (nothing: the workload
is batch only).
"""

from lakemart.session import get_session, checkpoint_dir, scratch_path

__all__ = ["get_session", "checkpoint_dir", "scratch_path"]
