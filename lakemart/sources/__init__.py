"""Ingestion, sinks and load metadata."""

from lakemart.sources.files import append_layer, preview, read_bronze_csv, register_views, write_layer
from lakemart.sources.metadata import load_audit, with_load_metadata

__all__ = ["append_layer", "preview", "read_bronze_csv", "register_views", "write_layer",
           "load_audit", "with_load_metadata"]
