"""Sources and sinks: schemas, loader (S1), views, writes and versioned publishing."""

from stockpulse.sources.io import (
    SOURCE_SCHEMAS,
    conform,
    load_tables,
    normalize_name,
    register_views,
    write_outputs,
)

from stockpulse.sources.publish import publish, read_published, register_published

__all__ = ["SOURCE_SCHEMAS", "conform", "load_tables", "normalize_name", "publish", "read_published",
           "register_published", "register_views", "write_outputs"]
