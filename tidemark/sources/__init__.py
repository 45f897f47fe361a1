"""Where rows come from: files, tables, JDBC and warehouse connectors."""

from tidemark.sources.incremental import incremental_scan
from tidemark.sources.tables import (
    mod_predicates,
    preview,
    read_connector,
    read_files,
    read_jdbc,
    split_bounds,
)

__all__ = [
    "incremental_scan",
    "mod_predicates",
    "preview",
    "read_connector",
    "read_files",
    "read_jdbc",
    "split_bounds",
]
