"""DataFrame-to-DataFrame operators of a sync: compare, align, check, deduplicate, upsert."""

from tidemark.operators.changes import change_feed, deleted_keys, soft_delete
from tidemark.operators.quality import dq_profile, high_water_mark, repeated_keys, require_unique_keys
from tidemark.operators.schema import (
    add_columns,
    conform,
    diff_schemas,
    evolve_schema,
    schema_drift,
    type_drift_profile,
)
from tidemark.operators.upsert import changed_rows, dedupe_latest, inserted_rows, matched_keys, matched_rows, upsert

__all__ = [
    "add_columns",
    "change_feed",
    "changed_rows",
    "conform",
    "dedupe_latest",
    "deleted_keys",
    "diff_schemas",
    "dq_profile",
    "evolve_schema",
    "high_water_mark",
    "inserted_rows",
    "matched_keys",
    "matched_rows",
    "repeated_keys",
    "require_unique_keys",
    "schema_drift",
    "soft_delete",
    "type_drift_profile",
    "upsert",
]
