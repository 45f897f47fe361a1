"""The control table: one row per sync process."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, functions as F

# Column names of the control table (fixed values).
PROCESS_NAME = "PROCESS_NAME"
ACTIVE_FLAG = "ACTIVE_FLAG"
SOURCE_SYSTEM = "SOURCE_SYSTEM"
TARGET_SYSTEM = "TARGET_SYSTEM"
LOAD_TYPE = "LOAD_TYPE"
SOURCE_DATABASE = "SOURCE_DATABASE"
SOURCE_TABLE_NAME = "SOURCE_TABLE_NAME"
TARGET_DATABASE = "TARGET_DATABASE"
TARGET_SCHEMA = "TARGET_SCHEMA"
TARGET_TABLE_NAME = "TARGET_TABLE_NAME"
INCREMENTAL_COLUMN = "_CONDITION"
PRIMARY_KEY = "PRIMARY_KEY"
ENDDATE = "ENDDATE"

INCREMENTAL = "INCREMENTAL"
FULL = "FULL"


@dataclass(frozen=True)
class Process:
    """What to sync, and from which mark on if no run has set one yet."""

    name: str
    source_table: str
    target_table: str
    source_system: str
    load_type: str = INCREMENTAL
    incremental_column: str | None = None
    keys: tuple[str, ...] = ()
    enddate: object | None = None
    source_database: str | None = None
    target_database: str | None = None
    target_schema: str | None = None

    def __post_init__(self) -> None:
        if isinstance(self.keys, str):
            raise TypeError(f"{self.name}: keys are a tuple of column names")
        if self.load_type.upper() not in (FULL, INCREMENTAL):
            raise ValueError(f"{self.name}: unknown load type {self.load_type!r}")

    @property
    def target_name(self) -> str:
        """The target with its database and schema, where given."""
        parts = (self.target_database, self.target_schema, self.target_table)
        return ".".join(part for part in parts if part)

    @property
    def mode(self) -> str:
        """full for a full load; for an incremental one merge with a key, append without."""
        return "full" if self.load_type.upper() == FULL else "merge" if self.keys else "append"

    @staticmethod
    def from_row(row: Row) -> Process:
        """Read a control row. PRIMARY_KEY may name several columns, separated by commas."""
        values = {name.upper(): value for name, value in row.asDict().items()}
        keys = tuple(k.strip() for k in (values.get(PRIMARY_KEY) or "").split(",") if k.strip())
        return Process(
            name=values[PROCESS_NAME],
            source_table=values[SOURCE_TABLE_NAME],
            target_table=values[TARGET_TABLE_NAME],
            source_system=values[SOURCE_SYSTEM],
            load_type=values.get(LOAD_TYPE) or "",
            incremental_column=values.get(INCREMENTAL_COLUMN) or None,
            keys=keys,
            enddate=values.get(ENDDATE),
            source_database=values.get(SOURCE_DATABASE),
            target_database=values.get(TARGET_DATABASE),
            target_schema=values.get(TARGET_SCHEMA),
        )


def select_processes(control: DataFrame, active: str = "Y", **equals: str) -> DataFrame:
    """Active control rows that equal every given value; NULL equals nothing.

    All survivors are kept, not just some first one. Names are control columns in
    any case: `select_processes(control, source_system="SRC", load_type="FULL")`.
    """
    for column, value in {ACTIVE_FLAG: active, **equals}.items():
        control = control.filter(F.col(column) == F.lit(value))
    return control
