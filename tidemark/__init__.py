"""Incremental table sync as Spark DataFrame plans."""

from tidemark.plans.control import Process, select_processes
from tidemark.plans.catalog import CatalogTarget
from tidemark.plans.store import TargetStore
from tidemark.plans.sync import SyncResult, sync, sync_all

__all__ = ["CatalogTarget", "Process", "SyncResult", "TargetStore", "select_processes", "sync", "sync_all"]
