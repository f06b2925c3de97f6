"""Readers (Parquet tables, declared schemas) and sinks (staged publish, run log)."""

from quayside.sources.tables import read_table, TableSet

__all__ = ["read_table", "TableSet"]
