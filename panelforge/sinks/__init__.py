"""Sinks: Parquet datasets (flat, array, sharded) and small report files."""

from panelforge.sinks.parquet import ARRAY_SUFFIX, WriteResult, write_parquet, write_sharded, write_table

__all__ = ["ARRAY_SUFFIX", "WriteResult", "write_parquet", "write_sharded", "write_table"]
