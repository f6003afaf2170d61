"""Structured Streaming: incremental Stage 1 over newly arrived raw files."""

from panelforge.streaming.incremental import run_incremental, select_files

__all__ = ["run_incremental", "select_files"]
