"""Streaming entry points (incremental loads)."""

from .incremental import load_micro_batch, start_incremental_load

__all__ = ["load_micro_batch", "start_incremental_load"]
