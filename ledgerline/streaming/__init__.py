"""Incremental landing of raw CSV drops (Structured Streaming, available-now trigger)."""

from ledgerline.streaming.landing import dedup_new_files, land_new_files

__all__ = ["dedup_new_files", "land_new_files"]
