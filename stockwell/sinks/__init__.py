"""Writes: whole-version snapshots, appends, JSON documents, typed batches."""
