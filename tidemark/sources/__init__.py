"""Readers and sinks: CSV batches, file listings, image headers, snapshotted Parquet tables."""
