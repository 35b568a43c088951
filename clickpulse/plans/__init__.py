"""Plan-level helpers (size-checked broadcast, lineage cuts) and the batch job."""
