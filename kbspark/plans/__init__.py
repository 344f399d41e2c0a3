"""Plan helpers: cutting lineage in the shared folder, bounded broadcasts, skew-safe joins."""
