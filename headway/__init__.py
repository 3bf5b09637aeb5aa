"""headway: transit snapshots and live transit records as Spark tables."""
