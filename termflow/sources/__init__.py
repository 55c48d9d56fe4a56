"""termflow.sources."""
