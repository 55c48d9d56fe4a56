"""termflow.plans."""
