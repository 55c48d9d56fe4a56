"""termflow.functions."""
