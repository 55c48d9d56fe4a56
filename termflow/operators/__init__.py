"""termflow.operators."""
