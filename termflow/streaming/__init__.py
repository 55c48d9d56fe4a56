"""Streaming entry points.

The reference is batch only; the one streaming use here is scoring newly
arriving document-line files with an already fitted model (the reference's
test phase, IO2 + ML3 + ML11, applied per micro-batch)."""
