"""Compositions of operators: ingest, warehouse build, and the declared checks."""
