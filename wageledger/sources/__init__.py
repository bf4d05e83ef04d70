"""Readers: landed CSV snapshots, date ranges, and a ledger over order tables."""
