"""Readers: ledger tables, messages, folder listings, stored objects and metrics."""
