"""Readers, manifests, response dumps, stored tables, catalog entries and the run ledger."""
