"""Relational operators: feature views, as-of joins, datasets, metrics, drift, ledger."""
