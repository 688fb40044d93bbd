"""Readers of tables and of catalog feeds."""
