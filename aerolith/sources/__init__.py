"""Readers, writers, tables and ledgers."""
